"""Day parameters (F09): parsed once on the driver, passed as DATE literals."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_day(value) -> dt.date:
    """Strict ``yyyy-MM-dd`` parse; ``2025-02-30`` raises ``ValueError``."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    if isinstance(value, str):
        return dt.date.fromisoformat(value.strip())
    raise TypeError(f"not a day: {value!r}")


def day_lit(value) -> Column:
    """A DATE literal (never a string compared to a date column)."""
    return F.lit(to_day(value))
