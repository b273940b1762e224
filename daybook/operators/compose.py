"""Composition of changes: many days' changes as one net change per key.

The changes of consecutive days compose: the image before the first and the
image after the last are all that a replay across the whole range needs. A key
that comes and goes vanishes, one that goes and comes back is an update or, with
the same content, nothing; so is an update that is taken back. Composition is
associative, so net changes of adjacent ranges compose further (see
``sources.ladder``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.equality import same_content
from .diff import DELETE, INSERT, UPDATE
from .replay import _by_key, _image_fields, _kcols
from .schema import as_keys


def compose(log: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """The net change per key of ``log``'s days, dated with the key's last change.

    ``log`` holds at most one change per key and day, as a change log does; net
    changes of adjacent ranges qualify as well. One shuffle of the change rows
    by key; a key's group holds at most one row per day (or range). Replaying
    the result forward, or undoing it, equals doing so with ``log`` at the ends
    of the range; days inside can't be told any more.
    """
    ks = as_keys(keys)
    _image_fields(log)
    dtype = log.schema["after"].dataType
    net = _by_key(log, ks).groupBy(*ks).agg(
        F.min_by(F.struct("before"), "day").alias("_first"), F.max_by(F.struct("after"), "day").alias("_last"), F.max("day").alias("day")
    )
    before, after = F.col("_first.before"), F.col("_last.after")
    op = (
        F.when(before.isNull() & after.isNull(), F.lit(None))
        .when(before.isNull(), F.lit(INSERT))
        .when(after.isNull(), F.lit(DELETE))
        .when(~same_content(before, after, dtype), F.lit(UPDATE))
    )
    rows = net.select(*_kcols(ks), op.alias("op"), before.alias("before"), after.alias("after"), "day")
    return rows.where(F.col("op").isNotNull())
