"""Reports over a snapshot or a change log.

Everything returns a DataFrame; showing it is the caller's business. Group
counts are combined map-side before the shuffle, so a hot group costs no more
than a cold one. Top-N orders by count descending and then by the grouped
value, so ties have one answer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .schema import as_keys, require_columns, schema_of  # noqa: F401  (R05 re-export)


def total_rows(df: DataFrame) -> DataFrame:
    """One row, ``total_rows``."""
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("total_rows"))


def group_count(df: DataFrame, column: str) -> DataFrame:
    """``<column>, count``; the null group is kept."""
    require_columns(df, [column])
    return df.groupBy(F.col(f"`{column}`")).agg(F.count(F.lit(1)).cast("bigint").alias("count"))


def top_n(df: DataFrame, column: str, n: int) -> DataFrame:
    """The ``n`` largest groups of ``column``."""
    counts = group_count(df, column)
    return counts.orderBy(F.desc("count"), F.asc_nulls_last(f"`{column}`")).limit(n)


def sample_rows(df: DataFrame, keys: str | Sequence[str], n: int = 5) -> DataFrame:
    """The ``n`` rows with the smallest keys (deterministic)."""
    return df.orderBy(*as_keys(keys)).limit(n)


def change_counts(log: DataFrame) -> DataFrame:
    """``op, count`` in one aggregate."""
    require_columns(log, ["op"], "change log")
    return log.groupBy("op").agg(F.count(F.lit(1)).cast("bigint").alias("count"))


def changelog_stats(log: DataFrame) -> DataFrame:
    """``day, op, count`` -- rows per day and operation."""
    require_columns(log, ["op", "day"], "change log")
    return log.groupBy("day", "op").agg(F.count(F.lit(1)).cast("bigint").alias("count"))
