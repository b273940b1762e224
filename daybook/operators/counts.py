"""Incremental reports: group counts that changes add to and take from.

A day's changes move rows between the groups of a column: an INSERT adds one to
the group of its after-image, a DELETE takes one from the group of its
before-image, an UPDATE does both where the value differs. The sums of these by
group are the day's *count deltas*; the group counts of any day are the sums of
the deltas up to it, so a report on a past day reads no snapshot and no change
row. Deltas are summed map-side before their shuffle: a group that a third of
all rows is in costs no more than another.

Groups are told apart as ``groupBy`` does (null is a group, ``-0.0 = 0.0``,
``NaN = NaN``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .schema import as_keys, require_columns


def _value(log: DataFrame, image: str, column: str, keys: Sequence[str]) -> Column:
    if column in keys:
        return F.col(f"`{column}`")
    if column not in log.schema[image].dataType.fieldNames():
        raise ValueError(f"the log's images lack column {column!r}; they have {log.schema[image].dataType.fieldNames()}")
    return F.col(image).getField(column)


def count_deltas(log: DataFrame, keys: str | Sequence[str], column: str) -> DataFrame:
    """``day, value, delta``: by how many rows each group of ``column`` grew or shrank on each day (never 0)."""
    keys = as_keys(keys)
    require_columns(log, [*keys, "op", "before", "after", "day"], "change log")
    old, new = (_value(log, image, column, keys) for image in ("before", "after"))
    left = F.when(F.col("op") != "INSERT", F.struct(old.alias("value"), F.lit(-1).cast("bigint").alias("delta")))
    came = F.when(F.col("op") != "DELETE", F.struct(new.alias("value"), F.lit(1).cast("bigint").alias("delta")))
    moving = log.where((F.col("op") != "UPDATE") | ~old.eqNullSafe(new))
    moves = moving.select("day", F.explode(F.array(left, came)).alias("m")).where(F.col("m").isNotNull()).select("day", "m.*")
    return moves.groupBy("day", "value").agg(F.sum("delta").alias("delta")).where(F.col("delta") != 0)


def counts_from(deltas: DataFrame, column: str) -> DataFrame:
    """G02 from deltas (``value, delta``): ``<column>, count`` of the groups that have rows."""
    total = deltas.groupBy("value").agg(F.sum("delta").alias("count")).where(F.col("count") != 0)
    return total.select(F.col("value").alias(column), "count")


def top_n_from(deltas: DataFrame, column: str, n: int) -> DataFrame:
    """T02 from deltas: the ``n`` largest groups, ties by value as in ``top_n``."""
    return counts_from(deltas, column).orderBy(F.desc("count"), F.asc_nulls_last(f"`{column}`")).limit(n)
