"""Registered queries on columns that go on under new names. Each with its SQL (DuckDB) form."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.diff import flatten_changes
from ..operators.renames import column_matches
from ..session import scratch_path
from ..sources.store import Store
from .fixtures import KEY, N_DAYS, day_of, snapshot, snapshot_sql, snapshots
from .oracle import ORACLE as BASE

# ------------------------------------------------------------------ which column is which


def q_column_matches(spark, sf):
    """Day 2 and day 3 with two columns renamed, and one of numbers gone where another of numbers comes."""
    names = {"o_orderstatus": "status_code", "o_orderpriority": "urgency"}
    new = snapshot(spark, sf, 3).withColumnsRenamed(names).withColumn("clerk", F.col("o_custkey") % 11).drop("o_custkey")
    return column_matches(snapshot(spark, sf, 2), new, KEY).select("old", "new", "agreed", "filled_old", "filled_new", "chosen")


_PAIRS = [(old, new) for old in ("o_orderstatus", "o_orderpriority") for new in ("status_code", "urgency")] + [("o_custkey", "clerk")]
_MATCHES = f"""WITH both_days AS (SELECT a.*, b.o_orderstatus AS status_code, b.o_orderpriority AS urgency, b.o_custkey % 11 AS clerk
  FROM ({snapshot_sql(2)}) a JOIN ({snapshot_sql(3)}) b ON a.{KEY} = b.{KEY}),
pairs AS ({" UNION ALL ".join(f"SELECT '{o}' AS old, '{n}' AS new, count(*) FILTER (WHERE {o} = {n}) AS agreed, count({o}) AS filled_old, count({n}) AS filled_new FROM both_days" for o, n in _PAIRS)})
SELECT *, 10 * agreed >= 9 * greatest(filled_old, filled_new) AS chosen FROM pairs WHERE agreed > 0"""


# ------------------------------------------------------------------ a store whose columns are renamed

#: The columns' names on each day, and which new ones each day is told (the others are detected).
_NAMES = [
    ("o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"),
    ("customer", "o_orderstatus", "o_totalprice", "o_orderpriority"),
    ("customer", "o_orderstatus", "o_totalprice", "o_orderpriority"),
    ("customer", "status_code", "o_totalprice", "urgency"),
    ("customer", "state", "o_totalprice", "urgency"),
]
_TOLD = {4: {"status_code": "state"}}  # a fifth of its values change that day


def _store(spark: SparkSession, sf: str) -> Store:
    """A pruned store of these days, as a new reader finds it."""
    store = Store(spark, scratch_path(spark, "store"), KEY, keep_snapshot_every=1000)
    for d, (day, dump) in enumerate(snapshots(spark, sf)):
        store.integrate(dump.withColumnsRenamed(dict(zip(_NAMES[0], _NAMES[d]))), day, renames=_TOLD.get(d, "detect"))
    return Store(spark, store.root, KEY)


def _each_day(frames: list[DataFrame]) -> DataFrame:
    return functools.reduce(lambda a, b: a.unionByName(b), frames)


def q_renamed_change_log(spark, sf):
    return flatten_changes(_store(spark, sf).read_log(), KEY)


def q_renamed_as_of(spark, sf):
    store = _store(spark, sf)
    tables = [(d, store.as_of(day_of(d))) for d in range(N_DAYS)]
    return _each_day(
        [
            df.select(F.lit(day_of(d)).alias("day"), F.lit(",".join(df.columns[1:])).alias("columns"), KEY, *[F.col(n).alias(c) for c, n in zip(_NAMES[0], _NAMES[d])])
            for d, df in tables
        ]
    )


def q_renamed_counts(spark, sf):
    """Groups of the status on each day, from the count deltas of days that call it otherwise."""
    store = _store(spark, sf)
    return _each_day([store.group_count(_NAMES[d][1], day_of(d)).select(F.lit(day_of(d)).alias("day"), F.col(_NAMES[d][1]).alias("status"), "count") for d in range(N_DAYS)])


_LAST = ", ".join(f"{side}_{c} AS {side}_{n}" for side in ("before", "after") for c, n in zip(_NAMES[0], _NAMES[-1]))

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "column_matches": q_column_matches,
    "renamed_change_log": q_renamed_change_log,
    "renamed_as_of": q_renamed_as_of,
    "renamed_counts": q_renamed_counts,
}

ORACLE: dict[str, str] = {
    "column_matches": _MATCHES,
    "renamed_change_log": f"SELECT {KEY}, op, day, {_LAST} FROM ({BASE['integrate_days']}) l",
    "renamed_as_of": "\nUNION ALL\n".join(f"SELECT DATE '{day_of(d)}' AS day, '{','.join(_NAMES[d])}' AS columns, s.* FROM ({snapshot_sql(d)}) s" for d in range(N_DAYS)),
    "renamed_counts": "\nUNION ALL\n".join(
        f"""SELECT DATE '{day_of(d)}' AS day, o_orderstatus AS status, count(*) AS "count" FROM ({snapshot_sql(d)}) s GROUP BY o_orderstatus""" for d in range(N_DAYS)
    ),
}
