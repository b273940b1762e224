"""Registered queries on changing tables: nested columns, reserved names, columns that
come and go, reruns, and the user-level jobs. Each with its SQL (DuckDB) form.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import jobs
from ..operators.compare import compare_summary
from ..operators.diff import first_load, flatten_changes, snapshot_diff
from ..operators.replay import build_change_log
from ..session import scratch_path
from ..sources import io
from ..sources.store import Store
from .fixtures import KEY, N_DAYS, day_of, read_table, snapshot, snapshot_sql, snapshots
from .oracle import ORACLE as BASE

# ------------------------------------------------------------------ nested columns

# By o_orderkey % 12, the columns of a day (0: before, 1: after) that differ
# where hashes that skip nulls and bounds see no difference; SQL of both engines.
_PARTS = {
    "s": ("struct(CAST(NULL AS BIGINT), 1)", "struct(1, NULL)", 1),
    "a": ("list(1, NULL)", "list(NULL, 1)", 2),
    "n": ("list(list(1), list(2))", "list(list(1, 2), empty)", 3),
    "o": ("list(1)", "list(1, NULL)", 4),
    "m": ("map(1, NULL, 2, 5)", "map(1, 5, 2, NULL)", 5),
    "t": ("struct(CAST(NULL AS BIGINT), CAST(NULL AS BIGINT))", "nothing", 8),
    "p": ("map(1, 2, 3, 4)", "map(3, 4, 1, 2)", 9),  # the same map: no change
    "q": ("list(1, 2)", "nolist", 10),
}
_LONGS = "CAST({0} AS BIGINT)"


def _value(text: str, spark: bool) -> str:
    """SQL of a value above: struct(x, y), list(...), map(k, v, ...), nothing, nolist, empty."""
    if text == "nothing":
        return "CAST(NULL AS STRUCT<x: BIGINT, y: BIGINT>)" if spark else "CAST(NULL AS STRUCT(x BIGINT, y BIGINT))"
    if text == "nolist":
        return "CAST(NULL AS ARRAY<BIGINT>)" if spark else "CAST(NULL AS BIGINT[])"
    kind, inner = text.split("(", 1)
    inner = inner[:-1]
    if kind == "struct":
        x, y = (i.strip() for i in inner.split(","))
        pair = f"'x', CAST({x} AS BIGINT), 'y', CAST({y} AS BIGINT)"
        return f"named_struct({pair})" if spark else f"{{'x': CAST({x} AS BIGINT), 'y': CAST({y} AS BIGINT)}}"
    items = [i.strip() for i in inner.split(",")]
    if kind == "map":
        ks, vs = items[::2], items[1::2]
        if spark:
            return f"CAST(map_from_arrays(array({', '.join(ks)}), array({', '.join(vs)})) AS MAP<BIGINT, BIGINT>)"
        return f"CAST(MAP([{', '.join(ks)}], [{', '.join(vs)}]) AS MAP(BIGINT, BIGINT))"
    if "list" in inner:
        sql = inner.replace("list(", "array(" if spark else "[").replace("empty", "array()" if spark else "[]")
        if not spark:
            sql = sql.replace(")", "]")
        return f"CAST(array({sql}) AS ARRAY<ARRAY<BIGINT>>)" if spark else f"CAST([{sql}] AS BIGINT[][])"
    return f"CAST(array({inner}) AS ARRAY<BIGINT>)" if spark else f"CAST([{inner}] AS BIGINT[])"


def nested_sql(day: int, spark: bool) -> str:
    """Orders with nested columns; one key in twelve is missing on either day."""
    cols = [
        f"CASE WHEN o_orderkey % 12 = {k} THEN {_value((a, b)[day], spark)} ELSE {_value(a, spark)} END AS {c}" for c, (a, b, k) in _PARTS.items()
    ]
    return f"SELECT o_orderkey, {', '.join(cols)} FROM orders WHERE o_orderkey % 12 <> {(7, 6)[day]}"


def _nested(spark: SparkSession, sf: str) -> list[DataFrame]:
    orders = read_table(spark, sf, "orders")
    return [spark.sql(nested_sql(d, True).replace("FROM orders", "FROM {orders}"), orders=orders) for d in (0, 1)]


def _nested_diff(strategy: str, limit: int | None = None) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark, sf):
        prev, new = _nested(spark, sf)
        return snapshot_diff(prev, new, KEY, day_of(1), strategy=strategy, broadcast_limit=limit).select(KEY, "op")

    return q


def q_compare_nested_summary(spark, sf):
    return compare_summary(*_nested(spark, sf), KEY)


_SAME = " AND ".join(f"p.{c} IS NOT DISTINCT FROM n.{c}" for c in _PARTS if c not in "mp")
# maps compare by their entries in key order
_SAME += "".join(f" AND list_sort(map_entries(p.{c})) IS NOT DISTINCT FROM list_sort(map_entries(n.{c}))" for c in "mp")
_NESTED_CLASSES = f"""SELECT coalesce(p.o_orderkey, n.o_orderkey) AS o_orderkey,
       CASE WHEN p.o_orderkey IS NULL THEN 'INSERT' WHEN n.o_orderkey IS NULL THEN 'DELETE' WHEN NOT ({_SAME}) THEN 'UPDATE' END AS op
FROM ({nested_sql(0, False)}) p FULL OUTER JOIN ({nested_sql(1, False)}) n ON p.o_orderkey = n.o_orderkey"""
_NESTED_DIFF = f"SELECT * FROM ({_NESTED_CLASSES}) c WHERE op IS NOT NULL"
_NESTED_SUMMARY = f"""WITH n AS (SELECT count(*) FILTER (WHERE op = 'DELETE') AS removed, count(*) FILTER (WHERE op = 'INSERT') AS added,
       count(*) FILTER (WHERE op = 'UPDATE') AS modified, count(*) FILTER (WHERE op IS NULL) AS unchanged FROM ({_NESTED_CLASSES}) c)
SELECT removed + modified + unchanged AS rows_a, added + modified + unchanged AS rows_b, removed, added, modified, unchanged,
       removed + added + modified AS total_changes,
       CASE WHEN removed + modified + unchanged > 0
            THEN round(CAST(removed + added + modified AS DOUBLE) * 100.0 / CAST(removed + modified + unchanged AS DOUBLE), 2) END AS change_rate
FROM n"""


# ------------------------------------------------------------------ content columns with bookkeeping names

_RENAMED = {"o_custkey": "op", "o_orderstatus": "day", "o_totalprice": "before", "o_orderpriority": "after"}


def q_diff_reserved_names(spark, sf):
    prev, new = (snapshot(spark, sf, d).withColumnsRenamed(_RENAMED) for d in (2, 3))
    return flatten_changes(snapshot_diff(prev, new, KEY, day_of(3)), KEY)


_RESERVED = ", ".join(f"{side}_{c} AS {side}_{n}" for side in ("before", "after") for c, n in _RENAMED.items())


# ------------------------------------------------------------------ columns that come and go

#: The dump's columns on each day: one goes, one comes, one changes its type.
_DRIFT = [
    ["o_custkey", "o_orderstatus", "o_totalprice"],
    ["o_custkey", "o_orderstatus", "o_orderpriority"],
    ["o_custkey", "o_orderstatus", "o_orderpriority"],
    ["o_custkey", "o_totalprice", "o_orderpriority"],
    ["o_custkey", "o_totalprice", "o_orderpriority"],
]
_TEXT_FROM = 4  # o_custkey is text from this day on


def _drifting(spark: SparkSession, sf: str) -> list[tuple[object, DataFrame]]:
    out = []
    for d, (day, df) in enumerate(snapshots(spark, sf)):
        key = F.col("o_custkey").cast("string") if d >= _TEXT_FROM else F.col("o_custkey")
        out.append((day, df.withColumn("o_custkey", key).select(KEY, *_DRIFT[d])))
    return out


def _drift_sql(d: int, cols: list[str]) -> str:
    return f"SELECT o_orderkey, {', '.join(cols)} FROM ({snapshot_sql(d)}) s"


_ALL = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def _as_text(df: DataFrame, day) -> DataFrame:
    have = set(df.columns)
    cols = [(F.col(c).cast("string") if c == "o_custkey" else F.col(c)) if c in have else F.lit(None).cast("double" if c == "o_totalprice" else "string") for c in _ALL]
    names = F.lit(",".join(c for c in df.columns))
    return df.select(F.lit(day).alias("day"), names.alias("columns"), KEY, *[c.alias(n) for c, n in zip(cols, _ALL)])


def q_store_drift_as_of(spark, sf):
    """Every day of a pruned store, in its own columns, as a new reader finds it."""
    root = scratch_path(spark, "store")
    store = Store(spark, root, KEY, keep_snapshot_every=1000)
    dumps = _drifting(spark, sf)
    for day, dump in dumps:
        store.integrate(dump, day, cast=True)
    reader = Store(spark, root, KEY)
    return functools.reduce(lambda a, b: a.unionByName(b), [_as_text(reader.as_of(day), day) for day, _ in dumps])


def _drift_day(d: int) -> str:
    kinds = {"o_custkey": "VARCHAR", "o_orderstatus": "VARCHAR", "o_totalprice": "DOUBLE", "o_orderpriority": "VARCHAR"}
    cols = ", ".join(f"CAST({c if c in _DRIFT[d] else 'NULL'} AS {kinds[c]}) AS {c}" for c in _ALL)
    return f"SELECT DATE '{day_of(d)}' AS day, '{','.join([KEY, *_DRIFT[d]])}' AS columns, o_orderkey, {cols} FROM ({snapshot_sql(d)}) s"


def q_backfill_drift(spark, sf):
    store = Store(spark, scratch_path(spark, "store"), KEY)
    store.backfill(_drifting(spark, sf), chunk_days=3, cast=True)
    log = store.read_log()
    keep = [f"{side}_{c}" for side in ("before", "after") for c in _ALL]
    return flatten_changes(log, KEY).select(KEY, "op", "day", *keep)


def _drift_changes(d: int) -> str:
    """Changes of day ``d`` in that day's columns: the day before has null where it lacks one."""
    cols = _DRIFT[d]
    kinds = {"o_custkey": "VARCHAR", "o_orderstatus": "VARCHAR", "o_totalprice": "DOUBLE", "o_orderpriority": "VARCHAR"}

    def side(day: int) -> str:
        return ", ".join(f"CAST({c if c in _DRIFT[day] else 'NULL'} AS {kinds[c]}) AS {c}" for c in cols)

    images = ", ".join(
        f"{s}.{c} AS {name}_{c}" if c in cols else f"CAST(NULL AS {kinds[c]}) AS {name}_{c}" for s, name in (("p", "before"), ("n", "after")) for c in _ALL
    )
    if d == 0:
        images = ", ".join(f"CAST(NULL AS {kinds[c]}) AS before_{c}" for c in _ALL) + ", " + ", ".join(
            f"n.{c} AS after_{c}" if c in cols else f"CAST(NULL AS {kinds[c]}) AS after_{c}" for c in _ALL
        )
        return f"SELECT n.o_orderkey, 'INSERT' AS op, DATE '{day_of(0)}' AS day, {images} FROM (SELECT o_orderkey, {side(0)} FROM ({snapshot_sql(0)}) s) n"
    same = " AND ".join(f"p.{c} IS NOT DISTINCT FROM n.{c}" for c in cols)
    return f"""SELECT coalesce(p.o_orderkey, n.o_orderkey) AS o_orderkey,
       CASE WHEN p.o_orderkey IS NULL THEN 'INSERT' WHEN n.o_orderkey IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS op, DATE '{day_of(d)}' AS day, {images}
FROM (SELECT o_orderkey, {side(d - 1)} FROM ({snapshot_sql(d - 1)}) s) p FULL OUTER JOIN (SELECT o_orderkey, {side(d)} FROM ({snapshot_sql(d)}) s) n
     ON p.o_orderkey = n.o_orderkey
WHERE p.o_orderkey IS NULL OR n.o_orderkey IS NULL OR NOT ({same})"""


# ------------------------------------------------------------------ reruns and replay over stored data


def q_store_rerun(spark, sf):
    """A pruned store whose newest day is first integrated from a wrong dump, then corrected."""
    store = Store(spark, scratch_path(spark, "store"), KEY, keep_snapshot_every=1000)
    dumps = snapshots(spark, sf)
    for day, dump in dumps[:-1]:
        store.integrate(dump, day)
    store.integrate(dumps[0][1], dumps[-1][0])
    store.integrate(dumps[-1][1], dumps[-1][0])
    return flatten_changes(store.read_log(), KEY)


def q_store_as_of_forward(spark, sf):
    """The kept base is before the target day: its changes since are applied."""
    store = Store(spark, scratch_path(spark, "store"), KEY)
    dumps = snapshots(spark, sf)
    store.backfill(dumps[:1])
    store.backfill(dumps[1:])  # one version, of the last day
    return store.as_of(day_of(3))


def q_optional_source(spark, sf):
    """A previous snapshot that isn't there is an empty table, so every row is an INSERT."""
    new = snapshot(spark, sf, 0)
    prev, found = io.read_optional(spark, scratch_path(spark, "absent"), new.schema)
    return flatten_changes(snapshot_diff(prev, new, KEY, day_of(0)) if not found else first_load(new, KEY, day_of(0)), KEY)


# ------------------------------------------------------------------ the user-level jobs


def _csv_store(spark, sf, days=range(N_DAYS)) -> str:
    root = scratch_path(spark, "jobs")
    for day, dump in snapshots(spark, sf, days):
        path = f"{root}/inbox/{day}"
        io.write_dump_csv(dump.withColumnRenamed(KEY, "id"), path)
        jobs.daily_integration(spark, f"{root}/store", path, day, dump.withColumnRenamed(KEY, "id").schema, KEY)
    return root


def q_job_daily_csv(spark, sf):
    return flatten_changes(Store(spark, f"{_csv_store(spark, sf)}/store", KEY).read_log(), KEY)


def q_job_recompute(spark, sf):
    root = _csv_store(spark, sf)
    return jobs.recompute_at_date(spark, f"{root}/store", day_of(1), KEY, f"{root}/out")


def _two_dumps(spark, sf):
    root = scratch_path(spark, "dumps")
    for d in (0, 4):
        io.write_parquet(snapshot(spark, sf, d), f"{root}/{d}")
    return jobs.diff_between_dumps(spark, f"{root}/0", f"{root}/4", KEY)


def _report(part: str):
    def q(spark, sf):
        store = Store(spark, scratch_path(spark, "store"), KEY)
        for day, dump in snapshots(spark, sf, [3, 4]):
            store.integrate(dump, day)
        return jobs.report(spark, store.root, KEY, sections=(("o_orderpriority", 3), ("absent", 9)))[part]

    return q


def q_backfill_hash(spark, sf):
    """Days 1-4 on top of day 0, from digests and the images of the changed rows."""
    dumps = snapshots(spark, sf)
    log = build_change_log(dumps[1:], KEY, base=dumps[0][1], strategy="hash", broadcast_limit=1 << 30)
    return flatten_changes(log, KEY)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "diff_nested_struct": _nested_diff("struct"),
    "diff_nested_hash": _nested_diff("hash", 1 << 30),
    "diff_nested_hash_large": _nested_diff("hash", -1),
    "compare_nested_summary": q_compare_nested_summary,
    "diff_reserved_names": q_diff_reserved_names,
    "store_drift_as_of": q_store_drift_as_of,
    "backfill_drift": q_backfill_drift,
    "backfill_hash": q_backfill_hash,
    "store_rerun": q_store_rerun,
    "store_as_of_forward": q_store_as_of_forward,
    "optional_source": q_optional_source,
    "job_daily_csv": q_job_daily_csv,
    "job_recompute": q_job_recompute,
    "job_diff_summary": lambda spark, sf: _two_dumps(spark, sf)[0],
    "job_diff_samples": lambda spark, sf: _two_dumps(spark, sf)[1],
    "job_report_total": _report("total"),
    "job_report_top": _report("top3_o_orderpriority"),
    "job_report_sample": _report("sample"),
}

ORACLE: dict[str, str] = {
    "diff_nested_struct": _NESTED_DIFF,
    "diff_nested_hash": _NESTED_DIFF,
    "diff_nested_hash_large": _NESTED_DIFF,
    "compare_nested_summary": _NESTED_SUMMARY,
    "diff_reserved_names": f"SELECT {KEY}, op, {_RESERVED}, day FROM ({BASE['change_log_day']}) d",
    "store_drift_as_of": "\nUNION ALL\n".join(_drift_day(d) for d in range(N_DAYS)),
    "backfill_drift": "\nUNION ALL\n".join(_drift_changes(d) for d in range(N_DAYS)),
    "backfill_hash": f"SELECT * FROM ({BASE['integrate_days']}) l WHERE day > DATE '{day_of(0)}'",
    "store_rerun": BASE["integrate_days"],
    "store_as_of_forward": BASE["apply_changes"],
    "optional_source": BASE["first_load"],
    "job_daily_csv": BASE["integrate_days"],
    "job_recompute": BASE["asof_reverse"],
    "job_diff_summary": BASE["compare_summary"],
    "job_diff_samples": BASE["compare_samples"],
    "job_report_total": BASE["snapshot_count"],
    "job_report_top": f"SELECT o_orderpriority, count(*) AS count FROM ({snapshot_sql(4)}) s GROUP BY o_orderpriority ORDER BY count DESC, o_orderpriority ASC NULLS LAST LIMIT 3",
    "job_report_sample": BASE["sample_snapshot"],
}
