"""Registered queries on the log itself: merged days, late days, lookups at many days,
column-level changes, moved rows, comparison by checksums. Each with its SQL (DuckDB) form.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.columns import changes_of_column, column_change_counts
from ..operators.compose import compose
from ..operators.diff import flatten_changes
from ..operators.lookup import lookup
from ..operators.moved import compare_moved
from ..operators.replay import build_change_log
from ..session import scratch_path
from ..sources.rejects import split_dump_csv
from ..sources.store import Store
from .evolution import _NESTED_CLASSES, _PARTS, _nested
from .fixtures import COLUMNS, KEY, N_DAYS, day_of, read_table, snapshot, snapshot_sql, snapshots
from .oracle import ORACLE as BASE

CONTENT = [c for c in COLUMNS if c != KEY]
#: Days of the queries over merged days: blocks of two and four days.
LONG = 8


# ------------------------------------------------------------------ merged days


def q_store_compacted_as_of(spark, sf):
    """Every day of a store of merged days, rolled forward from the first version and back from the last."""
    dumps = snapshots(spark, sf, range(LONG))
    store = Store(spark, scratch_path(spark, "store"), KEY)
    store.backfill(dumps[:1])
    store.backfill(dumps[1:], chunk_days=LONG)
    store.compact_log()
    reader = Store(spark, store.root, KEY)
    tables = [(day, way, f(day)) for day, _ in dumps for way, f in (("forward", reader.as_of), ("back", reader.undo_to))]
    return functools.reduce(lambda a, b: a.unionByName(b), [df.withColumn("day", F.lit(day)).withColumn("way", F.lit(way)) for day, way, df in tables])


def q_compose_changes(spark, sf):
    """The net changes of days 1 to 4 over day 0."""
    dumps = snapshots(spark, sf)
    log = build_change_log(dumps[1:], KEY, base=dumps[0][1])
    return flatten_changes(compose(log, KEY), KEY)


def _flat_diff(a: int, b: int) -> str:
    images = ", ".join(f"{s}.{c} AS {n}_{c}" for s, n in (("p", "before"), ("n", "after")) for c in CONTENT)
    same = " AND ".join(f"p.{c} IS NOT DISTINCT FROM n.{c}" for c in CONTENT)
    return f"""SELECT coalesce(p.{KEY}, n.{KEY}) AS {KEY},
       CASE WHEN p.{KEY} IS NULL THEN 'INSERT' WHEN n.{KEY} IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS op, {images}
FROM ({snapshot_sql(a)}) p FULL OUTER JOIN ({snapshot_sql(b)}) n ON p.{KEY} = n.{KEY}
WHERE p.{KEY} IS NULL OR n.{KEY} IS NULL OR NOT ({same})"""


#: A net change is dated with the key's last change.
_COMPOSED = f"""SELECT d.*, l.day FROM ({_flat_diff(0, 4)}) d
JOIN (SELECT {KEY}, max(day) AS day FROM ({BASE["integrate_days"]}) l GROUP BY {KEY}) l ON l.{KEY} = d.{KEY}"""


# ------------------------------------------------------------------ late days


def q_store_late_day(spark, sf):
    """Days integrated out of order, one of them from a wrong dump first."""
    store = Store(spark, scratch_path(spark, "store"), KEY)
    dumps = snapshots(spark, sf)
    for d in (0, 4, 2, 1, 3):
        store.integrate(dumps[d][1] if d != 2 else dumps[0][1], dumps[d][0], late="insert")
    store.integrate(dumps[2][1], dumps[2][0], late="insert")
    return flatten_changes(store.read_log(), KEY)


# ------------------------------------------------------------------ lookups at many days

#: Each line item asks for its order at a day of its own, one day before the first included.
_PROBE_DAY = f"(l_orderkey + l_linenumber) % {N_DAYS + 1} - 1"


def q_asof_probe(spark, sf):
    log = build_change_log(snapshots(spark, sf), KEY)
    day = F.date_add(F.lit(day_of(0)), F.expr(_PROBE_DAY).cast("int"))
    probes = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", day.alias("day"))
    found = lookup(log, probes, KEY, probe_keys=["l_orderkey"])
    return found.select("l_orderkey", "l_linenumber", "day", F.col("at.valid_from").alias("valid_from"), *[F.col(f"at.row.{c}").alias(c) for c in CONTENT])


_PROBES = f"""WITH probes AS (SELECT l_orderkey, l_linenumber, CAST(DATE '{day_of(0)}' + CAST({_PROBE_DAY} AS INTEGER) AS DATE) AS day FROM lineitem),
log AS (SELECT * FROM ({BASE["integrate_days"]}) x)
SELECT p.l_orderkey, p.l_linenumber, p.day, CASE WHEN l.op <> 'DELETE' THEN l.day END AS valid_from,
       {", ".join(f"CASE WHEN l.op <> 'DELETE' THEN l.after_{c} END AS {c}" for c in CONTENT)}
FROM probes p ASOF LEFT JOIN log l ON p.l_orderkey = l.{KEY} AND p.day >= l.day"""


# ------------------------------------------------------------------ column-level changes


def q_column_change_counts(spark, sf):
    return column_change_counts(build_change_log(snapshots(spark, sf), KEY))


_UPDATES = f"SELECT * FROM ({BASE['integrate_days']}) l WHERE op = 'UPDATE'"
_COLUMN_COUNTS = "\nUNION ALL\n".join(
    f"""SELECT day, '{c}' AS "column", count(*) AS updates, count(*) FILTER (WHERE before_{c} IS DISTINCT FROM after_{c}) AS changed
FROM ({_UPDATES}) u GROUP BY day""" for c in CONTENT
)


def q_changes_of_column(spark, sf):
    return changes_of_column(build_change_log(snapshots(spark, sf), KEY), KEY, "o_orderpriority")


def q_column_changes_nested(spark, sf):
    """Nested columns: the fields of a struct each, arrays and maps whole."""
    prev, new = _nested(spark, sf)
    log = build_change_log([(day_of(0), prev), (day_of(1), new)], KEY)
    return column_change_counts(log).where(F.col("day") == F.lit(day_of(1)))


def _nested_counts() -> str:
    from .evolution import nested_sql

    parts = []
    for c in _PARTS:
        if c in "st":
            both = f"(p.{c} IS NULL) <> (n.{c} IS NULL)"
            parts += [(f"{c}.{x}", f"{both} OR p.{c}.{x} IS DISTINCT FROM n.{c}.{x}") for x in "xy"]
        elif c in "mp":
            parts.append((c, f"list_sort(map_entries(p.{c})) IS DISTINCT FROM list_sort(map_entries(n.{c}))"))
        else:
            parts.append((c, f"p.{c} IS DISTINCT FROM n.{c}"))
    joined = f"({nested_sql(0, False)}) p JOIN ({nested_sql(1, False)}) n ON p.{KEY} = n.{KEY}"
    updates = f"(SELECT count(*) FILTER (WHERE op = 'UPDATE') FROM ({_NESTED_CLASSES}) c)"
    return "\nUNION ALL\n".join(
        f"""SELECT DATE '{day_of(1)}' AS day, '{name}' AS "column", {updates} AS updates, count(*) FILTER (WHERE {test}) AS changed FROM {joined}"""
        for name, test in parts
    )


# ------------------------------------------------------------------ moved rows


def _renumbered(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Day 0 and day 3 of narrow rows (many of equal content), day 3 with some keys renumbered."""
    cols = [KEY, "o_orderstatus", "o_orderpriority"]
    a, b = snapshot(spark, sf, 0).select(*cols), snapshot(spark, sf, 3).select(*cols)
    new = F.when(F.col(KEY) % 3 == 0, F.col(KEY) + 100_000_000).otherwise(F.col(KEY))
    return a, b.withColumn(KEY, new)


def q_compare_moved(spark, sf):
    found = compare_moved(*_renumbered(spark, sf), KEY)
    return found.select(KEY, "change", F.col(f"to.{KEY}").alias("to_key"))


_MOVED = f"""WITH a AS (SELECT {KEY}, o_orderstatus, o_orderpriority FROM ({snapshot_sql(0)}) s),
b AS (SELECT CASE WHEN {KEY} % 3 = 0 THEN {KEY} + 100000000 ELSE {KEY} END AS {KEY}, o_orderstatus, o_orderpriority FROM ({snapshot_sql(3)}) s),
gone AS (SELECT *, row_number() OVER (PARTITION BY o_orderstatus, o_orderpriority ORDER BY {KEY}) AS r FROM a WHERE {KEY} NOT IN (SELECT {KEY} FROM b)),
come AS (SELECT *, row_number() OVER (PARTITION BY o_orderstatus, o_orderpriority ORDER BY {KEY}) AS r FROM b WHERE {KEY} NOT IN (SELECT {KEY} FROM a))
SELECT coalesce(g.{KEY}, c.{KEY}) AS {KEY}, CASE WHEN c.{KEY} IS NULL THEN 'REMOVED' WHEN g.{KEY} IS NULL THEN 'ADDED' ELSE 'MOVED' END AS change,
       CASE WHEN g.{KEY} IS NOT NULL THEN c.{KEY} END AS to_key
FROM gone g FULL OUTER JOIN come c ON g.o_orderstatus IS NOT DISTINCT FROM c.o_orderstatus
     AND g.o_orderpriority IS NOT DISTINCT FROM c.o_orderpriority AND g.r = c.r
UNION ALL
SELECT a.{KEY}, CASE WHEN a.o_orderstatus IS NOT DISTINCT FROM b.o_orderstatus AND a.o_orderpriority IS NOT DISTINCT FROM b.o_orderpriority
       THEN 'UNCHANGED' ELSE 'MODIFIED' END, NULL
FROM a JOIN b ON a.{KEY} = b.{KEY}"""


# ------------------------------------------------------------------ comparison by checksums


def q_compare_pruned(spark, sf):
    """Two bucketed versions that differ in few keys: one revised, one gone, one new in some thousands."""
    store = Store(spark, scratch_path(spark, "store"), KEY, buckets=64, keep_snapshot_every=None)
    a = snapshot(spark, sf, 3)
    k = F.col(KEY)
    revised = F.when(k % 4001 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    b = a.where(k % 5003 != 0).withColumn("o_totalprice", revised).unionByName(a.where(k % 6007 == 0).withColumn(KEY, k + 100_000_000))
    store.integrate(a, day_of(0))
    store.integrate(b, day_of(1))
    return store.compare(day_of(0), day_of(1))


_PRUNED = f"""WITH a AS (SELECT * FROM ({snapshot_sql(3)}) s),
n AS (SELECT count(*) AS rows_a, count(*) FILTER (WHERE {KEY} % 5003 = 0) AS removed,
       (SELECT count(*) FROM a WHERE {KEY} % 6007 = 0) AS added,
       count(*) FILTER (WHERE {KEY} % 5003 <> 0 AND {KEY} % 4001 = 0 AND o_totalprice IS NOT NULL) AS modified FROM a)
SELECT rows_a, rows_a - removed + added AS rows_b, removed, added, modified, rows_a - removed - modified AS unchanged,
       removed + added + modified AS total_changes,
       CASE WHEN rows_a > 0 THEN round(CAST(removed + added + modified AS DOUBLE) * 100.0 / CAST(rows_a AS DOUBLE), 2) END AS change_rate
FROM n"""


# ------------------------------------------------------------------ reports from count deltas


def q_top10_as_of(spark, sf):
    """The ten largest groups of the priority and of the customer on each of five days, from count deltas."""
    store = Store(spark, scratch_path(spark, "store"), KEY)
    dumps = snapshots(spark, sf)
    store.backfill(dumps[:3])
    for day, dump in (dumps[4], dumps[3]):
        store.integrate(dump, day, late="insert")
    tops = [
        store.top_n(c, 10, day).select(F.lit(day).alias("day"), F.lit(c).alias("column"), F.col(c).cast("string").alias("value"), "count")
        for day, _ in dumps
        for c in _TOP
    ]
    return functools.reduce(lambda a, b: a.unionByName(b), tops)


_TOP = ("o_orderpriority", "o_custkey")


def _top_as_of(d: int, c: str) -> str:
    return f"""SELECT DATE '{day_of(d)}' AS day, '{c}' AS "column", CAST({c} AS VARCHAR) AS value, n AS "count" FROM (
  SELECT {c}, count(*) AS n FROM ({snapshot_sql(d)}) s GROUP BY {c} ORDER BY n DESC, {c} ASC NULLS LAST LIMIT 10) t"""


# ------------------------------------------------------------------ CSV dumps with bad rows

_LINE_COLUMNS = (KEY, "o_custkey", "o_orderstatus", "o_orderpriority")


def _bad_lines(spark, sf):
    """All orders as lines of a CSV dump, some with a customer that is no number, too few or too many columns."""
    k = F.col(KEY)
    customer = F.when(k % 31 == 0, F.concat(F.lit("c"), F.col("o_custkey"))).otherwise(F.col("o_custkey").cast("string"))
    fields = [k.cast("string"), customer, F.col("o_orderstatus"), F.col("o_orderpriority")]
    fields = [F.coalesce(f, F.lit("")) for f in fields]
    line = F.when(k % 37 == 0, F.concat_ws(",", *fields[:2])).when(k % 41 == 0, F.concat_ws(",", *fields, F.lit("more")))
    line = line.otherwise(F.concat_ws(",", *fields))
    orders, path = read_table(spark, sf, "orders"), scratch_path(spark, "lines")
    # a separator and a quote that no line holds: lines are written as they are, below the header
    orders.select(line.alias(",".join(_LINE_COLUMNS))).write.option("header", True).option("sep", "\u0001").option("quote", "").csv(path)
    return split_dump_csv(spark, path, orders.select(*_LINE_COLUMNS).schema)


def q_csv_accepted(spark, sf):
    return _bad_lines(spark, sf).accepted


def q_csv_rejects(spark, sf):
    why = lambda r: F.concat_ws(" ", r["column"], r["value"], r["type"])
    return _bad_lines(spark, sf).rejects.select("raw", F.array_join(F.transform("reasons", why), "; ").alias("why"))


_LINES = f"""SELECT {KEY}, o_custkey, o_orderstatus, o_orderpriority,
       {KEY} || ',' || CASE WHEN {KEY} % 31 = 0 THEN coalesce('c' || o_custkey, '') ELSE coalesce(CAST(o_custkey AS VARCHAR), '') END AS two,
       coalesce(o_orderstatus, '') || ',' || coalesce(o_orderpriority, '') AS rest FROM orders"""
_REJECTS = f"""SELECT CASE WHEN {KEY} % 37 = 0 THEN two WHEN {KEY} % 41 = 0 THEN two || ',' || rest || ',more' ELSE two || ',' || rest END AS raw,
       CASE WHEN {KEY} % 31 = 0 AND o_custkey IS NOT NULL THEN 'o_custkey c' || o_custkey || ' bigint' ELSE '4 columns' END AS why
FROM ({_LINES}) l WHERE ({KEY} % 31 = 0 AND o_custkey IS NOT NULL) OR {KEY} % 37 = 0 OR {KEY} % 41 = 0"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "store_compacted_as_of": q_store_compacted_as_of,
    "compose_changes": q_compose_changes,
    "store_late_day": q_store_late_day,
    "asof_probe": q_asof_probe,
    "column_change_counts": q_column_change_counts,
    "changes_of_column": q_changes_of_column,
    "column_changes_nested": q_column_changes_nested,
    "compare_moved": q_compare_moved,
    "compare_pruned": q_compare_pruned,
    "top10_as_of": q_top10_as_of,
    "csv_accepted": q_csv_accepted,
    "csv_rejects": q_csv_rejects,
}

ORACLE: dict[str, str] = {
    "store_compacted_as_of": "\nUNION ALL\n".join(
        f"SELECT s.*, DATE '{day_of(d)}' AS day, '{way}' AS way FROM ({snapshot_sql(d)}) s" for d in range(LONG) for way in ("forward", "back")
    ),
    "compose_changes": _COMPOSED,
    "store_late_day": BASE["integrate_days"],
    "asof_probe": _PROBES,
    "column_change_counts": _COLUMN_COUNTS,
    "changes_of_column": f"SELECT {KEY}, day, before_o_orderpriority AS before, after_o_orderpriority AS after FROM ({_UPDATES}) u WHERE before_o_orderpriority IS DISTINCT FROM after_o_orderpriority",
    "column_changes_nested": _nested_counts(),
    "compare_moved": _MOVED,
    "compare_pruned": _PRUNED,
    "top10_as_of": "\nUNION ALL\n".join(_top_as_of(d, c) for d in range(N_DAYS) for c in _TOP),
    "csv_accepted": f"""SELECT {KEY}, o_custkey, nullif(o_orderstatus, '') AS o_orderstatus, nullif(o_orderpriority, '') AS o_orderpriority FROM orders
WHERE ({KEY} % 31 <> 0 OR o_custkey IS NULL) AND {KEY} % 37 <> 0 AND {KEY} % 41 <> 0""",
    "csv_rejects": _REJECTS,
}
