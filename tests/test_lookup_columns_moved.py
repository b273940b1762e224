"""Point-in-time lookups, column-level changes, moved rows: against plain Python."""

import random
from collections import Counter

import pytest
from conftest import rows
from test_history import day, frame, random_days

from daybook.operators.columns import changes_of_column, column_change_counts, leaves, path_name, with_change_mask
from daybook.operators.lookup import intervals, lookup
from daybook.operators.moved import compare_moved
from daybook.operators.replay import build_change_log


# -- lookups ---------------------------------------------------------------------------


@pytest.mark.parametrize("hot_rows", [1_000_000, 20])
def test_lookup_equals_the_days_tables(spark, hot_rows):
    days = random_days(5, 8)
    log = build_change_log([(day(i), frame(spark, t)) for i, t in enumerate(days)], "k")
    rng = random.Random(1)
    # one key has a third of all probes; days before the first and after the last; repeated and null probes
    probes = [(n, rng.choice([3] * 6 + list(range(13))), rng.randrange(-2, 11)) for n in range(300)]
    asked = [(n, k, day(i)) for n, k, i in probes] + [(900, None, day(1)), (901, 3, None), (902, 3, day(4)), (902, 3, day(4))]
    df = spark.createDataFrame(asked, "n int, k int, day date").repartition(3)
    got = sorted((r.n, r.k, r.day, (r.at.row.v, r.at.row.w) if r.at else None) for r in lookup(log, df, "k", hot_rows=hot_rows).collect() if r.n < 900)
    want = sorted((n, k, day(i), days[min(i, 7)].get(k) if i >= 0 else None) for n, k, i in probes)
    assert got == want
    rest = [r for r in lookup(log, df, "k", hot_rows=hot_rows).collect() if r.n >= 900]
    assert len(rest) == 4 and [r.at for r in rest if r.n < 902] == [None, None] and len({r.at for r in rest if r.n == 902}) == 1


def test_intervals_tile_the_days(spark):
    days = random_days(6, 9)
    log = build_change_log([(day(i), frame(spark, t)) for i, t in enumerate(days)], "k")
    held = intervals(log, "k").collect()
    for i, t in enumerate(days):
        now = {r.k: (r.row.v, r.row.w) for r in held if r.valid_from <= day(i) and (r.valid_to is None or day(i) < r.valid_to)}
        assert now == t
        assert sum(r.valid_from <= day(i) and (r.valid_to is None or day(i) < r.valid_to) for r in held) == len(t)


def test_lookup_names_and_plan(spark):
    log = build_change_log([(day(0), spark.createDataFrame([(1, "x", 5, "r")], "a int, b string, day int, row string"))], ["a", "b"])
    probes = spark.createDataFrame([(1, "x", day(2), "q", 7), (1, "y", day(2), "q", 7)], "p int, b string, at_day date, row string, _k0 int")
    out = lookup(log, probes, ["a", "b"], "at_day", ["p", "b"], into="was")
    assert out.columns == [*probes.columns, "was"]
    assert [r.was.row.asDict() if r.was else None for r in out.orderBy("b").collect()] == [{"day": 5, "row": "r"}, None]
    with pytest.raises(ValueError, match="name another"):
        lookup(log, probes, ["a", "b"], "at_day", ["p", "b"], into="row")
    with pytest.raises(ValueError, match="match"):
        lookup(log, probes, ["a", "b"], "at_day", ["p"])
    assert lookup(log, probes.where("false"), ["a", "b"], "at_day", ["p", "b"]).count() == 0


def test_one_shuffle_a_side(spark):
    built = build_change_log([(day(i), frame(spark, t)) for i, t in enumerate(random_days(2, 3))], "k")
    log = spark.createDataFrame(built.collect(), built.schema)
    probes = spark.createDataFrame([(1, day(1))], "k int, day date")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = lookup(log, probes, "k")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2


# -- columns -----------------------------------------------------------------------------

WIDE = "k int, a string, s struct<x:int,y:struct<z:string>>, l array<int>, m map<string,int>, f double, `d.t` int"


def test_masks_of_nested_columns(spark):
    base = (1, "a", (1, ("z",)), [1, None], {"p": 1, "q": 2}, 0.0, 5)
    after = [
        ((1, "b", *base[2:]), {"a"}),
        ((1, None, *base[2:]), {"a"}),
        ((1, "a", (2, ("z",)), *base[3:]), {"s.x"}),
        ((1, "a", (1, (None,)), *base[3:]), {"s.y.z"}),
        ((1, "a", (1, None), *base[3:]), {"s.y.z"}),
        ((1, "a", None, *base[3:]), {"s.x", "s.y.z"}),
        ((1, "a", base[2], [None, 1], *base[4:]), {"l"}),
        ((1, "a", base[2], base[3], {"q": 2, "p": 1}, -0.0, 6), {"`d.t`"}),  # the same map, the same zero
        ((1, "a", base[2], base[3], {"p": 1}, float("nan"), None), {"m", "f", "`d.t`"}),
    ]
    names = [path_name(p) for p, _ in leaves(spark.createDataFrame([], WIDE).drop("k").schema)]
    assert names == ["a", "s.x", "s.y.z", "l", "m", "f", "`d.t`"]
    for row, want in after:
        log = build_change_log([(day(0), spark.createDataFrame([base], WIDE)), (day(1), spark.createDataFrame([row], WIDE))], "k")
        masks = {r.op: r.mask for r in with_change_mask(log).collect()}
        assert masks["INSERT"] is None
        assert {n for i, n in enumerate(names) if masks["UPDATE"][i // 64] >> i % 64 & 1} == want
        counts = {r.column: (r.updates, r.changed) for r in column_change_counts(log).collect()}
        assert counts == {n: (1, int(n in want)) for n in names}


def test_a_struct_that_becomes_null_changes_its_fields(spark):
    kind = "k int, s struct<x:int>, o int"
    log = build_change_log([(day(0), spark.createDataFrame([(1, (None,), 1)], kind)), (day(1), spark.createDataFrame([(1, None, 1)], kind))], "k")
    assert {r.column: r.changed for r in column_change_counts(log).collect()} == {"s.x": 1, "o": 0}


def test_more_than_64_columns(spark):
    from pyspark.sql import functions as F

    a = spark.range(3).select("id", *[F.lit(i).alias(f"c{i}") for i in range(150)])
    b = a.withColumns({f"c{i}": F.lit(-1) for i in (0, 63, 64, 127, 128, 149)})
    log = build_change_log([(day(0), a), (day(1), b)], "id")
    assert {r.column for r in column_change_counts(log).collect() if r.changed == 3} == {f"c{i}" for i in (0, 63, 64, 127, 128, 149)}
    assert len(with_change_mask(log).where("op = 'UPDATE'").first().mask) == 3
    assert changes_of_column(log, "id", "c64").count() == 3 == changes_of_column(log, "id", "c149").count() and changes_of_column(log, "id", "c65").count() == 0


def test_changes_of_a_column(spark):
    days = random_days(8, 6)
    log = build_change_log([(day(i), frame(spark, t)) for i, t in enumerate(days)], "k")
    want = [
        (k, day(i), days[i - 1][k][0], t[k][0]) for i, t in enumerate(days) if i for k in t if k in days[i - 1] and days[i - 1][k][0] != t[k][0]
    ]
    assert rows(changes_of_column(log, "k", "v")) == sorted(want, key=repr)
    with pytest.raises(ValueError, match="no column"):
        changes_of_column(log, "k", "nope")
    with pytest.raises(ValueError, match="another one"):
        with_change_mask(log, "op")
    nested = build_change_log([(day(i), spark.createDataFrame([(1, (i,))], "k int, s struct<x:int>")) for i in range(2)], "k")
    assert rows(changes_of_column(nested, "k", "s.x")) == [(1, day(1), 0, 1)] == rows(changes_of_column(nested, "k", ("s", "x")))


def test_columns_over_drift(spark, tmp_path):
    from daybook.sources.store import Store

    st = Store(spark, str(tmp_path / "s"), "k")
    st.integrate(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), day(0))
    st.integrate(spark.createDataFrame([(1, "a", None), (2, "b", 7)], "k int, v string, n int"), day(1))
    got = {(r.day, r.column): r.changed for r in column_change_counts(st.read_log()).collect()}
    # only the row with a value in the new column is an update at all
    assert got == {(day(1), "v"): 0, (day(1), "n"): 1}


# -- moved rows ----------------------------------------------------------------------------


def plain_moves(a, b):
    out = [(k, "UNCHANGED" if a[k] == b[k] else "MODIFIED", None) for k in a if k in b]
    gone, come = {}, {}
    for side, mine, other in ((gone, a, b), (come, b, a)):
        for k in sorted(mine):
            if k not in other:
                side.setdefault(mine[k], []).append(k)
    for content in set(gone) | set(come):
        g, c = gone.get(content, []), come.get(content, [])
        out += [(x, "MOVED", y) for x, y in zip(g, c)] + [(x, "REMOVED", None) for x in g[len(c) :]] + [(x, "ADDED", None) for x in c[len(g) :]]
    return sorted(out, key=repr)


def test_moved_equals_plain(spark):
    rng = random.Random(4)
    contents = [("same", 1.0)] * 5 + [(None, None), ("x", 0.0), ("y", -2.5)]  # one content has most rows
    a = {k: rng.choice(contents) for k in range(200)}
    b = {k: rng.choice(contents) if rng.random() < 0.3 else v for k, v in a.items() if rng.random() < 0.6}
    b |= {1000 + k: rng.choice(contents) for k in range(90)}
    got = sorted(((r.k, r.change, r.to.k if r.to else None) for r in compare_moved(frame(spark, a).repartition(5), frame(spark, b), "k").collect()), key=repr)
    assert got == plain_moves(a, b) and Counter(c for _, c, _ in got)["MOVED"] > 50


def test_moved_edges(spark):
    empty, one = frame(spark, {}), frame(spark, {1: ("a", 1.0)})
    assert compare_moved(empty, empty, "k").collect() == []
    assert [(r.k, r.change) for r in compare_moved(empty, one, "k").collect()] == [(1, "ADDED")]
    keys_only = compare_moved(spark.createDataFrame([(1,)], "k int"), spark.createDataFrame([(2,)], "k int"), "k")
    assert {(r.k, r.change) for r in keys_only.collect()} == {(1, "REMOVED"), (2, "ADDED")}
    kind = "a int, b string, v map<string,int>"
    x = spark.createDataFrame([(1, "p", {"u": 1, "w": 2})], kind)
    y = spark.createDataFrame([(2, "q", {"w": 2, "u": 1})], kind)
    assert [(r.a, r.b, r.change, tuple(r.to)) for r in compare_moved(x, y, ["a", "b"]).collect()] == [(1, "p", "MOVED", (2, "q"))]


def test_ranks_of_a_shared_content_are_dealt_out(spark):
    """Content that all rows share lies in many ranges."""
    from pyspark.sql import functions as F

    from daybook.operators import moved

    seen = spark.range(20_000).select("id", F.unhex(F.sha2(F.lit("x"), 256)).alias("_hash"))
    ranked = moved._ranked(seen, ["id"], "ranks")
    assert ranked.where("_rank <> id + 1").count() == 0
    part = seen.repartitionByRange(8, "_hash", "id").select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert len(part) == 8 and max(r["count"] for r in part) < 6000
