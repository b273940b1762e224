"""The stored table: daily integration, reruns, time travel, sources."""

import os

import pytest
from conftest import SF001, rows, same_bag
from pyspark.sql import types as T

from daybook import KeyContractError, flatten_changes
from daybook.plans.fixtures import KEY, N_DAYS, day_of, snapshots
from daybook.sources import io
from daybook.sources.store import Store


@pytest.fixture(scope="module")
def snaps(spark):
    return snapshots(spark, SF001)


def markers(store):
    return sorted(n for n in os.listdir(store.commit_root) if not n.startswith("."))


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"), KEY)


def test_integrate_all_days_and_time_travel(spark, snaps, store):
    results = [store.integrate(dump, d) for d, dump in snaps]
    assert [r["rows"] for r in results] == [s.count() for _, s in snaps]
    assert results[0]["inserts"] == results[0]["rows"] and results[0]["updates"] == 0
    for i in range(1, N_DAYS):  # T1 from the observed counts
        assert results[i]["rows"] == results[i - 1]["rows"] + results[i]["inserts"] - results[i]["deletes"]
    assert store.change_days() == [day_of(d) for d in range(N_DAYS)]  # D1: every day survives
    for t in range(N_DAYS):
        assert same_bag(store.as_of(day_of(t)), snaps[t][1])
        assert same_bag(store.undo_to(day_of(t)), snaps[t][1])


def test_rerun_is_idempotent(spark, snaps, store):  # T5
    for d, dump in snaps[:3]:
        store.integrate(dump, d)
    before = rows(flatten_changes(store.read_log(), KEY))
    again = store.integrate(snaps[2][1], snaps[2][0])
    assert rows(flatten_changes(store.read_log(), KEY)) == before
    assert again["rows"] == snaps[2][1].count()


def test_rerun_with_no_change_empties_the_day(spark, snaps, store):  # T5, D9
    store.integrate(snaps[0][1], day_of(0))
    store.integrate(snaps[1][1], day_of(1))
    r = store.integrate(snaps[0][1], day_of(1))  # day 1 rerun with day 0's content
    assert (r["inserts"], r["updates"], r["deletes"]) == (0, 0, 0)
    assert store.read_log(after=day_of(0)).isEmpty()
    assert store.read_log().count() == snaps[0][1].count()  # day 0 survives


def test_out_of_order_day_is_refused(spark, snaps, store):
    store.integrate(snaps[1][1], day_of(1))
    with pytest.raises(ValueError):
        store.integrate(snaps[0][1], day_of(0))


def test_pruned_versions_still_travel(spark, snaps, tmp_path):
    st = Store(spark, str(tmp_path / "pruned"), KEY, keep_snapshot_every=7)
    for d, dump in snaps:
        st.integrate(dump, d)
    assert len(st.snapshot_days()) < N_DAYS
    for t in range(N_DAYS):
        assert same_bag(st.as_of(day_of(t)), snaps[t][1])


def test_bad_keys_raise(spark, store):
    dup = spark.createDataFrame([(1, "a"), (1, "b")], "o_orderkey bigint, v string")
    with pytest.raises(KeyContractError):
        store.integrate(dup, day_of(0))
    nul = spark.createDataFrame([(None, "a"), (2, "b")], "o_orderkey bigint, v string")
    with pytest.raises(KeyContractError):
        store.integrate(nul, day_of(0))


def test_optional_read_only_swallows_missing_path(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.StringType())])
    df, found = io.read_optional(spark, str(tmp_path / "nope"), schema)
    assert not found and df.isEmpty() and df.schema == schema
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "part-0.parquet").write_bytes(b"not parquet at all")
    df, found = io.read_optional(spark, str(bad), schema)
    assert found
    with pytest.raises(Exception):
        df.collect()  # a corrupt file surfaces; it is not taken as "first run"


def test_csv_keeps_leading_zeros_and_accents(spark, tmp_path):
    schema = T.StructType([T.StructField("uid", T.StringType()), T.StructField("code", T.StringType()), T.StructField("commune", T.StringType())])
    p = tmp_path / "dump.csv"
    p.write_text("id,code,commune\nID00000001,06,Nîmes\nID00000002,2A,Évry\n", encoding="utf-8")
    df = io.read_dump_csv(spark, str(p), schema.__class__([T.StructField("id", T.StringType()), *schema.fields[1:]]), key="uid")
    assert df.columns == ["uid", "code", "commune"]
    assert rows(df) == [("ID00000001", "06", "Nîmes"), ("ID00000002", "2A", "Évry")]


def test_csv_header_mismatch_fails(spark, tmp_path):
    p = tmp_path / "dump.csv"
    p.write_text("id,zzz\nx,1\n", encoding="utf-8")
    with pytest.raises(Exception):
        io.read_dump_csv(spark, str(p), T.StructType([T.StructField("id", T.StringType()), T.StructField("code", T.StringType())])).collect()


def test_change_days_write_keeps_other_days(spark, snaps, tmp_path):
    from daybook import build_change_log

    root = str(tmp_path / "log")
    lg = build_change_log(snaps, KEY)
    io.write_change_days(lg, root)
    io.write_change_days(lg.filter(lg.day == day_of(4)), root)
    names = sorted(n for n in os.listdir(root) if n.startswith("day="))
    assert names == [f"day={day_of(d)}" for d in range(N_DAYS)]


def test_backfill_in_chunks_then_integrate(spark, snaps, store):
    from daybook import build_change_log

    assert store.backfill(snaps[:3], chunk_days=2) == [day_of(d) for d in range(3)]
    for d, dump in snaps[3:]:
        store.integrate(dump, d)
    assert store.change_days() == [day_of(d) for d in range(N_DAYS)]
    want = flatten_changes(build_change_log(snaps, KEY), KEY)
    assert rows(flatten_changes(store.read_log(), KEY)) == rows(want)
    for t in range(N_DAYS):
        assert same_bag(store.as_of(day_of(t)), snaps[t][1])


def test_backfill_refuses_overlap_and_bad_keys(spark, snaps, store):
    store.backfill(snaps[:2])
    with pytest.raises(ValueError):
        store.backfill(snaps[1:3])
    dup = snaps[2][1].unionByName(snaps[2][1].limit(1))
    with pytest.raises(KeyContractError):
        store.backfill([(day_of(2), dup)])


def test_interrupted_backfill_chunk_can_be_rerun(spark, snaps, store):
    from pyspark.sql import functions as F

    from daybook import build_change_log

    store.backfill(snaps[:2])
    # a crash after the change folders of days 2-3 were written, before their markers: a wrong log nobody sees
    bogus = build_change_log(snaps[2:4], KEY).withColumn("v", F.lit("000001-deadbeef"))
    bogus.write.mode("append").partitionBy("day", "v").parquet(store.change_root)
    assert store.change_days() == [day_of(0), day_of(1)]
    store.backfill(snaps[2:4])
    store.integrate(snaps[4][1], day_of(4))
    want = flatten_changes(build_change_log(snaps, KEY), KEY)
    assert rows(flatten_changes(store.read_log(), KEY)) == rows(want)


DRIFT = [  # b dropped, c added; then a's type changes; then b is back
    ("2025-01-01", [("x", 1, 10), ("y", 2, 20)], "k string, a int, b int"),
    ("2025-01-02", [("x", 1, 5), ("z", 3, 7)], "k string, a int, c int"),
    ("2025-01-03", [("x", 9, 5), ("z", 3, 7)], "k string, a int, c int"),
    ("2025-01-04", [("x", "9", 5), ("z", "three", 7)], "k string, a string, c int"),
    ("2025-01-05", [("x", "9", 10), ("w", None, 7)], "k string, a string, b int"),
    ("2025-01-06", [("x", "8", 10), ("w", None, 7)], "k string, a string, b int"),
]


@pytest.mark.parametrize("how", ["all", "pruned", "bucketed", "backfill"])
def test_every_day_keeps_its_own_columns(spark, tmp_path, how):
    st = Store(spark, str(tmp_path / how), "k", keep_snapshot_every=None if how == "all" else 1000, buckets=2 if how == "bucketed" else None)
    dumps = [(d, spark.createDataFrame(r, s)) for d, r, s in DRIFT]
    if how == "backfill":
        st.backfill(dumps, chunk_days=4, cast=True)
    else:
        for d, df in dumps:
            st.integrate(df, d, cast=True)
    for fresh in (st, Store(spark, st.root, "k")):
        for d, df in dumps:
            for got in (fresh.as_of(d), fresh.undo_to(d)):
                assert got.columns == df.columns and got.dtypes == df.dtypes and rows(got) == rows(df)
        log = fresh.read_log()
        assert log.schema["after"].dataType.fieldNames() == ["a", "b", "c"]
        # day 2: x loses b and gets c, y goes, z comes; day 4: types only, one text; day 5: x, z goes, w comes
        assert {r.day.isoformat(): r["count"] for r in log.groupBy("day").count().collect()}["2025-01-01"] == 2
        assert fresh.as_of("2024-12-31").columns == ["k", "a", "b"] and fresh.as_of("2024-12-31").isEmpty()


def test_backfill_equals_integrate_under_drift(spark, tmp_path):
    one, many = Store(spark, str(tmp_path / "i"), "k"), Store(spark, str(tmp_path / "b"), "k")
    dumps = [(d, spark.createDataFrame(r, s).withColumnRenamed("k", "id")) for d, r, s in DRIFT]
    for d, df in dumps:
        one.integrate(df, d, cast=True)
    many.backfill(dumps, chunk_days=3, cast=True)
    assert same_bag(one.read_log(), many.read_log())
    with pytest.raises(ValueError):
        many.backfill([("2026-01-01", dumps[-1][1])], chunk_days=0)


def test_drift_is_reached_over_pruned_versions(spark, tmp_path):
    st = Store(spark, str(tmp_path / "d"), "k")
    dumps = [(d, spark.createDataFrame(r, s)) for d, r, s in DRIFT]
    for d, df in dumps:
        st.integrate(df, d, cast=True)
    ls = st.listing()
    for d in ls.changes[1:]:  # by hand: only the first day's version is left
        v = ls.versions[d]
        if v.kept:
            os.rename(f"{st.commit_root}/{v.marker}", f"{st.commit_root}/{v.marker.replace('_' + v.kind + '_', '_log_')}")
    for d, df in dumps:
        assert rows(st.as_of(d)) == rows(df)


def test_keep_and_error_for_vanished_columns(spark, tmp_path):
    d0 = spark.createDataFrame([("x", 1, 10), ("y", 2, None)], "k string, a int, b int")
    d1 = spark.createDataFrame([("x", 1), ("y", 2)], "k string, a int")
    st = Store(spark, str(tmp_path / "k"), "k")
    st.integrate(d0, "2025-01-01")
    with pytest.raises(ValueError):
        st.integrate(d1, "2025-01-02", on_extra="error")
    assert st.integrate(d1, "2025-01-02", on_extra="keep")["updates"] == 1
    change = st.read_log(after="2025-01-01").first()
    assert (change.k, change.before.b, change.after.b) == ("x", 10, None)
    assert rows(st.as_of("2025-01-02")) == [("x", 1, None), ("y", 2, None)]


def test_last_day_reruns_on_a_pruned_store(spark, snaps, tmp_path):
    from daybook import build_change_log

    st = Store(spark, str(tmp_path / "p"), KEY, keep_snapshot_every=1000)
    for d, dump in snaps[:4]:
        st.integrate(dump, d)
    assert len(st.snapshot_days()) == 2  # the newest day and its base
    st.integrate(snaps[4][1], day_of(3))  # a wrong dump, then its correction
    st.integrate(snaps[3][1], day_of(3))
    st.integrate(snaps[4][1], day_of(4))
    assert rows(st.read_log()) == rows(build_change_log(snaps, KEY))
    bf = Store(spark, str(tmp_path / "b"), KEY)
    bf.backfill(snaps[:3])  # one version, of the last day: its base is replayed
    bf.integrate(snaps[4][1], day_of(2))
    bf.integrate(snaps[2][1], day_of(2))
    assert rows(bf.read_log()) == rows(build_change_log(snaps[:3], KEY))


@pytest.mark.parametrize("buckets", [None, 2])
@pytest.mark.parametrize("step", ["keys", "types", "diff", "write", "snapshot"])
def test_a_failed_rerun_changes_nothing(spark, tmp_path, monkeypatch, step, buckets):
    from daybook.sources import store as module

    st = Store(spark, str(tmp_path / "s"), "k", buckets=buckets)
    st.integrate(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), "2025-01-01")
    st.integrate(spark.createDataFrame([(1, "c")], "k int, v string"), "2025-01-02")
    log, before = rows(st.read_log()), markers(st)

    def broken(*args, **kwargs):
        raise RuntimeError(step)

    bad = spark.createDataFrame([(1, "x")], "k int, v string")
    if step == "keys":
        bad = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    elif step == "types":
        bad = spark.createDataFrame([(1, 5)], "k int, v int")
    elif step == "diff":
        monkeypatch.setattr(module, "snapshot_diff", broken)
    elif step == "write":
        writer = module.write_parquet
        monkeypatch.setattr(module, "write_parquet", lambda df, path: broken() if "/changes/" in path else writer(df, path))
    else:
        monkeypatch.setattr(Store, "_write_snapshot", broken)
    with pytest.raises(Exception):
        st.integrate(bad, "2025-01-02")
    monkeypatch.undo()
    again = Store(spark, st.root, "k", buckets=buckets)
    assert markers(st) == before
    assert rows(again.read_log()) == log and rows(again.as_of("2025-01-02")) == [(1, "c")]
    for sub in ("snapshot", "changes"):  # nothing of the failed attempt is left
        assert len(os.listdir(f"{st.root}/{sub}/day=2025-01-02")) == 1


def test_a_stop_between_switch_and_removal(spark, tmp_path, monkeypatch):
    st = Store(spark, str(tmp_path / "s"), "k")
    st.integrate(spark.createDataFrame([(1, "a")], "k int, v string"), "2025-01-01")
    with monkeypatch.context() as m:
        m.setattr(Store, "_remove", lambda self, v: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            st.integrate(spark.createDataFrame([(1, "b")], "k int, v string"), "2025-01-01")
    assert len(markers(st)) == 2
    assert rows(st.as_of("2025-01-01")) == [(1, "b")] and st.read_log().count() == 1
    st.integrate(spark.createDataFrame([(1, "c")], "k int, v string"), "2025-01-02")
    assert st.read_log().count() == 2 and len(markers(st)) == 2


def test_first_load_has_no_shuffle(spark, tmp_path, monkeypatch):
    from daybook.sources import store as module

    plans, writer = [], module.write_parquet
    monkeypatch.setattr(module, "write_parquet", lambda df, path: (plans.append((path, _plan(df))), writer(df, path)))
    Store(spark, str(tmp_path / "s"), "k").integrate(spark.range(100).selectExpr("id AS k", "id AS v"), "2025-01-01")
    assert [p for path, p in plans if "/changes/" in path and "Exchange" in p] == []


# -- bucketed snapshot versions ------------------------------------------------------
def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_store_equals_plain_store(spark, snaps, tmp_path):
    plain, bucketed = Store(spark, str(tmp_path / "p"), KEY), Store(spark, str(tmp_path / "b"), KEY, buckets=4)
    for d, dump in snaps:
        assert plain.integrate(dump, d) == bucketed.integrate(dump, d)
    assert same_bag(plain.read_log(), bucketed.read_log())
    assert set(bucketed.listing().buckets.values()) == {4}
    assert spark.catalog.listTables() == []  # catalog entries are transient
    for t in range(N_DAYS):
        assert same_bag(bucketed.as_of(day_of(t)), snaps[t][1])
        assert same_bag(bucketed.undo_to(day_of(t)), snaps[t][1])
    again = bucketed.integrate(snaps[-1][1], snaps[-1][0])  # rerun rewrites its own bucketed version
    assert again["rows"] == snaps[-1][1].count()
    assert same_bag(plain.read_log(), bucketed.read_log())


def test_bucketed_versions_diff_and_check_keys_without_shuffle(spark, snaps, tmp_path):
    from daybook import compare, key_problems, snapshot_diff
    from daybook.operators.keys import offending_keys

    st = Store(spark, str(tmp_path / "b"), KEY, buckets=4)
    for d, dump in snaps[:2]:
        st.integrate(dump, d)
    ls = st.listing()
    prev, new = st.read_snapshot(day_of(0), ls), st.read_snapshot(day_of(1), ls)
    diff = _plan(snapshot_diff(prev, new, KEY, day_of(1), validate=False))
    assert "Exchange" not in diff and diff.count("Bucketed: true") == 2, diff
    check = _plan(key_problems(new, KEY))
    assert "hashpartitioning" not in check, check
    both = _plan(offending_keys({"previous": prev, "new": new}, KEY))  # the check before a diff/compare
    assert "hashpartitioning" not in both, both
    cmp = _plan(compare(prev, new, KEY, strategy="hash", validate=False))
    assert "Exchange" not in cmp, cmp


def test_bucketed_backfill_and_bad_keys(spark, snaps, tmp_path):
    st = Store(spark, str(tmp_path / "b"), KEY, buckets=3)
    st.backfill(snaps[:3], chunk_days=2)
    for d, dump in snaps[3:]:
        st.integrate(dump, d)
    for t in range(N_DAYS):
        assert same_bag(st.as_of(day_of(t)), snaps[t][1])
    bad = Store(spark, str(tmp_path / "bad"), "o_orderkey", buckets=2)
    dup = spark.createDataFrame([(1, "a"), (1, "b")], "o_orderkey bigint, v string")
    with pytest.raises(KeyContractError):
        bad.integrate(dup, day_of(0))
    assert bad.listing().snapshots == []


def test_bucketed_store_with_a_composite_key(spark, snaps, tmp_path):
    from pyspark.sql import functions as F

    from daybook import snapshot_diff

    def split(df):  # the order key as (k1, k2)
        k = F.col(KEY)
        return df.select((k % 7).alias("k1"), (k / 7).cast("bigint").alias("k2"), *[c for c in df.columns if c != KEY])

    plain, bucketed = Store(spark, str(tmp_path / "p"), ["k1", "k2"]), Store(spark, str(tmp_path / "b"), ["k1", "k2"], buckets=3)
    for d, dump in snaps[:4]:
        assert plain.integrate(split(dump), d) == bucketed.integrate(split(dump), d)
    assert same_bag(plain.read_log(), bucketed.read_log())
    assert same_bag(bucketed.as_of(day_of(1)), split(snaps[1][1]))
    assert "Exchange" not in _plan(
        snapshot_diff(
            bucketed.read_snapshot(day_of(2)), bucketed.read_snapshot(day_of(3)), ["k1", "k2"], day_of(3), validate=False
        )
    )


def test_days_committed_without_a_snapshot(spark, snaps, tmp_path):
    st = Store(spark, str(tmp_path / "s"), KEY)
    st.backfill(snaps[:2], chunk_days=2)
    st.backfill(snaps[2:], chunk_days=3)
    # a stop while the second chunk's days were being committed: its last day is missing
    os.remove(f"{st.commit_root}/{st.listing().versions[day_of(N_DAYS - 1)].marker}")
    assert st.latest_day() == day_of(N_DAYS - 2)
    for t in range(N_DAYS - 1):
        assert same_bag(st.undo_to(day_of(t)), snaps[t][1])
        assert same_bag(st.as_of(day_of(t)), snaps[t][1])
    st.integrate(snaps[-1][1], day_of(N_DAYS - 1))  # on the replayed table
    assert same_bag(st.as_of(day_of(N_DAYS - 1)), snaps[-1][1])


def test_bucketed_store_with_the_digest_strategy(spark, snaps, tmp_path):
    plain = Store(spark, str(tmp_path / "p"), KEY)
    hashed = Store(spark, str(tmp_path / "h"), KEY, buckets=3, strategy="hash")
    for d, dump in snaps:
        assert plain.integrate(dump, d) == hashed.integrate(dump, d)
    assert same_bag(plain.read_log(), hashed.read_log())


def test_markers_alone_decide(spark, snaps, tmp_path):
    st = Store(spark, str(tmp_path / "s"), KEY)
    for d, dump in snaps[:2]:
        st.integrate(dump, d)
    v = st.listing().versions[day_of(1)]
    # part files and Spark's own _SUCCESS don't decide anything
    for root in (st.snapshot_root, st.change_root):
        os.remove(f"{root}/day={v.day}/v={v.attempt}/_SUCCESS")
    assert st.complete_days() == [day_of(0), day_of(1)]
    os.remove(f"{st.commit_root}/{v.marker}")
    assert st.complete_days() == [day_of(0)]
    assert st.read_log().filter("day > DATE'2025-01-01'").isEmpty()
    st.integrate(snaps[1][1], day_of(1))  # rerunning the day commits it again
    assert st.complete_days() == [day_of(0), day_of(1)]


def test_a_plain_rewrite_drops_the_days_bucket_marker(spark, snaps, tmp_path):
    root = str(tmp_path / "s")
    Store(spark, root, KEY, buckets=2).integrate(snaps[0][1], day_of(0))
    plain = Store(spark, root, KEY)
    assert plain.listing().buckets == {day_of(0): 2}
    plain.integrate(snaps[0][1], day_of(0))  # rerun of the day, written plain
    assert plain.listing().buckets == {}
    assert "Bucketed: true" not in _plan(plain.read_snapshot())
    assert same_bag(plain.read_snapshot(), snaps[0][1])
