"""Columns that go on under new names: found by their values, and kept by the store."""

import datetime as dt

import pytest
from conftest import rows
from test_history import day, random_days

from daybook.operators.renames import column_matches, renamed_columns
from daybook.operators.schema import align_columns
from daybook.sources.store import Store


def wide(spark, n, cols, shift=0):
    return spark.createDataFrame([(k, *(f(k + shift) for f in cols.values())) for k in range(n)], ", ".join(["k int", *cols]))


def test_renames_are_found_by_values(spark):
    prev = wide(spark, 400, {"a string": lambda k: f"v{k}", "b string": lambda k: "xyz"[k % 3], "c int": lambda k: k * 7, "keep int": lambda k: k})
    new = wide(
        spark, 500, {"keep int": lambda k: k, "one string": lambda k: f"v{k}" if k % 20 else None, "two string": lambda k: "xyz"[k % 3], "three bigint": lambda k: k * 7}
    )
    found = {(r.old, r.new): r for r in column_matches(prev, new, "k").collect()}
    assert {p for p, r in found.items() if r.chosen} == {("a", "one"), ("b", "two")}  # c has another type
    r = found["a", "one"]
    assert (r.agreed, r.filled_old, r.filled_new) == (380, 400, 380) and r.share == 0.95
    assert renamed_columns(prev, new, "k") == {"a": "one", "b": "two"}
    assert renamed_columns(prev, new, "k", min_share=0.96) == {"b": "two"}
    assert renamed_columns(prev, prev, "k") == {} and column_matches(prev, prev, "k").count() == 0
    assert renamed_columns(prev.where("false"), new, "k") == {} and renamed_columns(prev, new.where("false"), "k") == {}


def test_agreement_by_chance_is_no_rename(spark):
    # two flags that are nearly always false agree on 96 of 100 keys, a constant on all, nulls on none
    prev = wide(spark, 1000, {"p boolean": lambda k: k % 50 == 0, "const int": lambda k: 1, "none string": lambda k: None})
    new = wide(spark, 1000, {"q boolean": lambda k: k % 50 == 7, "const2 int": lambda k: 1, "none2 string": lambda k: None})
    found = {(r.old, r.new): r for r in column_matches(prev, new, "k").collect()}
    assert set(found) == {("p", "q"), ("const", "const2")} and not any(r.chosen for r in found.values())
    assert found["p", "q"].share == 0.96 and abs(found["p", "q"].above_chance) < 0.05
    assert found["const", "const2"].above_chance is None
    assert renamed_columns(prev, new, "k") == {}
    moved = prev.withColumnRenamed("p", "q").drop("const", "none")
    assert renamed_columns(prev, moved, "k") == {"p": "q"}


def test_a_tie_is_no_rename_and_the_better_pair_goes_first(spark):
    value = lambda k: f"v{k}"
    prev = wide(spark, 300, {"a string": value})
    twice = wide(spark, 300, {"x string": value, "y string": value})
    assert renamed_columns(prev, twice, "k") == {}
    better = wide(spark, 300, {"x string": lambda k: value(k) if k % 30 else "other", "y string": value})
    assert renamed_columns(prev, better, "k") == {"a": "y"}


def test_values_of_all_kinds_and_any_names(spark):
    ddl = "k1 int, k2 string, `a.b` struct<x:int,y:array<int>>, `m\"m` map<string,int>, d double, t timestamp"
    t = dt.datetime(2025, 1, 1)
    data = [
        (k, "s", (None, [k]) if k % 2 else (k, [None]), {"p": k, "q": None}, [0.0, -0.0, float("nan"), 1.5, None][k % 5], t + dt.timedelta(microseconds=k)) for k in range(200)
    ]
    prev = spark.createDataFrame(data, ddl)
    names = {"a.b": "_old", 'm"m': "h", "d": "c", "t": "e"}
    flipped = [(a, b, s, dict(reversed(m.items())), 0.0 if d == 0 else d, t) for a, b, s, m, d, t in data]
    new = spark.createDataFrame(flipped, ddl).withColumnsRenamed(names)
    assert renamed_columns(prev, new, ["k1", "k2"]) == names


def test_align_with_renames(spark):
    df = spark.createDataFrame([(1, "x", 2)], "k int, a string, b int")
    target = spark.createDataFrame([], "k int, new string, b bigint").schema
    assert [tuple(r) for r in align_columns(df, target, cast=True, renames={"a": "new"}).collect()] == [(1, "x", 2)]
    with pytest.raises(ValueError, match="one name"):
        align_columns(df, target, renames={"a": "b"})
    with pytest.raises(ValueError, match="lacks"):
        align_columns(df, target, renames={"z": "new"})


#: (names on each day, what the day is told); the first two columns of the tables.
NAMES = [("v", "w"), ("v", "w"), ("word", "w"), ("word", "w"), ("word", "num"), ("text", "num"), ("text", "num")]
TOLD = {2: {"v": "word"}, 4: {"w": "num"}, 5: {"word": "text"}}


def dumps(spark, seed=3):
    days = random_days(seed, len(NAMES))
    return days, [spark.createDataFrame([(k, *x) for k, x in t.items()], f"k int, {v} string, {w} double") for t, (v, w) in zip(days, NAMES)]


def plain_log(days):
    out, before = [], {}
    for i, now in enumerate(days):
        for k in before.keys() | now.keys():
            if before.get(k) != now.get(k):
                out.append((k, before.get(k), now.get(k), day(i)))
        before = now
    return sorted(out, key=repr)


def image(row):
    return None if row is None else (row.text, row.num)


def check(store, days):
    for i, table in enumerate(days):
        for f in (store.as_of, store.undo_to):
            df = f(day(i))
            assert df.columns == ["k", *NAMES[i]] and {r[0]: (r[1], r[2]) for r in df.collect()} == table
        counts = {}
        for v, _ in table.values():
            counts[v] = counts.get(v, 0) + 1
        assert {r[0]: r[1] for r in store.group_count(NAMES[i][0], day(i)).collect()} == counts
    log = store.read_log()
    assert log.schema["after"].dataType.fieldNames() == ["text", "num"]
    # -0.0 equals 0.0 in Python as well
    assert sorted(((r.k, image(r.before), image(r.after), r.day) for r in log.collect()), key=repr) == plain_log(days)


@pytest.mark.parametrize("keep", [None, 1000])
def test_store_keeps_history_over_renames(spark, tmp_path, keep):
    days, frames = dumps(spark)
    store = Store(spark, str(tmp_path / "s"), "k", keep_snapshot_every=keep)
    for i, df in enumerate(frames):
        counts = store.integrate(df, day(i), renames=TOLD.get(i))
        assert counts.get("renames") == TOLD.get(i)
    if keep:
        store.compact_log()
    check(Store(spark, store.root, "k"), days)


def test_backfill_over_renames(spark, tmp_path):
    days, frames = dumps(spark, 4)
    store = Store(spark, str(tmp_path / "s"), "k")
    dated = [(day(i), df) for i, df in enumerate(frames)]
    with pytest.raises(ValueError, match="columns of the day before"):
        store.backfill(dated, renames={day(3): {"v": "word"}})
    store.backfill(dated, chunk_days=2, renames={day(i): r for i, r in TOLD.items()})
    check(Store(spark, store.root, "k"), days)


def test_late_and_corrected_days_keep_renames(spark, tmp_path):
    days, frames = dumps(spark, 5)
    store = Store(spark, str(tmp_path / "s"), "k")
    empty = [df.where("false") for df in frames]
    for i, told in ((0, None), (2, TOLD[2]), (4, TOLD[4]), (6, {"word": "text"})):
        store.integrate(frames[i], day(i), renames=told)
    store.integrate(empty[5], day(5), late="insert")  # day 5 has day 6's names: the renames move there
    store.integrate(empty[3], day(3), late="insert")  # day 3 has day 2's: they stay with day 4
    store.integrate(frames[1], day(1), late="insert")
    for i in (5, 3):  # corrected: both neighbours' renames stay
        counts = store.integrate(frames[i], day(i), late="insert")
        assert counts.get("renames") == TOLD.get(i)
    check(Store(spark, store.root, "k"), days)
    assert len(store.file_names(store.renames_root)) == 3  # those of replaced attempts are gone


def test_renames_are_checked_and_a_failed_day_leaves_none(spark, tmp_path, monkeypatch):
    days, frames = dumps(spark, 6)
    store = Store(spark, str(tmp_path / "s"), "k")
    store.integrate(frames[0], day(0), renames="detect")
    for wrong in ({"v": "w"}, {"x": "word"}, {"k": "word"}, {"v": "nowhere"}):
        with pytest.raises(ValueError, match="don't take a column"):
            store.integrate(frames[2], day(1), renames=wrong)
    doubled = frames[2].unionAll(frames[2])
    with pytest.raises(Exception, match="(?i)key"):
        store.integrate(doubled, day(1), renames={"v": "word"})
    monkeypatch.setattr(store, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        store.integrate(frames[2], day(1), renames={"v": "word"})
    monkeypatch.undo()
    assert store.change_days() == [day(0)] and rows(store.as_of(day(1))) == rows(frames[0])


def test_names_that_come_back_stay_apart(spark, tmp_path):
    """``a`` leaves, and later ``b`` becomes ``a``: the log keeps the first ``a`` and calls ``b`` so only after that."""
    store = Store(spark, str(tmp_path / "s"), "k")
    one = spark.createDataFrame([(1, "x", "y")], "k int, a string, b string")
    store.integrate(one, day(0))
    store.integrate(one.drop("a"), day(1))
    store.integrate(one.drop("a").withColumnRenamed("b", "a"), day(2), renames={"b": "a"})
    log = store.read_log()
    first = log.where(log.day == str(day(0))).first().after
    assert (first.a, first.b) == ("x", "y") and log.where(log.day == str(day(2))).count() == 0
    assert [tuple(r) for r in store.as_of(day(2)).collect()] == [(1, "y")]
    assert [(r.a, r["count"]) for r in store.group_count("a", day(2)).collect()] == [("y", 1)]
