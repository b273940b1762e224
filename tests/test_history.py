"""Composed changes, the ladder of merged days, days that come late."""

import datetime as dt
import os
import random

import pytest
from conftest import SF001, rows, same_bag

from daybook.operators.compose import compose
from daybook.operators.diff import change_log_schema
from daybook.operators.replay import apply_changes, build_change_log, undo_to
from daybook.plans.fixtures import KEY, day_of, snapshots
from daybook.sources import ladder
from daybook.sources import store as module
from daybook.sources.store import Store

SCHEMA = "k int, v string, w double"


def day(i):
    return dt.date(2025, 3, 1) + dt.timedelta(days=i)


def random_days(seed, n, keys=12):
    """Dumps as {key: (v, w)} a day: rows come, go, come back and change."""
    rng, out, now = random.Random(seed), [], {}
    for _ in range(n):
        for k in range(keys):
            if rng.random() < 0.35:
                now.pop(k, None) if rng.random() < 0.4 else now.__setitem__(k, (rng.choice([None, "a", "b"]), rng.choice([None, 0.0, -0.0, 1.5])))
        out.append(dict(now))
    return out


def frame(spark, table):
    return spark.createDataFrame([(k, *v) for k, v in table.items()], SCHEMA)


def as_table(df):
    return {r.k: (r.v, r.w) for r in df.collect()}


def loaded(spark, path, days, at, **options):
    """A store with the days at the given offsets, from one pass: only the first and last versions are kept."""
    st = Store(spark, str(path), "k", **options)
    st.backfill([(day(at[0]), frame(spark, days[0]))])
    st.backfill([(day(i), frame(spark, t)) for i, t in zip(at[1:], days[1:])], chunk_days=len(at))
    return st


# -- composition ---------------------------------------------------------------------


def net(log):
    """Plain composition: {key: (op, before, after, day)}."""
    out = {}
    for k in {r.k for r in log}:
        mine = sorted((r for r in log if r.k == k), key=lambda r: r.day)
        before, after = mine[0].before, mine[-1].after
        if before == after:
            continue
        out[k] = ("INSERT" if before is None else "DELETE" if after is None else "UPDATE", before, after, mine[-1].day)
    return out


def test_compose_equals_plain_and_is_associative(spark):
    days = random_days(1, 9)
    log = build_change_log([(day(i), frame(spark, t)) for i, t in enumerate(days)], "k").cache()
    found = log.collect()

    def got(df):
        return {r.k: (r.op, r.before, r.after, r.day) for r in df.collect()}

    for lo, hi in ((0, 8), (2, 6), (3, 4), (5, 5)):
        part = log.where(f"day BETWEEN DATE '{day(lo)}' AND DATE '{day(hi)}'")
        assert got(compose(part, "k")) == net([r for r in found if day(lo) <= r.day <= day(hi)])
    halves = [compose(log.where(f"day {c} DATE '{day(4)}'"), "k") for c in ("<=", ">")]
    want = got(compose(log, "k"))
    both = got(compose(halves[0].unionByName(halves[1]), "k"))
    # a key that vanished in one half keeps the other's day
    assert {k: v[:3] for k, v in both.items()} == {k: v[:3] for k, v in want.items()}
    # replay over the net changes, both ways
    since = compose(log.where(f"day > DATE '{day(2)}'"), "k")
    assert as_table(apply_changes(frame(spark, days[2]), since, "k")) == days[8]
    assert as_table(undo_to(frame(spark, days[8]), since, day(2), "k")) == days[2]


def test_what_vanishes(spark):
    days = [{1: ("a", 0.0)}, {2: ("b", 1.0)}, {1: ("a", -0.0), 3: ("x", None)}, {1: ("a", 0.0), 3: (None, None)}]
    log = build_change_log([(day(i), frame(spark, t)) for i, t in enumerate(days)], "k")
    got = {r.k: r.op for r in compose(log.where(f"day > DATE '{day(0)}'"), "k").collect()}
    # 1: gone and back with the same content; 2: came and went; 3: came, all null at last
    assert got == {3: "INSERT"}
    assert compose(log.where("false"), "k").collect() == []


def test_compose_maps_and_composite_keys(spark):
    kind = "a int, b string, m map<string,int>"
    days = [[(1, "x", {"p": 1, "q": 2})], [(1, "x", {"p": 9})], [(1, "x", {"q": 2, "p": 1})]]
    log = build_change_log([(day(i), spark.createDataFrame(t, kind)) for i, t in enumerate(days)], ["a", "b"])
    assert compose(log.where(f"day > DATE '{day(0)}'"), ["a", "b"]).count() == 0  # the same map in another order
    assert compose(log, ["a", "b"]).schema["after"].dataType == change_log_schema(spark.createDataFrame(days[0], kind), ["a", "b"])["after"].dataType


# -- the ladder ------------------------------------------------------------------------


class V:
    def __init__(self, i, attempt="000001", schema="s"):
        self.day, self.attempt, self.schema = day(i), attempt, schema


def test_cover_is_logarithmic_and_exact():
    versions = {day(i): V(i) for i in range(1000) if i % 7}
    run = list(versions.values())
    names = [
        ladder.Block(index, level, f"{0:012x}", ladder.days_mark(mine), f"{1:016x}").marker
        for level in range(1, 11)
        for index, mine in ladder.missing(versions, {}, level)
    ]
    blocks, stale = ladder.valid(names, versions)
    assert len(blocks) == len(names) and not stale
    rng = random.Random(3)
    for _ in range(300):
        lo, hi = sorted(rng.sample(range(len(run)), 2))
        parts = ladder.cover(run[lo : hi + 1], blocks)
        days = [d for p in parts for d in (p.days if isinstance(p, ladder.Block) else [p.day])]
        assert days == [v.day for v in run[lo : hi + 1]] and len(parts) <= 20
    # a day rerun: the blocks with it are stale, no others
    versions[day(100)] = V(100, "000002")
    good, stale = ladder.valid(names, versions)
    assert {b.level for b in stale} == {b.level for b in blocks.values() if day(100) in b.days} and len(good) + len(stale) == len(names)


@pytest.mark.parametrize("buckets", [None, 3])
def test_time_travel_over_merged_days(spark, tmp_path, buckets):
    at = [i for i in range(21) if i not in (4, 5, 11)]
    days = random_days(7, len(at))
    st = loaded(spark, tmp_path / "s", days, at, buckets=buckets)
    log = rows(st.read_log())
    built = st.compact_log()
    assert {level for *_, level in built} >= {1, 2, 3} and st.compact_log() == []
    assert rows(st.read_log()) == log  # the log keeps every day
    for i, t in zip(at, days):
        for df in (st.as_of(day(i)), st.undo_to(day(i))):
            assert as_table(df) == t
    # folders opened: a few, not one a day
    for df in (st.as_of(day(at[-2])), st.undo_to(day(at[0]))):
        folders = {os.path.dirname(f) for f in df.inputFiles() if "/snapshot/" not in f}
        assert 0 < len(folders) <= 2 * 4 < len(at) - 2
        assert any("/merged/" in f for f in folders)
    # a folder of its own for a whole range: no reduction of the changes
    first, last, _ = max(built, key=lambda b: b[2])
    versions = st.listing().versions
    assert len(st._parts(st.listing(), [versions[d] for d in versions if first <= d <= last])) == 1


def test_merged_blocks_follow_reruns(spark, tmp_path, monkeypatch):
    days = random_days(9, 9)
    st = loaded(spark, tmp_path / "s", days, range(9), keep_snapshot_every=1000)
    st.compact_log()
    folders = set(os.listdir(st.ladder_root))
    days[8] = {1: ("new", 2.0)}
    st.integrate(frame(spark, days[8]), day(8))
    days[3] = {5: ("late", 0.5)}
    st.integrate(frame(spark, days[3]), day(3), late="insert")
    for i in range(9):  # stale blocks are passed over at once
        assert as_table(st.as_of(day(i))) == days[i] == as_table(st.undo_to(day(i)))
    writer, seen = module.write_parquet, []

    def failing(df, path):
        seen.append(path)
        if len(seen) == 2:
            raise RuntimeError("lost")
        writer(df, path)

    monkeypatch.setattr(module, "write_parquet", failing)
    with pytest.raises(RuntimeError, match="lost"):
        st.compact_log()
    monkeypatch.undo()
    assert folders <= {n for n in os.listdir(st.ladder_root)}  # old ones go last
    assert not os.path.exists(seen[1])
    for i in range(9):
        assert as_table(st.as_of(day(i))) == days[i]
    st.compact_log()
    blocks, stale = st._blocks(st.listing())
    assert blocks and not stale
    kept = {f"{st.merged_root}/{b.folder}" for b in blocks.values()}
    on_disk = {d for d, _, _ in os.walk(st.merged_root) if os.path.basename(d).startswith("v=")}
    assert on_disk == kept
    for i in range(9):
        assert as_table(st.as_of(day(i))) == days[i] == as_table(st.undo_to(day(i)))


def test_blocks_never_cross_a_change_of_columns(spark, tmp_path):
    st = Store(spark, str(tmp_path / "s"), "k")
    tables = [spark.createDataFrame([(1, f"v{i}"), (i, "x")][: 2 if i != 1 else 1], "k int, v string") for i in range(6)]
    tables += [spark.createDataFrame([(1, i)], "k int, n int") for i in range(6, 13)]
    st.backfill(list(zip(map(day, range(6)), tables[:6])))
    st.backfill(list(zip(map(day, range(6, 13)), tables[6:])), cast=True)
    st.compact_log()
    ls = st.listing()
    for b in st._blocks(ls)[0].values():
        assert len({ls.versions[d].schema for d in b.days}) == 1
    for i, t in enumerate(tables):
        assert same_bag(st.as_of(day(i)), t)


def test_nothing_to_merge(spark, tmp_path):
    st = Store(spark, str(tmp_path / "s"), "k")
    assert st.compact_log() == []
    st.integrate(frame(spark, {1: ("a", 1.0)}), day(0))
    assert st.compact_log() == [] and as_table(st.as_of(day(0))) == {1: ("a", 1.0)}


# -- days that come late -----------------------------------------------------------------


def same_as_in_order(spark, st, days):
    want = build_change_log([(day(i), frame(spark, t)) for i, t in sorted(days.items())], "k")
    assert rows(st.read_log()) == rows(want)
    for i, t in days.items():
        assert as_table(st.as_of(day(i))) == t == as_table(st.undo_to(day(i)))


@pytest.mark.parametrize("options", [{}, {"keep_snapshot_every": 1000, "strategy": "hash"}, {"buckets": 2}])
def test_days_in_any_order(spark, tmp_path, options):
    tables = random_days(11, 7)
    st, days = Store(spark, str(tmp_path / "s"), "k", **options), {}
    for i in (3, 0, 5, 1, 6, 4, 2):
        days[i] = tables[i]
        counts = st.integrate(frame(spark, tables[i]), day(i), late="insert")
        later = [j for j in days if j > i]
        assert counts["rows"] == len(tables[i]) and ("next" in counts) == bool(later)
        if later:
            assert counts["next"]["day"] == day(min(later))
    same_as_in_order(spark, st, days)
    # an older day corrected
    days[2] = {40: ("fixed", 1.0), **{k: v for k, v in tables[2].items() if k > 3}}
    st.integrate(frame(spark, days[2]), day(2), late="insert")
    same_as_in_order(spark, Store(spark, st.root, "k"), days)
    names = os.listdir(st.commit_root)
    assert not any("+" in n for n in names) and len([n for n in names if not n.startswith(".")]) == 7
    for v in st.listing().versions.values():  # nothing is left of replaced attempts
        assert [n for n in os.listdir(f"{st.change_root}/day={v.day}")] == [f"v={v.attempt}"]
        if v.kept:
            assert os.listdir(f"{st.snapshot_root}/day={v.day}") == [f"v={v.snapshot}"]


def test_the_next_days_version_is_kept(spark, tmp_path):
    st = Store(spark, str(tmp_path / "s"), "k", keep_snapshot_every=None)
    for i in (0, 2):
        st.integrate(frame(spark, {i: ("a", 1.0)}), day(i))
    folder = os.listdir(f"{st.snapshot_root}/day={day(2)}")
    st.integrate(frame(spark, {7: ("b", 2.0)}), day(1), late="insert")
    assert os.listdir(f"{st.snapshot_root}/day={day(2)}") == folder and st.snapshot_days() == [day(0), day(1), day(2)]
    assert as_table(st.read_snapshot(day(2))) == {2: ("a", 1.0)}
    # rerun and rerun again: the version is the rerun's own
    st.integrate(frame(spark, {3: ("c", 1.0)}), day(2))
    assert as_table(st.read_snapshot(day(2))) == {3: ("c", 1.0)} and len(os.listdir(f"{st.snapshot_root}/day={day(2)}")) == 1


@pytest.mark.parametrize("step", ["snapshot", "keys", "types", "own", "next", "marker"])
def test_a_failed_insertion_changes_nothing(spark, tmp_path, monkeypatch, step):
    days = {0: {1: ("a", 1.0)}, 2: {1: ("b", 1.0), 2: ("c", None)}, 3: {2: ("c", 0.0)}}
    st = Store(spark, str(tmp_path / "s"), "k")
    for i, t in days.items():
        st.integrate(frame(spark, t), day(i))
    before = sorted(os.listdir(st.commit_root))
    late = frame(spark, {1: ("x", 1.0)})
    if step == "keys":
        late = spark.createDataFrame([(1, "x", 1.0), (1, "y", 1.0)], SCHEMA)
    elif step == "types":
        late = spark.createDataFrame([(1, "x", "y")], "k int, v string, w string")
    elif step in ("own", "next"):
        writer, where = module.write_parquet, f"/changes/day={day(1 if step == 'own' else 2)}"
        monkeypatch.setattr(module, "write_parquet", lambda df, path: 1 / 0 if where in path else writer(df, path))
    elif step == "snapshot":
        monkeypatch.setattr(Store, "_write_snapshot", lambda *a: 1 / 0)
    else:
        monkeypatch.setattr(module._Fs, "put", lambda self, file, text="": 1 / 0 if "+" in file else None)
    with pytest.raises(Exception):
        st.integrate(late, day(1), late="insert")
    monkeypatch.undo()
    assert sorted(os.listdir(st.commit_root)) == before
    same_as_in_order(spark, Store(spark, st.root, "k"), days)


@pytest.mark.parametrize("stop", ["tidy", "half"])
def test_a_stop_after_the_switch(spark, tmp_path, monkeypatch, stop):
    days = {0: {1: ("a", 1.0)}, 2: {1: ("b", 1.0)}, 3: {2: ("c", 0.0)}}
    st = Store(spark, str(tmp_path / "s"), "k")
    for i, t in days.items():
        st.integrate(frame(spark, t), day(i))
    days[1] = {1: ("late", 1.0), 9: ("z", None)}
    with monkeypatch.context() as m:
        m.setattr(*((Store, "_tidy") if stop == "tidy" else (Store, "_remove")), lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            st.integrate(frame(spark, days[1]), day(1), late="insert")
    same_as_in_order(spark, Store(spark, st.root, "k"), days)  # both days are switched
    days[4] = {5: ("on", 1.0)}
    st.integrate(frame(spark, days[4]), day(4))
    same_as_in_order(spark, st, days)
    assert len([n for n in os.listdir(st.commit_root) if not n.startswith(".")]) == 5


def test_a_late_day_with_other_columns(spark, tmp_path):
    st = Store(spark, str(tmp_path / "s"), "k", keep_snapshot_every=1000)
    tables = {i: spark.createDataFrame([(1, f"v{i}", i), (10 + i, "x", 0)], "k int, v string, n int") for i in (0, 1, 3, 4, 5)}
    for i, t in tables.items():
        st.integrate(t, day(i))
    tables[2] = spark.createDataFrame([(1, "less"), (2, None)], "k int, v string")
    st.integrate(tables[2], day(2), late="insert")
    for i, t in tables.items():
        got = Store(spark, st.root, "k").as_of(day(i))
        assert got.columns == t.columns and same_bag(got, t)


def test_refused_by_default(spark, tmp_path):
    st = Store(spark, str(tmp_path / "s"), "k")
    st.integrate(frame(spark, {1: ("a", 1.0)}), day(3))
    with pytest.raises(ValueError, match="already integrated"):
        st.integrate(frame(spark, {1: ("a", 1.0)}), day(1))
    with pytest.raises(ValueError, match="late"):
        st.integrate(frame(spark, {1: ("a", 1.0)}), day(1), late="skip")


def test_given_table_over_many_merged_days(spark, tmp_path):
    dumps = snapshots(spark, SF001, range(10))
    st = Store(spark, str(tmp_path / "s"), KEY)
    st.backfill(dumps[:1])
    st.backfill(dumps[1:], chunk_days=9)
    st.compact_log()
    for d in (0, 4, 7, 9):
        assert same_bag(st.as_of(day_of(d)), dumps[d][1]) and same_bag(st.undo_to(day_of(d)), dumps[d][1])
