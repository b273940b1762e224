"""Streaming ingestion of a folder of daily CSV dumps into a store."""

import os

import pytest
from conftest import SF001, rows, same_bag

from daybook import build_change_log, flatten_changes
from daybook.plans.fixtures import KEY, N_DAYS, day_of, snapshots
from daybook.sources.store import Store
from daybook.streaming.ingest import ingest_dumps


@pytest.fixture(scope="module")
def snaps(spark):
    return snapshots(spark, SF001)


def put(src, name, pdf=None):
    """A file of the inbox, later than all before it."""
    path = src / name
    path.write_text("") if pdf is None else pdf.to_csv(path, index=False)
    at = 1_700_000_000 + 86_400 * len(os.listdir(src))
    os.utime(path, (at, at))


def frame(df):
    return df.toPandas().rename(columns={KEY: "id"}).sort_values("id")  # the dumps name the key "id"


def ingest(spark, store, src, snaps, **options):
    q = ingest_dumps(spark, store, str(src), snaps[0][1].withColumnRenamed(KEY, "id").schema, **options)
    q.awaitTermination(600)
    return q


def counted(store, monkeypatch):
    days, integrate = [], store.integrate
    monkeypatch.setattr(store, "integrate", lambda dump, day, **how: (days.append(day), integrate(dump, day, **how)))
    return days


def test_stream_of_dumps_builds_the_log(spark, snaps, tmp_path):
    src = tmp_path / "inbox"
    src.mkdir()
    for d, df in snaps:
        put(src, f"dump-{d.isoformat()}.csv", frame(df))
        put(src, f"dump-{d.isoformat()}.done")
    store = Store(spark, str(tmp_path / "store"), KEY)
    assert ingest(spark, store, src, snaps).exception() is None
    assert store.change_days() == [day_of(d) for d in range(N_DAYS)]
    want = flatten_changes(build_change_log(snaps, KEY), KEY)
    assert rows(flatten_changes(store.read_log(), KEY)) == rows(want)
    assert same_bag(store.as_of(day_of(2)), snaps[2][1])
    # a second run finds nothing new and changes nothing
    ingest(spark, store, src, snaps)
    assert rows(flatten_changes(store.read_log(), KEY)) == rows(want)


def test_a_day_in_parts_is_integrated_once_when_done(spark, snaps, tmp_path, monkeypatch):
    src = tmp_path / "2024-12-31-inbox"  # a date in a folder name must not count
    src.mkdir()
    store = Store(spark, str(tmp_path / "store"), KEY, keep_snapshot_every=1000)
    days = counted(store, monkeypatch)
    for d, df in snaps[:3]:
        pdf = frame(df)
        cuts = [0, len(pdf) // 4, len(pdf) // 2, len(pdf)]
        for i in range(3):  # parts arrive over several runs
            put(src, f"dump-{d.isoformat()}-part{i}.csv", pdf[cuts[i] : cuts[i + 1]])
            assert ingest(spark, store, src, snaps).exception() is None
            assert d not in days
        put(src, f"dump-{d.isoformat()}.done")
        assert ingest(spark, store, src, snaps).exception() is None
    assert days == [d for d, _ in snaps[:3]]
    assert rows(store.read_log()) == rows(build_change_log(snaps[:3], KEY))


def test_late_parts(spark, snaps, tmp_path, monkeypatch):
    src = tmp_path / "inbox"
    src.mkdir()
    store = Store(spark, str(tmp_path / "store"), KEY, keep_snapshot_every=1000)
    for d, df in snaps[:3]:
        pdf = frame(df)
        put(src, f"dump-{d.isoformat()}.csv", pdf[5:] if d == day_of(2) else pdf)
        put(src, f"dump-{d.isoformat()}.done")
    assert ingest(spark, store, src, snaps).exception() is None
    # the newest day, of a pruned store, is completed by a late part and a further done file
    put(src, f"dump-{day_of(2).isoformat()}-late.csv", frame(snaps[2][1])[:5])
    put(src, f"dump-{day_of(2).isoformat()}.2.done")
    assert ingest(spark, store, src, snaps).exception() is None
    want = rows(build_change_log(snaps[:3], KEY))
    assert rows(store.read_log()) == want
    # an older day is corrected, and the stream goes on with the next
    put(src, f"dump-{day_of(0).isoformat()}-late.csv", frame(snaps[0][1])[:0])
    put(src, f"dump-{day_of(0).isoformat()}.2.done")
    put(src, f"dump-{day_of(3).isoformat()}.csv", frame(snaps[3][1]))
    put(src, f"dump-{day_of(3).isoformat()}.done")
    assert ingest(spark, store, src, snaps).exception() is None
    assert rows(store.read_log()) == rows(build_change_log(snaps[:4], KEY))
    put(src, f"dump-{day_of(1).isoformat()}.3.done")
    with pytest.raises(Exception):
        ingest(spark, store, src, snaps, late="error")
