"""Apply, backfill and time travel (T2, T3, T6) over every day of the fixture."""

import datetime as dt

import pytest
from conftest import SF001, SF01, rows, same_bag
from pyspark.sql import functions as F

from daybook import (
    DELETE,
    INSERT,
    UPDATE,
    apply_changes,
    as_of,
    build_change_log,
    first_load,
    flatten_changes,
    snapshot_diff,
    stack_dumps,
    undo_to,
)
from daybook.plans.fixtures import KEY, N_DAYS, day_of, snapshots


@pytest.fixture(scope="module")
def snaps(spark):
    return snapshots(spark, SF01)


@pytest.fixture(scope="module")
def daily_log(spark, snaps):
    """Union of the sequential daily diffs (the reference's way, fixed)."""
    parts = [first_load(snaps[0][1], KEY, day_of(0))]
    parts += [snapshot_diff(snaps[d - 1][1], snaps[d][1], KEY, day_of(d)) for d in range(1, N_DAYS)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@pytest.fixture(scope="module")
def log(spark, snaps):
    return build_change_log(snaps, KEY)


def test_apply_changes_rebuilds_next_day(spark, snaps):  # T2
    for d in range(1, N_DAYS):
        ch = snapshot_diff(snaps[d - 1][1], snaps[d][1], KEY, day_of(d))
        assert same_bag(apply_changes(snaps[d - 1][1], ch, KEY), snaps[d][1]), d


def test_backfill_equals_daily_diffs(spark, log, daily_log):  # T6
    assert rows(flatten_changes(log, KEY)) == rows(flatten_changes(daily_log, KEY))


def test_backfill_from_frame_with_day_column(spark, snaps, log):
    stacked = stack_dumps(snaps)
    assert rows(flatten_changes(build_change_log(stacked, KEY), KEY)) == rows(flatten_changes(log, KEY))


def test_backfill_with_base(spark, snaps, daily_log):
    got = build_change_log(snaps[2:], KEY, base=snaps[1][1])
    want = daily_log.filter(F.col("day") >= F.lit(day_of(2)))
    assert rows(flatten_changes(got, KEY)) == rows(flatten_changes(want, KEY))


@pytest.mark.parametrize("t", range(N_DAYS))
def test_forward_reverse_and_truth_agree(spark, snaps, log, t):  # T3
    truth = snaps[t][1]
    assert same_bag(as_of(log, day_of(t), KEY), truth)
    assert same_bag(undo_to(snaps[-1][1], log, day_of(t), KEY), truth)


def test_as_of_from_base(spark, snaps, log):
    for b in range(N_DAYS):
        for t in range(b, N_DAYS):
            got = as_of(log, day_of(t), KEY, base=snaps[b][1], base_day=day_of(b))
            assert same_bag(got, snaps[t][1]), (b, t)


def test_as_of_before_first_day_is_empty(spark, log):
    assert as_of(log, dt.date(2024, 12, 31), KEY).isEmpty()


def test_hand_made_history(spark):
    """insert → update → delete → reinsert on one key, plus a steady key."""
    schema = "k string, v int"
    days = [
        [("a", 1), ("s", 0)],
        [("a", 2), ("s", 0)],
        [("s", 0)],
        [("a", 3), ("s", 0)],
    ]
    dumps = [(dt.date(2025, 1, 1 + i), spark.createDataFrame(r, schema)) for i, r in enumerate(days)]
    lg = build_change_log(dumps, "k")
    got = sorted((r["day"].day, r["k"], r["op"]) for r in lg.collect())
    assert got == [(1, "a", INSERT), (1, "s", INSERT), (2, "a", UPDATE), (3, "a", DELETE), (4, "a", INSERT)]
    for i, r in enumerate(days):
        assert rows(as_of(lg, dt.date(2025, 1, 1 + i), "k")) == sorted(r)
        assert rows(undo_to(dumps[-1][1], lg, dt.date(2025, 1, 1 + i), "k")) == sorted(r)


def test_unknown_day_raises(spark, snaps):

    with pytest.raises(Exception):
        build_change_log(snaps, KEY, days=[day_of(0), day_of(1)]).collect()


@pytest.mark.parametrize("limit", [1 << 30, -1])
def test_backfill_by_digest_equals_whole_rows(spark, limit):
    dumps = snapshots(spark, SF001)
    for base, rest in ((None, dumps), (dumps[0][1], dumps[1:])):
        plain = build_change_log(rest, KEY, base=base)
        assert same_bag(build_change_log(rest, KEY, base=base, strategy="hash", broadcast_limit=limit), plain)


def test_backfill_by_digest_shuffles_no_whole_unchanged_rows(spark):
    dumps = snapshots(spark, SF001)
    log = build_change_log(dumps[1:], KEY, base=dumps[0][1], strategy="hash", broadcast_limit=1 << 30)
    text = log._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text and "BroadcastHashJoin" in text, text


def test_backfill_broadcasts_no_more_than_memory_holds(spark, monkeypatch):
    """A limit far over what the driver can hold: the changed rows come by a shuffle, all of them."""
    from daybook.operators import diff

    dumps = snapshots(spark, SF001)
    monkeypatch.setattr(diff, "least_memory", lambda spark: 1 << 14, raising=False)
    log = build_change_log(dumps[1:], KEY, base=dumps[0][1], strategy="hash", broadcast_limit=1 << 30)
    text = log._jdf.queryExecution().executedPlan().toString()
    assert "Window" in text, text  # the window of whole rows
    assert same_bag(log, build_change_log(dumps[1:], KEY, base=dumps[0][1]))
