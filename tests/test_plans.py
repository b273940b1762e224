"""Plan checks (T8): one join per diff/compare, pruning on day, no Python in plans."""

import re

from conftest import SF01

from daybook import compare, compare_rows, compare_samples, snapshot_diff
from daybook.plans.fixtures import KEY, day_of, snapshot, snapshots
from daybook.sources.store import Store


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def n_joins(text):
    return len(re.findall(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)", text))


def test_diff_is_one_full_outer_join(spark):
    p = plan(snapshot_diff(snapshot(spark, SF01, 2), snapshot(spark, SF01, 3), KEY, day_of(3)))
    assert n_joins(p) == 1 and "FullOuter" in p
    assert "Python" not in p and "ArrowEval" not in p


def test_compare_is_one_join(spark):
    p = plan(compare(snapshot(spark, SF01, 0), snapshot(spark, SF01, 4), KEY))
    assert n_joins(p) == 1


def test_store_reads_prune_days(spark, tmp_path):
    st = Store(spark, str(tmp_path / "s"), KEY)
    for d, dump in snapshots(spark, "/root/testdata/sf0.001"):
        st.integrate(dump, d)
    log = st.read_log(after=day_of(2))
    assert "InMemoryFileIndex(2 paths)" in log.select(KEY)._jdf.queryExecution().executedPlan().toString()
    # only the two days' own folders are listed and read
    assert {f.split("/day=")[1][:10] for f in log.inputFiles()} == {day_of(3).isoformat(), day_of(4).isoformat()}


def test_compare_plans_shuffle_no_more_than_needed(spark):
    a, b = snapshot(spark, SF01, 0), snapshot(spark, SF01, 4)
    removed = compare_rows(a, b, KEY, "REMOVED", validate=False)._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in removed and "FullOuter" not in removed
    samples = compare_samples(a, b, KEY, 5, validate=False)._jdf.queryExecution().executedPlan().toString()
    # the dumps meet in joins of digests; their rows are looked up by a broadcast of few keys
    shuffled = [x for x in samples.splitlines() if "hashpartitioning(o_orderkey" in x]
    assert samples.count("BroadcastHashJoin") == 2 and all("o_totalprice" not in x for x in shuffled), samples


def test_replay_reads_the_change_window_once(spark, tmp_path):
    st = Store(spark, str(tmp_path / "s"), KEY)
    st.backfill(snapshots(spark, "/root/testdata/sf0.001"), chunk_days=5)
    for df in (st.undo_to(day_of(1)), st.as_of(day_of(2))):
        df.collect()  # runs this frame's own plan, so the AQE final plan is shown (sf0.001)
        text = plan(df)
        assert text.count("ReusedExchange") == 1, text
        assert len(re.findall(r"FileScan parquet [^\n]*changes", text)) <= 1, text
        lines = text.splitlines()
        for i, line in enumerate(lines):  # no map-side partial aggregate below a shuffle
            if "Exchange hashpartitioning" in line:
                below = next((lines[i:j] for j in range(i, len(lines)) if "FileScan" in lines[j]), lines[i:])
                assert not any("partial_" in b for b in below), text
