"""The four user-level jobs over paths (daily CSV integration, recompute, diff, report)."""

import os

import pytest
from conftest import SF001, same_bag

from daybook import jobs
from daybook.plans.fixtures import KEY, day_of, snapshots


@pytest.mark.parametrize("buckets", [None, 4])
def test_four_jobs_end_to_end(spark, tmp_path, buckets):
    snaps = snapshots(spark, SF001)
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    schema = snaps[0][1].withColumnRenamed(KEY, "id").schema
    root = str(tmp_path / "store")
    for d, df in snaps:
        path = inbox / f"dump-{d}.csv"
        df.toPandas().rename(columns={KEY: "id"}).to_csv(path, index=False)
        counts = jobs.daily_integration(spark, root, str(path), d, schema, KEY, buckets=buckets)
        assert counts["rows"] == df.count()
    a = jobs.recompute_at_date(spark, root, day_of(1), KEY, str(tmp_path / "a"))
    b = jobs.recompute_at_date(spark, root, day_of(3), KEY, str(tmp_path / "b"))
    assert same_bag(a, snaps[1][1]) and same_bag(b, snaps[3][1])
    summary, samples = jobs.diff_between_dumps(spark, str(tmp_path / "a"), str(tmp_path / "b"), KEY)
    s = summary.first().asDict()
    assert s["rows_a"] == snaps[1][1].count() and s["rows_b"] == snaps[3][1].count()
    assert samples.count() <= 15
    rep = jobs.report(spark, root, KEY, sections=(("o_orderpriority", 3), ("absent_column", 5)))
    assert set(rep) == {"total", "top3_o_orderpriority", "schema", "sample"}
    assert rep["total"].first()["total_rows"] == snaps[-1][1].count()
    assert os.path.isdir(tmp_path / "a")
