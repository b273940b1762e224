"""Reports (R01-R06, G02, G04, G06, T01-T03)."""

from conftest import SF01, rows
from pyspark.sql import functions as F

from daybook import change_counts, changelog_stats, group_count, sample_rows, schema_of, top_n, total_rows
from daybook.plans.fixtures import KEY, read_table, snapshot


def test_top_n_tie_break(spark):
    docs = read_table(spark, SF01, "documents")
    got = rows(top_n(docs, "source", 10))
    counts = {r[1] for r in got}
    assert len(got) == 10 and len(counts) == 1  # all tied
    names = sorted(r[0] for r in docs.select("source").distinct().collect())
    assert sorted(r[0] for r in got) == names[:10]


def test_group_count_keeps_null(spark):
    g = dict(rows(group_count(snapshot(spark, SF01, 3), "o_orderpriority")))
    assert None in g and sum(g.values()) == 13232


def test_total_sample_schema(spark):
    s = snapshot(spark, SF01, 4)
    assert total_rows(s).first()["total_rows"] == 12857
    keys = [r[KEY] for r in sample_rows(s, KEY, 5).collect()]
    assert keys == sorted(keys) and len(keys) == 5
    sch = rows(schema_of(s))
    assert [r[1] for r in sch] == s.columns


def test_change_stats(spark):
    from daybook import build_change_log
    from daybook.plans.fixtures import snapshots

    lg = build_change_log(snapshots(spark, SF01), KEY)
    assert sum(r[1] for r in rows(change_counts(lg))) == lg.count()
    st = changelog_stats(lg)
    assert st.filter(F.col("day") == "2025-01-01").first()["count"] == 13500
