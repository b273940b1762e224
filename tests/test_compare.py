"""Compare two dumps."""

import pytest
from conftest import SF01
from pyspark.sql import functions as F

from daybook import compare, compare_rows, compare_samples, compare_summary
from daybook.plans.fixtures import KEY, snapshots


@pytest.fixture(scope="module")
def snaps(spark):
    return snapshots(spark, SF01)


def test_counts_day0_vs_day4(spark, snaps):
    s = compare_summary(snaps[0][1], snaps[4][1], KEY).first().asDict()
    assert (s["removed"], s["added"], s["modified"], s["unchanged"]) == (1929, 1286, 3100, 8471)
    # T4
    assert s["removed"] + s["modified"] + s["unchanged"] == s["rows_a"] == snaps[0][1].count()
    assert s["added"] + s["modified"] + s["unchanged"] == s["rows_b"] == snaps[4][1].count()
    assert s["total_changes"] == 1929 + 1286 + 3100
    assert s["change_rate"] == round((1929 + 1286 + 3100) * 100.0 / 13500, 2)


def test_self_compare_is_unchanged(spark, snaps):
    s = compare_summary(snaps[2][1], snaps[2][1], KEY).first().asDict()
    assert s["unchanged"] == s["rows_a"] and s["total_changes"] == 0 and s["change_rate"] == 0.0


def test_empty_a_has_no_rate(spark, snaps):
    empty = snaps[0][1].limit(0)
    s = compare_summary(empty, snaps[0][1], KEY).first().asDict()
    assert s["rows_a"] == 0 and s["change_rate"] is None and s["added"] == 13500


def test_common_columns_only(spark):
    a = spark.createDataFrame([("k1", 1, "x"), ("k2", 2, "y")], "k string, v int, extra string")
    b = spark.createDataFrame([("k1", 1, 9.0), ("k2", 3, 9.0)], "k string, v int, other double")
    got = {r["k"]: r["change"] for r in compare(a, b, "k").collect()}
    assert got == {"k1": "UNCHANGED", "k2": "MODIFIED"}


def test_rows_and_samples(spark, snaps):
    a, b = snaps[0][1], snaps[4][1]
    removed = compare_rows(a, b, KEY, "REMOVED")
    assert removed.columns == a.columns
    s = compare_samples(a, b, KEY, 5)
    per = {c: [r[KEY] for r in sorted(s.filter(F.col("change") == c).collect(), key=lambda r: r[KEY])] for c in ("REMOVED", "ADDED", "MODIFIED")}
    for c, keys in per.items():
        want = [r[KEY] for r in compare_rows(a, b, KEY, c).orderBy(KEY).limit(5).collect()]
        assert keys == want


@pytest.mark.parametrize("strategy", ["struct", "hash"])
def test_summary_strategies_agree_on_traps(spark, strategy):
    import datetime as dt

    t1, t2 = dt.datetime(2025, 1, 1, 0, 0, 0, 123456), dt.datetime(2025, 1, 1, 0, 0, 0, 123999)
    schema = "k string, a int, b int, x double, t timestamp"
    a = spark.createDataFrame([("s", None, 1, -0.0, t1), ("n", 1, None, 1.0, t1), ("m", 1, 1, 1.0, t1), ("r", 1, 1, 1.0, t1)], schema)
    b = spark.createDataFrame([("s", None, 1, 0.0, t1), ("n", None, 1, 1.0, t1), ("m", 1, 1, 1.0, t2), ("d", 1, 1, 1.0, t1)], schema)
    s = compare_summary(a, b, "k", strategy=strategy).first().asDict()
    assert (s["removed"], s["added"], s["modified"], s["unchanged"]) == (1, 1, 2, 1)
