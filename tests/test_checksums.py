"""Comparison by checksums: equal to the whole one, reading unequal buckets only."""

import os
import random

import pytest
from conftest import rows
from test_history import day, frame, random_days

from daybook.operators.checksums import bucket_sums, range_sums, unequal_buckets
from daybook.operators.compare import compare_summary
from daybook.sources.store import Store


def test_sums_follow_content_not_order(spark):
    kind = "k int, s struct<x:int>, l array<int>, m map<string,int>, f double"
    data = [(i, (i,), [i, None], {"a": i, "b": 1}, 0.0) for i in range(50)]
    a = spark.createDataFrame(data, kind)
    same = spark.createDataFrame([(k, s, x, dict(reversed(m.items())), -f) for k, s, x, m, f in reversed(data)], kind).repartition(7)
    assert unequal_buckets(bucket_sums(a, "k", 16), bucket_sums(same, "k", 16), 4) == []
    assert rows(bucket_sums(a, "k", 16)) == rows(bucket_sums(same, "k", 16))
    for change in ((3, None, [3, None], {"a": 3, "b": 1}, 0.0), (3, (3,), [None, 3], {"a": 3, "b": 1}, 0.0), (60, *data[3][1:])):
        other = spark.createDataFrame([change if r[0] == 3 else r for r in data], kind)
        assert 1 <= len(unequal_buckets(bucket_sums(a, "k", 16), bucket_sums(other, "k", 16), 4)) <= 2
    swapped = spark.createDataFrame([(data[r[0] ^ 1][0], *r[1:]) for r in data], kind)  # the same contents under other keys
    assert unequal_buckets(bucket_sums(a, "k", 1), bucket_sums(swapped, "k", 1)) == [0]
    tree = range_sums(bucket_sums(a, "k", 16), 4)
    assert tree.count() <= 4 and sum(r.rows for r in tree.collect()) == 50


@pytest.mark.parametrize("buckets", [None, 8])
def test_equals_the_whole_comparison(spark, tmp_path, buckets):
    days = random_days(13, 4, keys=60)
    days += [dict(days[-1]), {}]
    st = Store(spark, str(tmp_path / "s"), "k", buckets=buckets, keep_snapshot_every=None)
    for i, t in enumerate(days):
        st.integrate(frame(spark, t), day(i))
    for i, j in ((0, 3), (3, 0), (2, 3), (3, 4), (1, 5), (5, 1), (2, 2)):
        want = rows(compare_summary(frame(spark, days[i]), frame(spark, days[j]), "k"))
        assert rows(st.compare(day(i), day(j))) == want
    # a version's sums go with it
    assert os.path.exists(f"{st.sums_root}/day={day(5)}")
    st.integrate(frame(spark, days[0]), day(5))
    assert rows(st.compare(day(0), day(5))) == rows(compare_summary(frame(spark, days[0]), frame(spark, days[0]), "k"))


def test_reads_unequal_buckets_only(spark, tmp_path, monkeypatch):
    rng = random.Random(1)
    a = {k: (str(rng.random()), 1.0) for k in range(4000)}
    b = a | {17: ("revised", 1.0)}
    st = Store(spark, str(tmp_path / "s"), "k", buckets=32, keep_snapshot_every=None)
    for i, t in enumerate((a, b)):
        st.integrate(frame(spark, t), day(i))
    read, whole = [], Store._bucket_rows
    monkeypatch.setattr(Store, "_bucket_rows", lambda self, *args, **how: (read.append(whole(self, *args, **how)), read[-1])[1])
    got = st.compare(day(0), day(1)).first()
    assert (got.modified, got.unchanged, got.total_changes) == (1, 3999, 1)
    for df in read:  # one bucket of 32
        assert len(df.inputFiles()) == 1 and df.count() < 4000 / 16
    # a second comparison reads the stored sums
    sums = st.checksums(day(0))
    assert sums.inputFiles() and all("/sums/" in f for f in sums.inputFiles())
    assert sum(r.rows for r in sums.collect()) == 4000


def test_other_days_and_drift(spark, tmp_path):
    st = Store(spark, str(tmp_path / "s"), "k", keep_snapshot_every=1000)
    days = random_days(3, 4)
    for i, t in enumerate(days):
        st.integrate(frame(spark, t), day(i))
    assert not st.listing().versions[day(1)].kept
    assert rows(st.compare(day(1), day(3))) == rows(compare_summary(frame(spark, days[1]), frame(spark, days[3]), "k"))
    st.integrate(spark.createDataFrame([(k, v[0]) for k, v in days[3].items()], "k int, v string"), day(4))
    assert st.compare(day(3), day(4)).first().total_changes == 0  # over the common columns
    with pytest.raises(FileNotFoundError):
        st.checksums(day(1))


def test_an_unfinished_checksum_table_is_written_anew(spark, tmp_path):
    st = Store(spark, str(tmp_path / "s"), "k")
    st.integrate(frame(spark, {1: ("a", 1.0)}), day(0))
    st.checksums(day(0))
    folder = next(d for d, _, names in os.walk(st.sums_root) if "_SUCCESS" in names)
    for n in os.listdir(folder):
        if n.endswith(".parquet") or n == "_SUCCESS":
            os.remove(f"{folder}/{n}")
    assert [r.rows for r in st.checksums(day(0)).collect()] == [1]


def test_keys_alone(spark):
    assert bucket_sums(spark.createDataFrame([(1, "x")], "a int, b string"), ["a", "b"], 4).count() == 1


def test_an_empty_dump_has_counts(spark, tmp_path):
    st = Store(spark, str(tmp_path / "s"), "k")
    assert st.integrate(frame(spark, {}), day(0)) == {"day": day(0), "rows": 0, "inserts": 0, "updates": 0, "deletes": 0}
    assert st.integrate(frame(spark, {1: ("a", 1.0)}), day(1))["inserts"] == 1
    assert st.integrate(frame(spark, {}), day(2))["deletes"] == 1
