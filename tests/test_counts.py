"""Reports from count deltas: equal to those of the rebuilt table, without reading it."""

import pytest
from conftest import rows
from test_history import day, frame, random_days

from daybook.operators.counts import count_deltas, counts_from
from daybook.operators.replay import build_change_log
from daybook.operators.report import group_count, top_n
from daybook.sources.store import Store


def test_deltas_of_every_day(spark):
    days = random_days(5, 4, keys=40)
    log = build_change_log([(day(i), frame(spark, t)) for i, t in enumerate(days)], "k")
    names = [c for c in frame(spark, days[0]).columns]
    for column in names:
        deltas = count_deltas(log, "k", column).cache()
        assert deltas.where("delta = 0").isEmpty()
        for i, t in enumerate(days):
            upto = deltas.where(f"day <= DATE '{day(i)}'")
            assert rows(counts_from(upto, column)) == rows(group_count(frame(spark, t), column))
    with pytest.raises(ValueError, match="lack column"):
        count_deltas(log, "k", "nothing")


def test_values_that_are_equal_are_one_group(spark):
    schema = "k int, f double, d int"
    a = spark.createDataFrame([(1, 0.0, 1), (2, float("nan"), 1), (3, None, 1), (4, 1.0, 1)], schema)
    b = spark.createDataFrame([(1, -0.0, 2), (2, float("nan"), 2), (3, 1.0, 2), (5, None, 2)], schema)
    log = build_change_log([(day(0), a), (day(1), b)], "k")
    moved = count_deltas(log, "k", "f").where(f"day = DATE '{day(1)}'")
    assert moved.isEmpty()  # null and 1.0 change places, the zeros and NaN stay
    assert repr(rows(counts_from(count_deltas(log, "k", "f"), "f"))) == repr(rows(group_count(b, "f")))


def test_reports_of_a_store(spark, tmp_path):
    days = [*random_days(8, 5, keys=50), {}]
    st = Store(spark, str(tmp_path / "s"), "k", keep_snapshot_every=None)
    column = frame(spark, days[0]).columns[1]

    def check(known):
        for i in known:
            assert rows(st.group_count(column, day(i))) == rows(group_count(frame(spark, days[i]), column))
            want = [tuple(r) for r in top_n(frame(spark, days[i]), column, 3).collect()]
            assert [tuple(r) for r in st.top_n(column, 3, day(i)).collect()] == want

    st.backfill([(day(i), frame(spark, days[i])) for i in (0, 1)])
    check((0, 1))
    st.integrate(frame(spark, days[4]), day(4))
    check((0, 1, 4))
    st.integrate(frame(spark, days[0]), day(3), late="insert")  # a wrong dump first
    assert rows(st.group_count(column, day(3))) == rows(group_count(frame(spark, days[0]), column))
    st.integrate(frame(spark, days[3]), day(3), late="insert")
    st.integrate(frame(spark, days[2]), day(2), late="insert")
    st.integrate(frame(spark, days[5]), day(5))
    check(range(6))
    read = st.group_count(column, day(4)).inputFiles()
    assert read and all("/counts/" in f for f in read)
    live = {f"v={v.attempt}" for v in st.listing().versions.values()}
    assert {f.split("/v=")[1].split("/")[0] for f in read} <= {v[2:] for v in live}
    with pytest.raises(FileNotFoundError):
        st.group_count(column, "2000-01-01")


def test_deltas_not_written_whole_are_counted_anew(spark, tmp_path):
    days = random_days(9, 3, keys=30)
    st = Store(spark, str(tmp_path / "s"), "k")
    for i, t in enumerate(days):
        st.integrate(frame(spark, t), day(i))
    column = frame(spark, days[0]).columns[1]
    want = rows(st.group_count(column, day(2)))
    v = st.listing().versions[st.listing().changes[1]]
    folder = f"{st._folder(st.counts_root, v.day, v.attempt)}/c={column.encode().hex()}"
    st._fs.delete(f"{folder}/_SUCCESS")  # as after a run that stopped before the mark
    assert rows(st.group_count(column, day(2))) == want == rows(group_count(frame(spark, days[2]), column))


def test_columns_that_leave_and_come_back(spark, tmp_path):
    st = Store(spark, str(tmp_path / "s"), "k")
    dumps = [
        spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "a", 2)], "k int, c string, n int"),
        spark.createDataFrame([(1, 1), (2, 5), (4, 2)], "k int, n int"),
        spark.createDataFrame([(1, "a", "1"), (4, None, "2"), (5, "z", "5")], "k int, c string, n string"),
    ]
    for i, df in enumerate(dumps):
        st.integrate(df, day(i), cast=True)
    for i, df in enumerate(dumps):
        for column in df.columns:
            assert rows(st.group_count(column, day(i))) == rows(group_count(df, column)), (i, column)
    with pytest.raises(ValueError, match="no column"):
        st.group_count("c", day(1))
