"""Driver contract: entry() runs; every query has a matching oracle (sf0.001)."""

import duckdb
import pytest
from conftest import SF001

import __spark_entry__ as E

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "op" in df.columns


def test_every_query_but_metadata_has_an_oracle():
    assert set(E.oracle_sql()) == set(E.queries()) - E.NO_ORACLE


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def _canon(cols, rs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    def norm(v):
        if isinstance(v, float):
            return round(v, 9)
        if hasattr(v, "isoformat"):
            return v.isoformat()
        return v
    return sorted((tuple(norm(r[i]) for i in order) for r in rs), key=repr)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    got = [tuple(r) for r in df.collect()]
    res = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(res.columns)
    assert _canon(df.columns, got) == _canon(res.columns, res.fetchall())
