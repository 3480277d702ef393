"""Every registered query with SQL gives the SQL's rows on the smallest tables."""

import os
from collections import Counter

import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS FROM read_parquet('{DATA}/{f}')")
    return c


def plain(v):
    return round(float(v), 5) if isinstance(v, float) else v


def test_names():
    assert set(SQL) <= set(entry.queries())


@needs_data
@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, duck, name):
    df = entry.queries()[name](spark, DATA)
    cols = sorted(df.columns)
    r = duck.sql(SQL[name])
    assert sorted(r.columns) == cols
    at = [r.columns.index(c) for c in cols]
    want = Counter(tuple(plain(row[i]) for i in at) for row in r.fetchall())
    assert Counter(tuple(map(plain, row)) for row in df.select(*cols).collect()) == want


@needs_data
@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(SQL)))
def test_runs(spark, name):
    df = entry.queries()[name](spark, DATA)
    assert df.columns and df.count() >= 0


@needs_data
def test_entry(spark):
    assert entry.entry(spark).count() > 0
