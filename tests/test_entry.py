"""Driver contract: entry, and every registered query against its DuckDB
oracle on the sf0.001 tables (row count, columns and values)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from strata.tables import TABLES

SF = "/root/testdata/sf0.001"


def norm(v):
    if isinstance(v, float):
        return round(v, 6) if not math.isnan(v) else "nan"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in data), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "loss_ratio" in df.columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 100


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(E.oracle_sql()[name])
    want = rows([d[0] for d in cur.description], cur.fetchall())
    assert sorted(df.columns) == sorted(d[0] for d in cur.description)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.oracle_sql())))
def test_rows_only_queries_run(spark, name):
    assert E.queries()[name](spark, SF).count() >= 0
