"""Every catalogue query against its SQL oracle (DuckDB) on sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from hitloom.plans import catalog
from hitloom.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
QUERIES = {name: q for name, q in entry.queries().items() if name in catalog.QUERIES}
ORACLE = entry.oracle_sql()


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(catalog.QUERIES) and set(QUERIES) <= set(ORACLE)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["source", "total_visits", "total_no_of_bounces", "bounce_rate"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(ORACLE[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert got == _rows(cols, res.fetchall())
