"""Every catalogue query equals its DuckDB oracle on the smallest shared tables."""

import math

import duckdb
import pytest

from conftest import SF001
from shopstream.plans.catalog import QUERIES
from shopstream.plans.oracle import oracle_sql

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF001)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(oracle_sql()[name])
    cols = [c[0] for c in res.description]
    want = _rows(cols, res.fetchall())
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(want)
    assert got == want
