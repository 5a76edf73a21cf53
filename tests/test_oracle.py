"""Every registered query against its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf0.01)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from stockroom.oracle import ORACLE
from stockroom.registry import QUERIES
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


#: Queries that rightly return nothing (audits of columns without violations).
EMPTY: set[str] = set()


def _norm(v):
    if v is None:
        return "\x00"
    if isinstance(v, float):
        return repr(round(v, 6)) if not math.isnan(v) else "nan"
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    return v.isoformat() if hasattr(v, "isoformat") else str(v)


def _bag(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in data)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    rel = duck.sql(ORACLE[name])
    want = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(got) == len(want)
    assert got or name in EMPTY
    assert _bag(df.columns, got) == _bag(rel.columns, want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "stock_date" in df.columns
