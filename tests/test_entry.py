"""The driver contract: entry(), queries() and oracle_sql() agree with DuckDB."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001

from histlake.plans import registry

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float):
        return round(v, 6) if not math.isnan(v) else "nan"
    return v


def _rows(records, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def test_entry_runs_with_stable_schema(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.entry(spark).columns


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(registry.oracle_sql())
    assert set(registry.queries()) <= set(E.queries())


@pytest.mark.parametrize("name", registry.queries())
def test_query_matches_oracle_sf0001(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    got = _rows([tuple(r) for r in df.collect()], df.columns)
    res = duck.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert got == _rows(res.fetchall(), cols)
