"""Every registered query against its DuckDB oracle on the smallest tables."""

from __future__ import annotations

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from keyflow.plans.queries import QUERIES
from keyflow.sources.tables import DRIVER_TABLES

from .conftest import SF_SMALL


def _norm(v):
    return round(v, 6) if isinstance(v, float) and not math.isnan(v) else v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.sql(f"create view {t} as select * from '{SF_SMALL}/{t}.parquet'")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(oracle_sql()) and set(QUERIES) <= set(queries())


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["label", "cnt"] and df.count() > 0


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, key):
    df = queries()[key](spark, SF_SMALL)
    res = duck.sql(oracle_sql()[key])
    assert sorted(df.columns) == sorted(res.columns)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(res.columns, res.fetchall())
