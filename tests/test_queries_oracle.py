"""Registered queries vs their DuckDB oracle on the smallest landed tables,
plus rows-only execution of the queries that have no SQL oracle."""

import pytest

import __spark_entry__ as E
from marginflow.oracle.compare import compare, duckdb_connection

from .conftest import SF_SMALL

ORACLE = E.oracle_sql()
QUERIES = E.queries()
NO_ORACLE = sorted(k for k in QUERIES if k not in ORACLE)


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_SMALL)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(spark, con, key):
    r = compare(QUERIES[key](spark, SF_SMALL), ORACLE[key], con)
    assert r["ok"], r


@pytest.mark.parametrize("key", NO_ORACLE)
def test_runs(spark, key):
    df = QUERIES[key](spark, SF_SMALL)
    assert df.count() >= 0


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["commercial_month", "channel", "lines", "revenue", "margin", "lines_without_cost"]
