"""Every registered query against its DuckDB oracle (sf0.001), plus the entry smoke check."""

import os

import pytest

import __spark_entry__ as E
from oracles.compare import compare, duck
from recomart.plans.inventory import inventory_queries

SF = os.environ.get("RECOMART_TEST_SF", "/root/testdata/sf0.001")
# the training-data queries, if present, have tests of their own
QUERIES = {k: v for k, v in E.queries().items() if k in inventory_queries()}
ORACLE = {k: v for k, v in E.oracle_sql().items() if k in inventory_queries()}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert len(QUERIES) >= 120


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(QUERIES[name](spark, SF), con, ORACLE[name])
    assert r["cols_match"], (r["spark_cols"], r["oracle_cols"])
    assert r["match"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns[0] == "source_flag" and len(df.columns) == 30
