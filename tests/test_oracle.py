"""Every registered query against its independent DuckDB SQL at sf0.01."""

import os

import pytest

import __spark_entry__ as entry
from oracle import compare, duck
from strata.plans.catalog import QUERIES as CATALOG

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
QUERIES = {k: v for k, v in entry.queries().items() if k in CATALOG}  # optional folders have their own tests
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(CATALOG) <= set(SQL)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["payer_key", "payer_name", "n_encounters", "avg_total_claim_cost"]
    assert df.count() > 0


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    result = compare(spark, con, key, QUERIES[key], SQL[key], SF_DIR)
    assert result["ok"], result
