"""Every registered query against its DuckDB oracle on the smallest scale (the driver does the same at sf0.01)."""

import pytest

from tablegrad.plans.catalog import ORACLES, QUERIES
from tablegrad.plans.verify import compare, duck_connection

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, SF, key, con)
    assert r["cols_match"], r
    assert r["spark_rows"] == r["duck_rows"], r
    assert r["hash_match"], r


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_oracle_runs(spark, key):
    df = QUERIES[key](spark, SF)
    assert df.count() > 0
