"""Every query against its SQL on DuckDB, over the whole smallest tables."""

import pytest
from check_oracle import compare, duck_views
from conftest import SMALL

import __spark_entry__ as contract
from ebbtide.plans import registry

SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return duck_views(SMALL)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query_matches_sql(spark, duck, name):
    assert compare(contract.queries()[name](spark, SMALL), duck, SQL[name]) is None


def test_entry_is_the_liquidity_fact(spark):
    assert "liquidity_coverage_ratio" in contract.entry(spark).columns
