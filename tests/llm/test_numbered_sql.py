"""The queries that have SQL, against DuckDB over the whole smallest tables."""

import pytest
from check_oracle import compare, duck_views

from ebbtide.llm.registry import ORACLE_SQL, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    assert compare(QUERIES[name](spark, SMALL), duck_views(SMALL), ORACLE_SQL[name]) is None
