"""Registered queries against their SQL answers, on the smallest tables."""

import duckdb
import pytest
from compare import differences

from casemart.llm import catalogue, oracle


@pytest.mark.parametrize("name", sorted(oracle.oracle_queries()))
def test_query_matches_sql(spark, folder, name):
    connection = duckdb.connect()
    for table in ["documents", "pages", "labels", "conversations"]:
        connection.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    found = catalogue.all_queries()[name](spark, folder)
    assert differences(found, connection, oracle.oracle_queries()[name]) == []
