"""Every registered query against its SQL answer."""

import __spark_entry__ as entry
import pytest

import compare

from casemart.plans.catalogue import all_queries
from casemart.plans.oracle import oracle_queries

QUERIES = all_queries()
ANSWERS = oracle_queries()


@pytest.fixture(scope="module")
def connection(folder):
    return compare.duck(folder)


def test_every_query_has_an_answer():
    assert set(ANSWERS) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ANSWERS) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ANSWERS))
def test_query_matches_sql(spark, folder, connection, name):
    assert compare.differences(QUERIES[name](spark, folder), connection, ANSWERS[name]) == []


BROKEN = [
    "constraint_unique_raw", "constraint_not_null_raw", "constraint_fk_holed", "constraint_lost_raw",
    "constraint_length_raw", "constraint_ranges_raw",
]


@pytest.mark.parametrize("name", BROKEN)
def test_checks_of_bad_rows_find_some(spark, folder, name):
    assert QUERIES[name](spark, folder).filter("violations > 0").count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 25
