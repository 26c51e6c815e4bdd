"""Every registered query with comparison SQL gives the same bag of rows."""

import pytest
from compare import differences
from conftest import DATA

from tallyroom.catalog import all_oracles, all_queries

QUERIES, ORACLES = all_queries(), all_oracles()


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, name):
    problem = differences(QUERIES[name](spark, DATA), ORACLES[name], DATA)
    assert problem is None, problem


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only(spark, name):
    assert QUERIES[name](spark, DATA).limit(1).count() == 1
