"""Every registered query against its SQL, on the smallest tables."""

import pytest
from tests.compare import connect, differences

import __spark_entry__ as entry

QUERIES, CHECKS = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_matches_sql(spark, folder, con, name):
    problem = differences(QUERIES[name](spark, folder), con, CHECKS[name])
    assert problem == ""


@pytest.mark.parametrize("name", ["model_evaluate_clusters", "model_centroids"])
def test_query_without_sql_has_rows(spark, folder, name):
    assert QUERIES[name](spark, folder).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_no_query_without_a_builder():
    assert set(CHECKS) <= set(QUERIES)
