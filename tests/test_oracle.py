"""Every registered query with a SQL twin gives the same rows in DuckDB."""

import pytest

import __spark_entry__ as contract
from oracle import connect, differences

#: Fits at full size, of a minute and more each at any scale; test_models runs them with fewer and smaller trees.
FULL_SIZE = {
    "attribution_tree", "boosted_by_nodes", "boosted_classes_by_nodes", "claim_probability_pipeline", "fit_boosted",
    "fit_boosted_classes", "fit_forest_classes", "forest_classes_by_nodes", "premium_pipeline", "severity_pipeline",
}
SQL = contract.oracle_sql()
QUERIES = contract.queries()


@pytest.fixture(scope="module")
def con(sf_small):
    return connect(sf_small)


def test_every_statement_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(SQL) - FULL_SIZE))
def test_query_equals_sql(spark, con, sf_small, name):
    assert differences(QUERIES[name](spark, sf_small), con, SQL[name]) == []


def test_entry_has_one_row(spark):
    assert contract.entry(spark).count() == 1
