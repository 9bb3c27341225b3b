"""Every registered query against its SQL on the smallest tables."""

import compare
import pytest

import __spark_entry__ as entry_points

from lakeops.plans import ORACLES, QUERIES
# Fitting is iterative or uses long texts; these have their own tests.
WITHOUT_SQL = {"token_similarity_turns", "group_train", "gbt_train", "batch_score"}


@pytest.fixture(scope="module")
def connection(tiny):
    return compare.connect(tiny)


def test_entry_points_hold_all_queries():
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_only_models_and_long_texts_lack_sql():
    assert set(QUERIES) - set(ORACLES) == WITHOUT_SQL
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, tiny, connection, name):
    assert compare.differences(QUERIES[name](spark, tiny), connection, ORACLES[name]) == ""


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL))
def test_query_without_sql_gives_rows(spark, tiny, name):
    assert QUERIES[name](spark, tiny).count() > 0


def test_flagship(spark, tiny):
    assert entry_points.entry(spark).columns == [
        "o_orderpriority", "total_price", "mean_price", "max_custkey", "members"]
