"""Every query with an SQL twin must agree with it in names, types and values."""

import pytest

import __spark_entry__ as entry
from compare import connect, differences

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", list(SQL))
def test_matches_sql(spark, sf, con, name):
    assert differences(entry.queries()[name](spark, sf), con, SQL[name]) == []


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_twin_has_a_query():
    assert set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", ["feature_names", "feature_schema", "pca_projection"])
def test_queries_without_twin_give_rows(spark, sf, name):
    assert entry.queries()[name](spark, sf).count() > 0
