"""Every query with SQL equals it. Results of trained models have none, nor have queries of
the subpackage for language-model data; their own tests run them."""

import pytest

import __spark_entry__ as entry
from checks import catalog
from checks.compare import connect, difference

SF = "/root/testdata/sf0.001"
QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    connection = connect(SF)
    yield connection
    connection.close()


def test_queries_and_sql_belong_together():
    assert set(SQL) <= set(QUERIES)
    without = set(QUERIES) - set(SQL)
    assert all(n == "pipeline" or n.startswith("op") or n in catalog.TRAINED for n in without)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, SQL[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
