"""Every registered query against DuckDB over the same tables."""

import pytest

import __spark_entry__ as entry
from shopstar.plans import oracle, registry
from compare import TESTDATA, connect, differences

QUERIES = registry.queries()
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect("sf0.01")


def test_every_query_has_comparison_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, f"{TESTDATA}/sf0.01")
    assert differences(df, con, SQL[name]) == []


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "year_month"
