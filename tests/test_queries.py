"""Every registered query against its SQL in DuckDB, over the whole tables."""

import pytest
from oracle import connect, difference

import __spark_entry__ as contract
from martloom.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, con, name):
    assert difference(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[:3] == ["asin", "year_", "month_"]
    assert len(df.columns) == 39
    assert df.count() > 0
