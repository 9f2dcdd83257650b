"""Every query with a SQL twin must agree with it, value for value."""

import compare
import pytest

import __spark_entry__ as entry_point

SQL = entry_point.oracle_sql()
QUERIES = entry_point.queries()


@pytest.fixture(scope="module")
def con(sf):
    return compare.connect(sf)


def test_every_twin_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf, con, name):
    assert compare.differences(spark, con, QUERIES[name], SQL[name], sf) == []


def test_entry_has_a_row_per_customer(spark):
    df = entry_point.entry(spark)
    assert df.count() == 150
    assert "city_NATION_3" in df.columns
