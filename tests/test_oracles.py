"""Every registered query against its SQL statement over the same files."""

import pytest
from compare import connect, differences

import __spark_entry__ as driver

QUERIES, ORACLES = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    with connect(small) as c:
        yield c


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, small, con, name):
    assert differences(QUERIES[name](spark, small), con, ORACLES[name]) == []


def test_entry(spark):
    assert driver.entry(spark).count() > 0
