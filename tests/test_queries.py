"""Every registered query against its SQL on the small tables."""

import pytest

import __spark_entry__ as driver
from checks import catalog
from tests.compare import connect, duckdb_rows, spark_rows

SF_DIR = "/root/testdata/sf0.001"
NAMES = sorted(catalog.QUERIES)


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.SQL)
    assert set(NAMES) <= set(driver.queries()) and set(NAMES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    expected = duckdb_rows(duck, driver.oracle_sql()[name])
    assert expected[1], "the comparison would be empty"
    assert spark_rows(driver.queries()[name](spark, SF_DIR)) == expected


def test_entry(spark):
    assert driver.entry(spark).count() > 0
