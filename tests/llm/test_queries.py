"""Registered queries of the package against DuckDB, or run to the end where SQL cannot say them."""

import pytest

import __spark_entry__ as driver
from tests.compare import connect, duckdb_rows, spark_rows
from tests.llm.helpers import SF_DIR
from tierlake.llm.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_one_query_per_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    expected = duckdb_rows(duck, SQL[name])
    assert expected[1]
    assert spark_rows(QUERIES[name](spark, SF_DIR)) == expected
