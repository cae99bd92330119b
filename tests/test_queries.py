"""Every registered query with SQL agrees with DuckDB on the smallest data."""

from __future__ import annotations

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import connect, differences

DATA = "/root/testdata/sf0.001"

needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    return connect(DATA)


def test_sql_belongs_to_queries():
    assert set(oracle_sql()) <= set(queries())


@needs_data
@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = queries()[name](spark, DATA)
    rows = df.select(*sorted(df.columns)).collect()
    assert rows, "no rows to compare"
    assert differences(df, rows, duck.sql(oracle_sql()[name])) == []


@needs_data
def test_flagship(spark):
    assert "trip_count" in entry(spark).columns
