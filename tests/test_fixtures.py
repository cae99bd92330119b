"""Queries over order lines read, shuffle and make them as often as their work needs."""

from __future__ import annotations

import datetime

import pytest

from checks import fixtures as fx
from checks import queries
from checks.queries import QUERIES


@pytest.fixture
def data(spark, tmp_path):
    """A folder with a few order lines, and what they refer to."""
    day = datetime.datetime(1997, 3, 5)

    def write(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")

    write("customer", [(k, k % 3) for k in range(5)] + [(None, 1)], "c_custkey long, c_nationkey int")
    write("supplier", [(k, k % 4) for k in range(4)], "s_suppkey long, s_nationkey int")
    write(
        "orders",
        [(k, k % 5, day + datetime.timedelta(days=9 * k), 100.0 + k, f"{1 + k % 5}-HIGH") for k in range(40)]
        + [(40, None, day, 1.0, "1-URGENT"), (None, 1, day, 1.0, "2-HIGH")],
        "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_totalprice double, "
        "o_orderpriority string",
    )
    write(
        "lineitem",
        [(k % 42, k % 4, None if k == 90 else 1 + k % 7, day, 1.0 + k, 9.5 * k, k % 9 / 100, k % 5 / 50)
         for k in range(300)] + [(None, 1, 1, day, 1.0, 1.0, 0.0, 0.0)],
        "l_orderkey long, l_suppkey long, l_linenumber int, l_shipdate timestamp_ntz, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double",
    )
    return str(tmp_path)


def test_other_layout_has_no_fixed_number_of_tasks(spark, data):
    found = QUERIES["fingerprint_typed"](spark, data)
    assert "REPARTITION_BY_NUM" not in found._jdf.queryExecution().toString()
    rows = found.collect()
    assert sum(r.row_count for r in rows) == fx.order_files(spark, data).count() > 200
    assert all(r.same_for_other_layout and r.sees_a_change and r.sees_a_moved_value for r in rows)


def test_table_of_many_splits_is_not_shuffled(spark, data, setting):
    def plan():
        return fx._spread(fx.table(spark, data, "lineitem"))._jdf.queryExecution().toString()

    assert "Exchange" in plan()
    setting("spark.sql.files.maxPartitionBytes", "64b")
    setting("spark.sql.files.openCostInBytes", "0")
    assert "Exchange" not in plan()


def test_incremental_fingerprints_make_the_rows_once(spark, data, monkeypatch):
    made = spark.sparkContext.accumulator(0)
    rows = fx.order_files(spark, data)
    expected = rows.filter("RatecodeID % 3 != 2 OR RatecodeID = 6").count()

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    monkeypatch.setattr(fx, "order_files", lambda *_: rows.mapInArrow(counted, rows.schema))
    found = QUERIES["fingerprint_incremental"](spark, data)
    assert sum(r.row_count for r in found.collect()) == expected > 100
    assert made.value == rows.count()


def test_model_rows_are_made_once(spark, monkeypatch):
    made = spark.sparkContext.accumulator(0)
    schema = "trip_distance double, pickup_hour int, source_year_month string"
    days = ("2024-01-10", queries.TEST_DAY, "2024-01-30")
    rows = spark.createDataFrame([(i / 2, i % 24, days[i % 3]) for i in range(60)], schema)

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    monkeypatch.setattr(queries, "_features", lambda *_: rows.mapInArrow(counted, schema))
    train, test = queries._fares(spark, "")
    for part in (train, test, train, test):
        assert sorted(r.label for r in part.collect()) == sorted(
            3.0 + 2.5 * r.trip_distance + 0.2 * r.pickup_hour for r in part.collect()
        )
        assert part.count() == 20
    assert made.value == 60
