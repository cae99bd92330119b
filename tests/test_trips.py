"""Canonical layout, cleaning, calendar and messages on hand-made edge rows."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from conftest import TRIP
from triplake.functions import timeparts as tp
from triplake.operators.canonical import (
    batch_to_canonical,
    messages_to_canonical,
    pick_column,
)
from triplake.operators.cleaning import keep_usable, with_calendar
from triplake.schemas import CANONICAL_COLUMNS
from triplake.streaming.ingest import accept, decode


def stored(spark, *payloads, key="2024-01"):
    rows = [(p, key, 2024, 1, "t", 0, i, None) for i, p in enumerate(payloads)]
    return spark.createDataFrame(
        rows,
        "raw_json string, year_month string, year int, month int, kafka_topic string,"
        " kafka_partition int, kafka_offset bigint, kafka_timestamp timestamp",
    )


def payload(**changes):
    return json.dumps({**TRIP, **changes})


def test_pick_column_prefers_exact_case():
    assert pick_column(["airport_fee", "Airport_fee"], ["Airport_fee"]) == "Airport_fee"
    assert pick_column(["AIRPORT_FEE"], ["Airport_fee", "airport_fee"]) == "AIRPORT_FEE"
    assert pick_column(["fee"], ["Airport_fee"]) is None


def test_drifting_layouts_share_one_schema(file_rows):
    plain = batch_to_canonical(file_rows({}), "2024-01")
    counted = file_rows({}, counts="bigint").withColumn("airport_fee", F.lit(1.25))
    other = batch_to_canonical(counted.drop("trip_distance"), "2024-01")
    assert tuple(plain.columns) == CANONICAL_COLUMNS
    assert plain.dtypes == other.dtypes
    row = other.first()
    assert (row.passenger_count, row.airport_fee, row.trip_distance) == (1, 1.25, None)
    assert plain.first().airport_fee is None


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_message_edge_cases(spark, setting, ansi):
    setting("spark.sql.ansi.enabled", ansi)
    df = messages_to_canonical(
        stored(
            spark,
            payload(passenger_count="1.0"),
            payload(trip_distance=float("nan")),
            "this is no json",
            payload(tpep_pickup_datetime="soon", Airport_fee=None, airport_fee=1.5),
            payload(VendorID=9007199254740993, Airport_fee=2.0, airport_fee=1.5),
            None,
        ),
        wall_clock=True,
    )
    rows = {r.kafka_offset: r for r in df.collect()}
    assert rows[0].passenger_count == 1
    assert rows[1].trip_distance is None and rows[1].pickup_location_id == 10
    assert rows[2].pickup_datetime is None and rows[2].fare_amount is None
    assert rows[3].pickup_datetime is None and rows[3].airport_fee == 1.5
    assert rows[4].vendor_id == 9007199254740993 and rows[4].airport_fee == 2.0
    assert rows[5].vendor_id is None
    assert sorted(r.kafka_offset for r in keep_usable(df).collect()) == [0, 1, 4]


def test_period_of_a_message_without_key_has_two_digits(spark):
    row = messages_to_canonical(stored(spark, payload(), key=None)).first()
    assert row.source_year_month == "2024-01"


def test_filter_does_not_repeat_the_parse(spark):
    plan = keep_usable(messages_to_canonical(stored(spark, payload()), True))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json") == 1


def test_accepting_messages(spark):
    def message(key, value, offset):
        return (key, value, "t", 0, offset, None)

    rows = [
        message(b"2024-01", b'{"a": 1}', 0),
        message(b"2024-01", b'{"__eof__": true, "rows_sent": 4}', 1),
        message(b"2024-01", b'{"__eof__": false}', 2),
        message(b"2024-01", b'{"__eof__": "what"}', 3),
        message(b"2024-02", b'{"a": 1}', 4),
        message(None, b'{"a": 1}', 5),
        message(b"2024-01", b"no json", 6),
        message(b"2024-01", b'{"\\u005f_eof__": true}', 7),
    ]
    df = spark.createDataFrame(
        rows,
        "key binary, value binary, topic string, partition int, offset bigint,"
        " timestamp timestamp",
    )
    kept = accept(decode(df), "2024-01")
    assert sorted(r.kafka_offset for r in kept.collect()) == [0, 2, 3, 6]
    assert kept.first().year == "2024" and kept.first().month == "01"


CLEANING = [
    ({}, True),
    ({"tpep_dropoff_datetime": "2024-01-10 08:00:00"}, False),
    ({"tpep_dropoff_datetime": "2024-01-10 07:00:00"}, False),
    ({"tpep_dropoff_datetime": None}, False),
    ({"tpep_pickup_datetime": None}, False),
    ({"tpep_pickup_datetime": "2023-12-31 23:59:59"}, False),
    ({"trip_distance": 0.0}, True),
    ({"trip_distance": None}, True),
    ({"trip_distance": -0.1}, False),
    ({"trip_distance": float("nan")}, True),
    ({"passenger_count": 0}, True),
    ({"passenger_count": None}, True),
    ({"passenger_count": -1}, False),
    ({"fare_amount": -5.0}, True),
    ({"PULocationID": None}, False),
    ({"DOLocationID": None}, False),
    ({"tpep_dropoff_datetime": "2024-03-10 08:00:00"}, True),
]


def test_cleaning_rules_and_duplicates(file_rows):
    changes = [change for change, _ in CLEANING]
    tagged = [{**c, "VendorID": i} for i, c in enumerate(changes)]
    df = batch_to_canonical(file_rows(*tagged, tagged[0]), "2024-01", wall_clock=True)
    kept = sorted(r.vendor_id for r in keep_usable(df).collect())
    assert kept == sorted([i for i, (_, ok) in enumerate(CLEANING) if ok] + [0])


@pytest.mark.parametrize(
    ("wall_clock", "pickup", "dropoff", "hour", "minutes"),
    [
        (False, "2021-03-14 02:30:00", "2021-03-14 03:45:00", 3, 15.0),
        (True, "2021-03-14 02:30:00", "2021-03-14 03:45:00", 2, 75.0),
        (False, "2021-11-07 00:50:00", "2021-11-07 03:10:00", 0, 200.0),
        (True, "2021-11-07 00:50:00", "2021-11-07 03:10:00", 0, 140.0),
    ],
)
def test_clock_changes(spark, setting, file_rows, wall_clock, pickup, dropoff, hour, minutes):
    setting("spark.sql.session.timeZone", "America/New_York")
    trip = {"tpep_pickup_datetime": pickup, "tpep_dropoff_datetime": dropoff}
    row = with_calendar(batch_to_canonical(file_rows(trip), pickup[:7], wall_clock)).first()
    assert (row.pickup_hour, row.trip_duration_minutes) == (hour, minutes)
    assert row.pickup_day_of_week == "Sunday" and row.pickup_month == pickup[5:7]


def test_whole_seconds_are_cut(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00.9' a, timestamp_ntz'2024-01-01 00:01:00.1' b")
    assert df.select(tp.elapsed_minutes(F.col("a"), F.col("b"), True)).first()[0] == 1.0


def test_day_numberings(spark):
    days = spark.createDataFrame([("Sunday",), ("Monday",), ("nonsense",), (None,)], "d string")
    rows = days.select(
        tp.day_number_from_sunday(F.col("d")), tp.day_number_from_monday(F.col("d"))
    ).collect()
    assert [tuple(r) for r in rows] == [(1, 7), (2, 1), (None, None), (None, None)]
