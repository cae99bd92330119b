from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from triplake.session import open_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = open_session(
        "tests",
        time_zone="UTC",
        shuffle_partitions=8,
        **{
            "spark.master": "local[8]",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def setting(spark):
    """Change session settings for one test."""
    before = {}

    def change(key: str, value: str) -> None:
        before.setdefault(key, spark.conf.get(key))
        spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.set(key, value)


TRIP = {
    "VendorID": 1,
    "tpep_pickup_datetime": "2024-01-10 08:00:00",
    "tpep_dropoff_datetime": "2024-01-10 08:30:00",
    "passenger_count": 1.0,
    "trip_distance": 2.5,
    "RatecodeID": 1,
    "store_and_fwd_flag": "N",
    "PULocationID": 10,
    "DOLocationID": 20,
    "payment_type": 1,
    "fare_amount": 10.0,
    "total_amount": 12.5,
    "tip_amount": 2.5,
}


@pytest.fixture
def file_rows(spark):
    """Rows of a monthly file, each given by what differs from a plain trip."""

    def build(*changes: dict, counts: str = "double"):
        kinds = {
            "VendorID": "bigint", "RatecodeID": "double", "PULocationID": "bigint",
            "DOLocationID": "bigint", "payment_type": "bigint", "passenger_count": counts,
            "trip_distance": "double", "fare_amount": "double", "total_amount": "double",
            "tip_amount": "double",
        }
        names = list(TRIP)
        rows = [tuple({**TRIP, **c}[n] for n in names) for c in changes]
        rows = [
            tuple(
                float(v) if v is not None and kinds.get(n) == "double"
                else int(v) if v is not None and kinds.get(n) == "bigint" else v
                for n, v in zip(names, r)
            )
            for r in rows
        ]
        schema = ", ".join(f"{n} {kinds.get(n, 'string')}" for n in names)
        df = spark.createDataFrame(rows, schema)
        return df.withColumns(
            {n: df[n].cast("timestamp_ntz") for n in names if n.startswith("tpep_")}
        )

    return build
