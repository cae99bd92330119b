"""Column layouts of every table, as data."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T


class TripField(NamedTuple):
    name: str
    kind: str  # long, double, string or time
    sources: tuple[str, ...]


# Canonical names, their kinds, and the names used by the files.
TRIP_FIELDS = (
    TripField("vendor_id", "long", ("VendorID",)),
    TripField("pickup_datetime", "time", ("tpep_pickup_datetime",)),
    TripField("dropoff_datetime", "time", ("tpep_dropoff_datetime",)),
    TripField("passenger_count", "long", ("passenger_count",)),
    TripField("trip_distance", "double", ("trip_distance",)),
    TripField("rate_code_id", "long", ("RatecodeID",)),
    TripField("store_and_fwd_flag", "string", ("store_and_fwd_flag",)),
    TripField("pickup_location_id", "long", ("PULocationID",)),
    TripField("dropoff_location_id", "long", ("DOLocationID",)),
    TripField("payment_type", "long", ("payment_type",)),
    TripField("fare_amount", "double", ("fare_amount",)),
    TripField("extra", "double", ("extra",)),
    TripField("mta_tax", "double", ("mta_tax",)),
    TripField("tip_amount", "double", ("tip_amount",)),
    TripField("tolls_amount", "double", ("tolls_amount",)),
    TripField("improvement_surcharge", "double", ("improvement_surcharge",)),
    TripField("total_amount", "double", ("total_amount",)),
    TripField("congestion_surcharge", "double", ("congestion_surcharge",)),
    TripField("airport_fee", "double", ("Airport_fee", "airport_fee")),
    TripField("cbd_congestion_fee", "double", ("cbd_congestion_fee",)),
)

# Lineage columns that follow the trip fields.
LINEAGE_COLUMNS = (
    "ingestion_source",
    "source_year_month",
    "kafka_partition",
    "kafka_offset",
    "kafka_timestamp",
)

CANONICAL_COLUMNS = tuple(f.name for f in TRIP_FIELDS) + LINEAGE_COLUMNS

# Stable column order of the trip table.
TRIP_TABLE_COLUMNS = (
    "vendor_id", "pickup_datetime", "dropoff_datetime", "passenger_count",
    "trip_distance", "rate_code_id", "store_and_fwd_flag",
    "pickup_location_id", "pickup_zone", "pickup_borough", "pickup_service_zone",
    "dropoff_location_id", "dropoff_zone", "dropoff_borough", "dropoff_service_zone",
    "payment_type", "fare_amount", "extra", "mta_tax", "tip_amount",
    "tolls_amount", "improvement_surcharge", "total_amount",
    "congestion_surcharge", "airport_fee", "cbd_congestion_fee",
    "trip_duration_minutes", "pickup_date", "pickup_year", "pickup_month",
    "pickup_day", "pickup_hour", "pickup_day_of_week",
    "ingestion_source", "source_year_month",
    "kafka_partition", "kafka_offset", "kafka_timestamp",
)

PERIOD_COLUMNS = ("pickup_year", "pickup_month")

# The six columns a Kafka source yields that the ingest uses.
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# Header of the zone file.
ZONE_FILE_COLUMNS = ("LocationID", "Borough", "Zone", "service_zone")

MODEL_SCORE_SCHEMA = T.StructType(
    [
        T.StructField("model", T.StringType(), False),
        T.StructField("mae", T.DoubleType()),
        T.StructField("rmse", T.DoubleType()),
        T.StructField("r2", T.DoubleType()),
        T.StructField("training_seconds", T.DoubleType()),
        T.StructField("model_path", T.StringType()),
    ]
)

BEST_MODEL_SCHEMA = T.StructType(
    [
        T.StructField("best_model", T.StringType()),
        T.StructField("model_path", T.StringType()),
        T.StructField("mae", T.DoubleType()),
        T.StructField("rmse", T.DoubleType()),
        T.StructField("r2", T.DoubleType()),
    ]
)
