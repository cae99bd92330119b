"""Zone dimension and the lookup join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triplake.functions.casts import text_to_long
from triplake.schemas import ZONE_FILE_COLUMNS


def zones_from_file_rows(rows: DataFrame) -> DataFrame:
    """Check and rename the columns of the zone file; one row per id."""
    missing = sorted(set(ZONE_FILE_COLUMNS) - set(rows.columns))
    if missing:
        raise ValueError("zone file lacks columns: " + ", ".join(missing))
    return one_row_per_zone(
        rows.select(
            text_to_long(F.col("LocationID").cast("string")).alias("location_id"),
            F.col("Borough").cast("string").alias("borough"),
            F.col("Zone").cast("string").alias("zone"),
            F.col("service_zone").cast("string").alias("service_zone"),
        )
    )


def one_row_per_zone(zones: DataFrame) -> DataFrame:
    """Keep the smallest (borough, zone, service_zone) of each id."""
    attributes = ["borough", "zone", "service_zone"]
    return (
        zones.groupBy("location_id")
        .agg(F.min(F.struct(*attributes)).alias("kept"))
        .select("location_id", *[F.col(f"kept.{name}") for name in attributes])
    )


def lookup_join(
    rows: DataFrame, lookup: DataFrame, row_key: str, lookup_key: str, how: str = "left"
) -> DataFrame:
    """Join rows to a table with one row per key; ``lookup_key`` is dropped.

    Spark broadcasts the lookup when its statistics, or its size once shuffled,
    are below spark.sql.autoBroadcastJoinThreshold, and splits hot keys of a
    larger join at run time.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be left or inner")
    return rows.join(lookup, F.col(row_key) == F.col(lookup_key), how).drop(lookup_key)


def with_zone(trips: DataFrame, zones: DataFrame, role: str) -> DataFrame:
    """Add zone, borough and service zone of one end of the trip."""
    key = f"_{role}_zone_id"
    named = zones.select(
        F.col("location_id").alias(key),
        F.col("zone").alias(f"{role}_zone"),
        F.col("borough").alias(f"{role}_borough"),
        F.col("service_zone").alias(f"{role}_service_zone"),
    )
    return lookup_join(trips, named, f"{role}_location_id", key)


def with_zones(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Add the zones of both ends."""
    return with_zone(with_zone(trips, zones, "pickup"), zones, "dropoff")
