"""Counts and reconciliation reports. Every report is one DataFrame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The enrichment columns whose gaps are reported.
ZONE_COLUMNS = ("pickup_zone", "dropoff_zone", "pickup_borough", "dropoff_borough")

# Texts that stand for a zone nobody knows.
UNKNOWN_ZONE_TEXTS = ("Unknown", "N/A")


def row_counts(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))


def rows_by_partition(trips: DataFrame) -> DataFrame:
    """Rows per period, and how many of them came by stream."""
    return trips.groupBy("pickup_year", "pickup_month").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("ingestion_source") == "streaming").alias("streaming_rows"),
    )


def period_count(df: DataFrame) -> DataFrame:
    """Number of distinct (year, month) pairs, in one row."""
    return _by_period(df, F.count(F.lit(1))).agg(F.count(F.lit(1)).alias("periods"))


def _by_period(df: DataFrame, *measures: Column) -> DataFrame:
    # The month is text in a fresh frame and an int once read back from disk.
    month = F.col("pickup_month").cast("int").alias("pickup_month")
    return df.groupBy("pickup_year", month).agg(*measures)


def enrichment_gaps(trips: DataFrame) -> DataFrame:
    """NULL and unknown counts of the zone columns."""
    nulls = [F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in ZONE_COLUMNS]
    unknown = [
        F.count_if(F.col(c).isin(*UNKNOWN_ZONE_TEXTS)).alias(f"{c}_unknown")
        for c in ZONE_COLUMNS
    ]
    return trips.agg(*nulls, *unknown)


def cleaning_loss(before: DataFrame, kept: Column) -> DataFrame:
    """Rows before and after cleaning, removed rows and percent (0 for no rows).

    ``kept`` is the cleaning condition; the rows are read once.
    """
    counted = before.agg(
        F.count(F.lit(1)).alias("bronze_rows"), F.count_if(kept).alias("silver_rows")
    )
    removed = F.col("bronze_rows") - F.col("silver_rows")
    share = F.when(F.col("bronze_rows") > 0, removed / F.col("bronze_rows") * 100.0)
    return counted.select(
        "*",
        removed.alias("removed"),
        F.coalesce(share, F.lit(0.0)).alias("removed_pct"),
    )


def table_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, periods and trips of each serving table."""
    profiles = []
    for name, table in tables.items():
        per_period = _by_period(table, F.count(F.lit(1)).alias("n"), F.sum("trip_count").alias("t"))
        totals = per_period.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
            F.count(F.lit(1)).alias("periods"),
            F.coalesce(F.sum("t"), F.lit(0)).alias("trip_sum"),
        )
        profiles.append(totals.select(F.lit(name).alias("table_name"), "*"))
    return reduce(DataFrame.unionByName, profiles)


def reconcile(trips: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Do the serving tables add up to the trips, in trips and in periods?"""
    wanted = _by_period(trips, F.count(F.lit(1)).alias("n")).agg(
        F.struct(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.count(F.lit(1)).alias("periods"),
        )
    )
    return (
        table_profile(tables)
        .withColumn("_wanted", wanted.scalar())
        .select(
            "table_name",
            "row_count",
            "periods",
            "trip_sum",
            F.col("_wanted.rows").alias("expected_rows"),
            F.col("_wanted.periods").alias("expected_periods"),
            (F.col("trip_sum") == F.col("_wanted.rows")).alias("trips_ok"),
            (F.col("periods") == F.col("_wanted.periods")).alias("periods_ok"),
        )
    )


def all_pass(reconciled: DataFrame) -> DataFrame:
    """One row: PASS only if every table passed both checks."""
    good = F.bool_and(F.col("trips_ok") & F.col("periods_ok"))
    return reconciled.agg(
        F.when(good, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("overall")
    )
