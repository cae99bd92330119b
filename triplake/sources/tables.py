"""Trip, serving and model tables on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplake.schemas import PERIOD_COLUMNS
from triplake.session import new_scratch


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame below the shared folder and read it back.

    For results that several steps read: they are computed once, and a lost
    executor does not take them along, as it would a cache.
    """
    path = new_scratch(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def period_slice(
    trips: DataFrame, year: int | None = None, month: int | None = None
) -> DataFrame:
    """One year or one month of a partitioned table; prunes partitions."""
    if month is not None and year is None:
        raise ValueError("a month needs a year")
    if month is not None and not 1 <= month <= 12:
        raise ValueError("month must be 1 to 12")
    if year is not None:
        trips = trips.filter(F.col("pickup_year") == year)
    if month is not None:
        # The partition column reads back as an int; a fresh frame holds text.
        trips = trips.filter(F.col("pickup_month").cast("int") == month)
    return trips


def read_trips(
    spark: SparkSession, path: str, year: int | None = None, month: int | None = None
) -> DataFrame:
    return period_slice(spark.read.parquet(path), year, month)


def write_periods(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    rebalance: bool = False,
    order: tuple = (),
    whole: bool = False,
) -> None:
    """Write by period; overwriting replaces only the periods that are present,
    or, with ``whole``, the whole table.

    ``rebalance`` evens out the files. It lets Spark split a hot period over
    many tasks and merge small ones, where a plain repartition by period would
    send a whole period to one task. Without it no shuffle takes place.
    """
    if rebalance:
        df = df.hint("rebalance", *PERIOD_COLUMNS)
        df = df.sortWithinPartitions(*PERIOD_COLUMNS, *order)
    (
        df.write.mode(mode)
        .option("partitionOverwriteMode", "static" if whole else "dynamic")
        .option("compression", "snappy")
        .partitionBy(*PERIOD_COLUMNS)
        .parquet(path)
    )


def write_whole(df: DataFrame, path: str, files: int | None = None) -> None:
    """Replace a whole table, optionally in so many even files. The rows are dealt
    to them in turn, so few files do not mean few readers."""
    if files is not None:
        df = df.repartition(files)
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .option("compression", "snappy")
        .parquet(path)
    )
