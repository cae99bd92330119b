"""The four serving tables from the trip table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplake.functions.timeparts import two_digits
from triplake.operators.metrics import serving_table, serving_tables
from triplake.operators.quality import all_pass, reconcile
from triplake.sources.tables import read_trips, write_periods, write_whole

#: Raised when the tables below come out differently, so that they are rebuilt.
RULES = "1"


def build_serving(
    spark: SparkSession,
    trips_path: str,
    base: str,
    year: int | None = None,
    month: int | None = None,
    mode: str = "overwrite",
) -> None:
    """Aggregate the trips to each table, reading the columns it needs.

    Rows are summed before the shuffle, which so is as small as the tables. A run
    over all periods replaces the tables, and with them periods that the trips
    no longer have; a run over one period replaces that period only.
    """
    trips = read_trips(spark, trips_path, year, month)
    for name, spec in serving_tables().items():
        write_periods(
            serving_table(trips, name), f"{base.rstrip('/')}/{name}", mode,
            rebalance=True, order=spec.order, whole=year is None and month is None,
        )


def serving_of_periods(
    spark: SparkSession, trips_path: str, periods: list[str]
) -> dict[str, DataFrame]:
    """Each table for some periods; only their partitions of the trips are read."""
    trips = read_trips(spark, trips_path)
    period = F.concat_ws("-", F.col("pickup_year").cast("string"), two_digits(F.col("pickup_month")))
    trips = trips.filter(period.isin(periods))
    return {name: serving_table(trips, name) for name in serving_tables()}


def read_serving(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{base.rstrip('/')}/{name}") for name in serving_tables()}


def check_serving(spark: SparkSession, trips_path: str, base: str) -> tuple[DataFrame, bool]:
    """Reconciliation report and its verdict."""
    report = reconcile(spark.read.parquet(trips_path), read_serving(spark, base))
    return report, all_pass(report).first()["overall"] == "PASS"


def export_serving(spark: SparkSession, base: str, target: str, files: int = 4) -> None:
    """Copy the compact serving tables into few files each."""
    for name, table in read_serving(spark, base).items():
        write_whole(table, f"{target.rstrip('/')}/{name}", files)
