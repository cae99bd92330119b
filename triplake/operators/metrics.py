"""The common trip metrics, their mergeable state, and the serving tables."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triplake.functions import exact
from triplake.functions.timeparts import day_number_from_sunday


class Metric(NamedTuple):
    source: str
    result: str
    per_unit: int


# The averaged columns and the names of the averages.
AVERAGES = (
    Metric("total_amount", "avg_total_amount", exact.MONEY_STEPS),
    Metric("fare_amount", "avg_fare_amount", exact.MONEY_STEPS),
    Metric("tip_amount", "avg_tip_amount", exact.MONEY_STEPS),
    Metric("trip_distance", "avg_trip_distance", exact.MONEY_STEPS),
    Metric("trip_duration_minutes", "avg_trip_duration_minutes", exact.MINUTE_STEPS),
    Metric("passenger_count", "avg_passenger_count", exact.COUNT_STEPS),
)

METRIC_COLUMNS = ("trip_count", "total_revenue") + tuple(m.result for m in AVERAGES)


class ServingTable(NamedTuple):
    keys: tuple[str, ...]
    day_number: Column | None
    order: tuple


def serving_tables() -> dict[str, ServingTable]:
    """Grain, derived weekday number and read order of each serving table."""
    period = ("pickup_year", "pickup_month")
    return {
        "daily_summary": ServingTable(
            ("pickup_date", *period, "pickup_day_of_week"),
            F.dayofweek("pickup_date"),
            ("pickup_date",),
        ),
        "hourly_demand": ServingTable(
            (*period, "pickup_day_of_week", "pickup_hour"),
            day_number_from_sunday(F.col("pickup_day_of_week")),
            (*period, "day_of_week_number", "pickup_hour"),
        ),
        "pickup_zone_monthly": ServingTable(
            (
                *period,
                "pickup_location_id",
                "pickup_zone",
                "pickup_borough",
                "pickup_service_zone",
            ),
            None,
            (*period, F.desc("trip_count"), "pickup_location_id"),
        ),
        "payment_monthly": ServingTable(
            (*period, "payment_type"), None, (*period, "payment_type")
        ),
    }


# The finest grain all serving tables can be rolled up from.
STATE_KEYS = (
    "pickup_date",
    "pickup_year",
    "pickup_month",
    "pickup_day_of_week",
    "pickup_hour",
    "pickup_location_id",
    "pickup_zone",
    "pickup_borough",
    "pickup_service_zone",
    "payment_type",
)


def metric_state(trips: DataFrame, keys: tuple[str, ...] = STATE_KEYS) -> DataFrame:
    """Counts and exact partial sums per key; states of the same keys add up."""
    parts = [F.count(F.lit(1)).alias("n")]
    for m in AVERAGES:
        value = F.col(m.source)
        parts += [
            F.count(value).alias(f"n_{m.source}"),
            exact.step_sum(value, m.per_unit).alias(f"steps_{m.source}"),
            exact.rest_sum(value, m.per_unit).alias(f"rest_{m.source}"),
        ]
    return trips.groupBy(*keys).agg(*parts)


def roll_up(state: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Merge states to coarser keys and finish the metrics."""
    sums = [F.sum("n").alias("n")]
    for m in AVERAGES:
        sums += [
            F.sum(f"n_{m.source}").alias(f"n_{m.source}"),
            F.sum(F.col(f"steps_{m.source}").cast("decimal(38,0)")).alias(f"steps_{m.source}"),
            F.sum(f"rest_{m.source}").alias(f"rest_{m.source}"),
        ]
    return _finish(state.groupBy(*keys).agg(*sums), keys)


def trip_metrics(trips: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The common metrics in one aggregation."""
    return _finish(metric_state(trips, keys), keys)


def _finish(state: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    def total(m: Metric) -> Column:
        return exact.joined_sum(
            F.col(f"steps_{m.source}"), F.col(f"rest_{m.source}"), m.per_unit
        )

    averages = [
        (total(m) / F.nullif(F.col(f"n_{m.source}"), F.lit(0))).alias(m.result)
        for m in AVERAGES
    ]
    # A missing amount counts as zero revenue but does not enter the average.
    revenue = F.coalesce(total(AVERAGES[0]), F.lit(0.0)).alias("total_revenue")
    return state.select(*keys, F.col("n").alias("trip_count"), revenue, *averages)


def serving_table(trips: DataFrame, name: str) -> DataFrame:
    """One serving table straight from trips."""
    spec = serving_tables()[name]
    return _with_day_number(trip_metrics(trips, spec.keys), spec)


def serving_table_from_state(state: DataFrame, name: str) -> DataFrame:
    spec = serving_tables()[name]
    return _with_day_number(roll_up(state, spec.keys), spec)


def _with_day_number(table: DataFrame, spec: ServingTable) -> DataFrame:
    if spec.day_number is None:
        return table
    return table.withColumn("day_of_week_number", spec.day_number)


def in_read_order(table: DataFrame, name: str) -> DataFrame:
    """Sort a serving table for display; the order is not kept on disk."""
    return table.orderBy(*serving_tables()[name].order)
