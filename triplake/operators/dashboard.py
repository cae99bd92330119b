"""Numbers behind the dashboard, from the serving tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triplake.functions.casts import nullable_int
from triplake.functions.exact import MONEY_STEPS, exact_sum
from triplake.functions.timeparts import DAY_NAMES, day_number_from_monday



def _revenue_sum(name: str) -> Column:
    return exact_sum(F.col(name), MONEY_STEPS)


# Metrics a zone map can show, and how a zone's rows combine.
ZONE_METRICS = {
    "trip_count": F.sum,
    "total_revenue": _revenue_sum,
    "avg_trip_duration_minutes": F.avg,
    "avg_trip_distance": F.avg,
    "avg_tip_amount": F.avg,
}

INTEGER_KEYS = ("pickup_year", "pickup_month", "pickup_location_id")

HOURS = tuple(range(24))


def with_integer_keys(table: DataFrame) -> DataFrame:
    """Year, month and location keys as nullable ints; what is no number is NULL."""
    present = [name for name in INTEGER_KEYS if name in table.columns]
    return table.withColumns({name: nullable_int(F.col(name)) for name in present})


def date_bounds(daily: DataFrame) -> DataFrame:
    return daily.agg(
        F.min("pickup_date").alias("min_date"), F.max("pickup_date").alias("max_date")
    )


def between_dates(daily: DataFrame, start, end) -> DataFrame:
    """Both ends included; None leaves an end open."""
    if start is not None:
        daily = daily.filter(F.col("pickup_date") >= F.lit(start).cast("date"))
    if end is not None:
        daily = daily.filter(F.col("pickup_date") <= F.lit(end).cast("date"))
    return daily


def overview(daily: DataFrame, start=None, end=None) -> DataFrame:
    """Trips, revenue and trip-weighted averages.

    The weights are all trips of a day, also those without the averaged value.
    """
    trips = F.sum("trip_count")

    def weighted(name: str) -> Column:
        return F.sum(F.col(name) * F.col("trip_count")) / F.nullif(trips, F.lit(0))

    return between_dates(daily, start, end).agg(
        trips.alias("total_trips"),
        _revenue_sum("total_revenue").alias("total_revenue"),
        weighted("avg_trip_duration_minutes").alias("avg_trip_duration_minutes"),
        weighted("avg_trip_distance").alias("avg_trip_distance"),
    )


def daily_trend(daily: DataFrame, start=None, end=None) -> DataFrame:
    chosen = between_dates(daily, start, end)
    return chosen.select("pickup_date", "trip_count", "total_revenue").orderBy("pickup_date")


def available_periods(table: DataFrame) -> DataFrame:
    """Year and month choices with the month name; the latest month is marked."""
    keys = with_integer_keys(table).select("pickup_year", "pickup_month").dropna().distinct()
    latest = keys.agg(F.max(F.struct("pickup_year", "pickup_month"))).scalar()
    return keys.select(
        "pickup_year",
        "pickup_month",
        F.date_format(
            F.make_date("pickup_year", "pickup_month", F.lit(1)), "MMMM"
        ).alias("month_name"),
        (F.struct("pickup_year", "pickup_month") == latest).alias("is_latest"),
    ).orderBy("pickup_year", "pickup_month")


def month_of(table: DataFrame, year: int, month: int) -> DataFrame:
    return table.filter(
        (F.col("pickup_year").cast("int") == year)
        & (F.col("pickup_month").cast("int") == month)
    )


def hourly_curve(hourly: DataFrame) -> DataFrame:
    return (
        hourly.groupBy("pickup_hour")
        .agg(F.sum("trip_count").alias("trip_count"))
        .orderBy("pickup_hour")
    )


def weekday_by_hour(hourly: DataFrame) -> DataFrame:
    """Weekday rows, one column per hour; absent hours are 0, absent days NULL."""
    table = hourly.groupBy("pickup_day_of_week").pivot("pickup_hour", list(HOURS))
    cells = table.agg(F.sum("trip_count")).fillna(0)
    cells = cells.select("pickup_day_of_week", *[F.col(str(h)).alias(f"h{h:02d}") for h in HOURS])
    week = hourly.sparkSession.createDataFrame(
        [(name,) for name in DAY_NAMES], "pickup_day_of_week string"
    )
    # One row for each name of a weekday.
    return week.join(F.broadcast(cells), "pickup_day_of_week", "left").orderBy(
        day_number_from_monday(F.col("pickup_day_of_week"))
    )


def zone_totals(month_rows: DataFrame) -> DataFrame:
    """One row per zone; averages of averages are not weighted."""
    keys = ["pickup_location_id", "pickup_zone", "pickup_borough"]
    measures = [combine(name).alias(name) for name, combine in ZONE_METRICS.items()]
    return month_rows.groupBy(*[k for k in keys if k in month_rows.columns]).agg(*measures)


def zone_map(zones: DataFrame, totals: DataFrame, metric: str) -> DataFrame:
    """Every zone with the chosen metric, 0 where the month had no trips."""
    _require_metric(metric)
    joined = zones.join(totals, F.col("location_id") == F.col("pickup_location_id"), "left")
    return joined.withColumn(metric, F.coalesce(F.col(metric), F.lit(0)))


def top_zones(totals: DataFrame, metric: str, n: int = 10) -> DataFrame:
    """Largest zones by a metric; ties go to the smaller id."""
    _require_metric(metric)
    columns = ["pickup_zone", "pickup_borough", "pickup_location_id", metric]
    return (
        totals.orderBy(F.desc(metric), F.asc_nulls_last("pickup_location_id"))
        .limit(n)
        .select(*[c for c in columns if c in totals.columns])
    )


def _require_metric(metric: str) -> None:
    if metric not in ZONE_METRICS:
        raise ValueError(f"unknown metric {metric!r}; one of {', '.join(ZONE_METRICS)}")
