"""Drop unusable trips and add calendar columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triplake.functions import timeparts as tp


def usable(period: str = "source_year_month", period_unit: str = "month") -> Column:
    """True for a structurally sound trip.

    Odd but possible trips stay: zero distance or passengers, negative fares,
    very long rides and exact duplicates.
    """
    pickup, dropoff = F.col("pickup_datetime"), F.col("dropoff_datetime")

    def absent_or_at_least_zero(name: str) -> Column:
        # In this form the scan can use it, too.
        return F.col(name).isNull() | (F.col(name) >= 0)

    rules = [
        pickup.isNotNull(),
        dropoff > pickup,
        tp.period_text(pickup, period_unit) == F.col(period),
        F.col("pickup_location_id").isNotNull(),
        F.col("dropoff_location_id").isNotNull(),
        absent_or_at_least_zero("trip_distance"),
        absent_or_at_least_zero("passenger_count"),
    ]
    return reduce(lambda a, b: a & b, rules)


def keep_usable(
    df: DataFrame, period: str = "source_year_month", period_unit: str = "month"
) -> DataFrame:
    return df.filter(usable(period, period_unit))


def with_calendar(df: DataFrame) -> DataFrame:
    """Add duration, date, year, month text, day, hour and weekday name."""
    pickup, dropoff = F.col("pickup_datetime"), F.col("dropoff_datetime")
    wall_clock = tp.is_wall_clock(df, "pickup_datetime")
    return df.withColumns(
        {
            "trip_duration_minutes": tp.elapsed_minutes(pickup, dropoff, wall_clock),
            "pickup_date": pickup.cast("date"),
            "pickup_year": F.year(pickup),
            "pickup_month": tp.two_digits(F.month(pickup)),
            "pickup_day": F.dayofmonth(pickup),
            "pickup_hour": F.hour(pickup),
            "pickup_day_of_week": tp.day_name(pickup),
        }
    )
