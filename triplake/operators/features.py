"""Features and label of the trip-duration model."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triplake.functions.hashing import in_sample
from triplake.functions.timeparts import day_number_from_monday

LABEL = "label"

# Model columns and their order.
CATEGORICAL = (
    "pickup_location_id",
    "dropoff_location_id",
    "rate_code_id",
    "pickup_day_of_week_num",
)
NUMERIC = (
    "passenger_count",
    "trip_distance",
    "pickup_hour",
    "pickup_month",
    "is_weekend",
    "is_rush_hour",
    "pickup_hour_sin",
    "pickup_hour_cos",
    "pickup_month_sin",
    "pickup_month_cos",
)
DATASET_COLUMNS = (
    "pickup_location_id",
    "dropoff_location_id",
    "passenger_count",
    "trip_distance",
    "rate_code_id",
    "pickup_hour",
    "pickup_day_of_week_num",
    "pickup_month",
    "is_weekend",
    "is_rush_hour",
    "pickup_hour_sin",
    "pickup_hour_cos",
    "pickup_month_sin",
    "pickup_month_cos",
    LABEL,
)
RAW_INPUTS = (
    "pickup_location_id",
    "dropoff_location_id",
    "passenger_count",
    "estimated_trip_distance",
    "rate_code_id",
    "pickup_datetime",
)

# Accepted ranges, both ends included, in the order of checking.
INPUT_RANGES = {
    "pickup_location_id": (1, 265),
    "dropoff_location_id": (1, 265),
    "passenger_count": (1, 6),
    "trip_distance": (0.1, 100.0),
    "rate_code_id": (1, 6),
    "pickup_hour": (0, 23),
    "pickup_month": (1, 12),
}
LABEL_RANGE = (1.0, 180.0)

# Weekend day numbers (Monday is 1) and rush hours.
WEEKEND = (6, 7)
RUSH_HOURS = (7, 8, 9, 16, 17, 18, 19)

_DOUBLES = {
    "trip_distance",
    "pickup_hour_sin",
    "pickup_hour_cos",
    "pickup_month_sin",
    "pickup_month_cos",
    LABEL,
}


def _within(name: str, bounds: tuple) -> Column:
    return F.col(name).between(*bounds)


def in_model_range() -> Column:
    """True for trips the model may learn from; a NULL fails."""
    checks = [_within(name, bounds) for name, bounds in INPUT_RANGES.items()]
    checks.append(_within("trip_duration_minutes", LABEL_RANGE))
    checks.append(day_number_from_monday(F.col("pickup_day_of_week")).isNotNull())
    return reduce(lambda a, b: a & b, checks)


def model_rows(trips: DataFrame) -> DataFrame:
    # The month is text until the table has been read back from disk.
    return trips.withColumn("pickup_month", F.col("pickup_month").cast("int")).filter(
        in_model_range()
    )


def with_engineered(df: DataFrame) -> DataFrame:
    """Add flags and cyclic columns; needs hour, month and Monday-first weekday."""
    hour, month = F.col("pickup_hour"), F.col("pickup_month")
    weekday = F.col("pickup_day_of_week_num")
    hour_angle = hour * F.lit(2.0 * math.pi / 24.0)
    month_angle = (month - 1) * F.lit(2.0 * math.pi / 12.0)
    return df.withColumns(
        {
            "is_weekend": weekday.isin(*WEEKEND).cast("int"),
            "is_rush_hour": hour.isin(*RUSH_HOURS).cast("int"),
            "pickup_hour_sin": F.sin(hour_angle),
            "pickup_hour_cos": F.cos(hour_angle),
            "pickup_month_sin": F.sin(month_angle),
            "pickup_month_cos": F.cos(month_angle),
        }
    )


def duration_features(
    trips: DataFrame, period: str = "source_year_month", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Feature rows with label, the period for the split, and columns to keep."""
    rows = model_rows(trips).withColumn(
        "pickup_day_of_week_num", day_number_from_monday(F.col("pickup_day_of_week"))
    )
    featured = with_engineered(rows).withColumn(LABEL, F.col("trip_duration_minutes"))
    typed = [
        F.col(c).cast("double" if c in _DOUBLES else "int").alias(c) for c in DATASET_COLUMNS
    ]
    return featured.select(*keep, *typed, F.col(period).alias("source_year_month"))


def split_by_period(features: DataFrame, test_period: str) -> tuple[DataFrame, DataFrame]:
    """Train on everything before a period, test on that period."""
    period = F.col("source_year_month")
    train = features.filter(period < test_period).drop("source_year_month")
    test = features.filter(period == test_period).drop("source_year_month")
    return train, test


def bernoulli_sample(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """Random rows; repeatable only for the same files and splits."""
    if not 0 < fraction <= 1:
        raise ValueError("fraction must be in (0, 1]")
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def keyed_sample(df: DataFrame, key: str, fraction: float, seed: int) -> DataFrame:
    """The same rows on every run and layout; needs an integer key."""
    return df.filter(in_sample(F.col(key), fraction, seed))


def label_stats(df: DataFrame, exact_median: bool = False) -> DataFrame:
    """Smallest, mean, median and largest label.

    The exact median keeps one counter per distinct label. Labels are whole
    seconds between 1 and 180 minutes, so there are at most 10,741.
    """
    median = (
        F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY {LABEL})")
        if exact_median
        else F.percentile_approx(LABEL, 0.5)
    )
    return df.agg(
        F.min(LABEL).alias("min_duration"),
        F.avg(LABEL).alias("avg_duration"),
        median.alias("median_duration"),
        F.max(LABEL).alias("max_duration"),
    )


def require_dataset_columns(df: DataFrame) -> DataFrame:
    """Project to the model columns, or name the missing ones."""
    missing = sorted(set(DATASET_COLUMNS) - set(df.columns))
    if missing:
        raise ValueError("dataset lacks columns: " + ", ".join(missing))
    return df.select(*DATASET_COLUMNS)
