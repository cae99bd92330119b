"""Scoring tables of planned trips."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triplake.functions.timeparts import DAY_NAMES, day_name, day_number_from_monday
from triplake.operators.encoding import with_category_text
from triplake.operators.features import INPUT_RANGES, with_engineered


def first_failed_rule() -> Column:
    """Name of the first input out of range (or missing); NULL for a valid row."""
    rules = [
        (name, ~F.coalesce(F.col(name).between(*bounds), F.lit(False)))
        for name, bounds in INPUT_RANGES.items()
    ]
    rules.append(
        ("pickup_day_of_week", F.coalesce(~_weekday().isin(*DAY_NAMES), F.lit(True)))
    )
    return F.coalesce(*[F.when(broken, F.lit(name)) for name, broken in rules])


def _weekday() -> Column:
    # Weekday names are accepted in any case.
    return F.initcap(F.col("pickup_day_of_week"))


def with_validity(inputs: DataFrame) -> DataFrame:
    return inputs.withColumn("failed_rule", first_failed_rule()).withColumn(
        "valid", F.col("failed_rule").isNull()
    )


def inputs_from_pickup_time(planned: DataFrame) -> DataFrame:
    """Derive weekday, hour and month of a planned trip from its pickup time."""
    pickup = F.col("pickup_datetime")
    derived = planned.withColumns(
        {
            "pickup_hour": F.hour(pickup),
            "pickup_month": F.month(pickup),
            "pickup_day_of_week": day_name(pickup),
        }
    )
    if "estimated_trip_distance" in derived.columns:
        derived = derived.withColumnRenamed("estimated_trip_distance", "trip_distance")
    return derived


def scoring_features(inputs: DataFrame) -> DataFrame:
    """The training features of planned trips, by the same expressions."""
    casts = {
        name: F.col(name).cast("double" if name == "trip_distance" else "int")
        for name in INPUT_RANGES
    }
    typed = inputs.withColumns(casts).withColumn(
        "pickup_day_of_week_num", day_number_from_monday(_weekday())
    )
    return with_engineered(typed)


def score_trips(model: PipelineModel, inputs: DataFrame) -> DataFrame:
    """Predict valid rows; invalid rows are kept with a reason and no prediction."""
    checked = with_validity(inputs)
    # Rejected rows take the least allowed inputs through the model, so that one
    # pass serves all rows; what is predicted for them is dropped.
    least = {name: bounds[0] for name, bounds in INPUT_RANGES.items()}
    allowed = {
        name: F.when(F.col("valid"), F.col(name)).otherwise(F.lit(value))
        for name, value in {**least, "pickup_day_of_week": DAY_NAMES[0]}.items()
    }
    row = F.struct(*[F.col(f"`{c}`") for c in checked.columns]).alias("_row")
    ready = checked.select(row, *[c.alias(n) for n, c in allowed.items()], "valid")
    scored = model.transform(with_category_text(scoring_features(ready)))
    prediction = F.when(F.col("_row.valid"), F.col("prediction").cast("double"))
    return scored.select("_row.*", prediction.alias("prediction"))
