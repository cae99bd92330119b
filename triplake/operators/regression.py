"""Regression quality in one aggregation, the mean baseline, the best model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triplake.operators.features import LABEL

BASELINE = "mean_baseline"


def _metric_columns(label: Column, prediction: Column) -> list[Column]:
    error = prediction - label
    total_variation = F.var_pop(label) * F.count(label)
    return [
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (F.lit(1.0) - F.sum(error * error) / F.nullif(total_variation, F.lit(0.0))).alias("r2"),
    ]


def regression_metrics(
    predictions: DataFrame, *keys: str, label: str = LABEL, prediction: str = "prediction"
) -> DataFrame:
    """MAE, RMSE and R2 of all rows, or per group."""
    both = F.col(label).isNotNull() & F.col(prediction).isNotNull()
    columns = _metric_columns(F.col(label).cast("double"), F.col(prediction).cast("double"))
    return predictions.filter(both).groupBy(*keys).agg(*columns)


def predict_mean(train: DataFrame, test: DataFrame, label: str = LABEL) -> DataFrame:
    """Every test row gets the mean training label."""
    return test.withColumn("prediction", train.agg(F.avg(label)).scalar())


def ranked_models(scores: DataFrame) -> DataFrame:
    return scores.orderBy(F.asc("rmse"), F.asc("model"))


def best_model(scores: DataFrame) -> DataFrame:
    """The trained model with the smallest RMSE; no row when none was trained."""
    trained = scores.filter(F.col("model") != BASELINE)
    first = trained.orderBy(F.asc("rmse"), F.asc("model")).limit(1)
    return first.select(F.col("model").alias("best_model"), *[
        c for c in ("model_path", "mae", "rmse", "r2") if c in scores.columns
    ])
