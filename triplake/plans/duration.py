"""Dataset, training and batch prediction of trip duration."""

from __future__ import annotations

import time

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplake.functions.hashing import row_hash
from triplake.operators.encoding import with_category_text
from triplake.operators.features import (
    duration_features,
    keyed_sample,
    label_stats,
    require_dataset_columns,
    split_by_period,
)
from triplake.operators.models import (
    EncodedModel,
    chosen_models,
    compare_models,
    fit_encoded_boosting,
    predict_encoded,
    prediction_columns,
)
from triplake.operators.regression import regression_metrics
from triplake.operators.scoring import score_trips
from triplake.schemas import BEST_MODEL_SCHEMA
from triplake.sources.tables import write_whole

# Sampled shares and seed of the published dataset.
TRAIN_FRACTION = 0.005
TEST_FRACTION = 0.05
SEED = 42


def build_dataset(
    spark: SparkSession,
    trips_path: str,
    base: str,
    test_period: str,
    train_fraction: float = TRAIN_FRACTION,
    test_fraction: float = TEST_FRACTION,
    seed: int = SEED,
) -> DataFrame:
    """Write ``train`` and ``test`` and return their label statistics."""
    trips = spark.read.parquet(trips_path)
    # A key from the row's content: the sample does not depend on files or splits.
    keyed = trips.withColumn("_key", row_hash(trips))
    train, test = split_by_period(duration_features(keyed, keep=("_key",)), test_period)
    for name, part, share in (("train", train, train_fraction), ("test", test, test_fraction)):
        write_whole(keyed_sample(part, "_key", share, seed).drop("_key"), f"{base}/{name}")
    parts = []
    for name in ("train", "test"):
        saved = spark.read.parquet(f"{base}/{name}")
        rows = saved.agg(F.count(F.lit(1))).scalar()
        parts.append(
            label_stats(saved).select(F.lit(name).alias("part"), rows.alias("row_count"), "*")
        )
    return parts[0].unionByName(parts[1])


def export_dataset(spark: SparkSession, base: str, target: str) -> None:
    """Few files for a trainer outside the cluster."""
    for name, files in (("train", 8), ("test", 4)):
        write_whole(spark.read.parquet(f"{base}/{name}"), f"{target}/{name}", files)


def train_models(
    spark: SparkSession,
    dataset_base: str,
    model_base: str,
    scores_path: str,
    predictions_path: str,
    models: str = "linear,rf,gbt",
    seed: int = SEED,
) -> DataFrame:
    """Compare the chosen models, save them, and predict with the reloaded best."""
    names = chosen_models(models)
    train = require_dataset_columns(spark.read.parquet(f"{dataset_base}/train"))
    test = require_dataset_columns(spark.read.parquet(f"{dataset_base}/test"))
    result = compare_models(train, test, names, seed, model_base)
    write_whole(result.scores, scores_path)
    # One row, one file.
    result.best.coalesce(1).write.mode("overwrite").json(f"{model_base}/best_model_info")
    if names:
        best = load_best_model(spark, model_base)
        predicted = best.transform(with_category_text(test))
        write_whole(prediction_columns(predicted), predictions_path)
    return result.scores


def load_best_model(spark: SparkSession, model_base: str) -> PipelineModel:
    info = spark.read.schema(BEST_MODEL_SCHEMA).json(f"{model_base}/best_model_info").first()
    if info is None:
        raise FileNotFoundError(f"no trained model below {model_base}")
    return PipelineModel.load(info.model_path)


def predict_table(
    spark: SparkSession, model_base: str, inputs: DataFrame, target: str | None = None
) -> DataFrame:
    """Score a table of planned trips with the best model."""
    scored = score_trips(load_best_model(spark, model_base), inputs)
    if target is not None:
        write_whole(scored, target)
    return scored


def train_encoded(
    spark: SparkSession,
    dataset_base: str,
    target: str,
    iterations: int = 250,
    seed: int = SEED,
) -> DataFrame:
    """Train the boosted model on target encodings, save both, and score it.

    Returns, and stores as one JSON file, rows, seconds, trees and errors.
    """
    train = require_dataset_columns(spark.read.parquet(f"{dataset_base}/train"))
    test = require_dataset_columns(spark.read.parquet(f"{dataset_base}/test"))
    started = time.monotonic()
    # Rows alike share a fold, so none is encoded with the help of its copy.
    fitted = fit_encoded_boosting(
        train.withColumn("_key", row_hash(train)), "_key", iterations, seed
    )
    seconds = time.monotonic() - started
    fitted.save(target)
    scores = regression_metrics(predict_encoded(EncodedModel.load(spark, target), test))
    result = scores.select(
        F.lit(train.count()).alias("training_rows"), F.lit(test.count()).alias("test_rows"),
        F.lit(seconds).alias("training_seconds"), F.lit(fitted.trees).alias("trees"),
        "mae", "rmse", "r2",
    )
    result.coalesce(1).write.mode("overwrite").json(f"{target}/metrics")
    return spark.read.json(f"{target}/metrics")


def predict_with_encoded(
    spark: SparkSession, model_path: str, inputs: DataFrame, target: str | None = None
) -> DataFrame:
    """Predict feature rows with the saved model and encodings."""
    predicted = prediction_columns(predict_encoded(EncodedModel.load(spark, model_path), inputs))
    if target is not None:
        write_whole(predicted, target)
    return predicted
