"""Spark ML pipelines for trip duration."""

from __future__ import annotations

import time
from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplake.operators.encoding import encode, encoding_table, with_category_text, with_fold
from triplake.operators.features import CATEGORICAL, LABEL, NUMERIC
from triplake.operators.regression import (
    BASELINE,
    best_model,
    predict_mean,
    ranked_models,
    regression_metrics,
)
from triplake.schemas import BEST_MODEL_SCHEMA, MODEL_SCORE_SCHEMA
from triplake.sources.tables import stored, write_whole

TEXTS = [f"{c}_cat" for c in CATEGORICAL]
INDEXES = [f"{c}_idx" for c in CATEGORICAL]
ONE_HOTS = [f"{c}_ohe" for c in CATEGORICAL]
ENCODED = [f"{c}_te" for c in CATEGORICAL]

# Columns of a stored prediction.
PREDICTION_COLUMNS = (
    "pickup_location_id",
    "dropoff_location_id",
    "passenger_count",
    "trip_distance",
    "rate_code_id",
    "pickup_hour",
    "pickup_day_of_week_num",
    "pickup_month",
)


def category_indexer() -> StringIndexer:
    """All categories in one stage, so their values are counted in one pass."""
    return StringIndexer(
        inputCols=TEXTS,
        outputCols=INDEXES,
        handleInvalid="keep",
        stringOrderType="alphabetAsc",
    )


def one_hot() -> OneHotEncoder:
    return OneHotEncoder(
        inputCols=INDEXES, outputCols=ONE_HOTS, handleInvalid="keep", dropLast=True
    )


def _assemble(categories: list[str]) -> VectorAssembler:
    return VectorAssembler(
        inputCols=categories + list(NUMERIC), outputCol="features", handleInvalid="error"
    )


# The settings of each model.
def linear_pipeline(seed: int) -> Pipeline:
    regressor = LinearRegression(
        labelCol=LABEL, maxIter=50, regParam=0.05, elasticNetParam=0.0, standardization=True
    )
    return Pipeline(stages=[category_indexer(), one_hot(), _assemble(ONE_HOTS), regressor])


def forest_pipeline(seed: int) -> Pipeline:
    regressor = RandomForestRegressor(
        labelCol=LABEL, numTrees=30, maxDepth=8, maxBins=300, subsamplingRate=0.8,
        featureSubsetStrategy="sqrt", seed=seed,
    )
    return Pipeline(stages=[category_indexer(), _assemble(INDEXES), regressor])


def boosted_pipeline(seed: int) -> Pipeline:
    regressor = GBTRegressor(
        labelCol=LABEL, maxIter=25, maxDepth=5, maxBins=300, stepSize=0.08,
        subsamplingRate=0.8, lossType="squared", seed=seed,
    )
    return Pipeline(stages=[category_indexer(), _assemble(INDEXES), regressor])


PIPELINES = {"linear": linear_pipeline, "rf": forest_pipeline, "gbt": boosted_pipeline}


def chosen_models(names: str) -> list[str]:
    """Parse a comma-separated choice; unknown names are an error."""
    wanted = [n.strip().lower() for n in names.split(",") if n.strip()]
    unknown = sorted(set(wanted) - set(PIPELINES))
    if unknown:
        raise ValueError("unknown models: " + ", ".join(unknown))
    return wanted


def fit_model(train: DataFrame, name: str, seed: int = 42) -> PipelineModel:
    """Fit one model; training rows are kept on the executors meanwhile."""
    ready = with_category_text(train).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return PIPELINES[name](seed).fit(ready)
    finally:
        ready.unpersist()


class Comparison(NamedTuple):
    scores: DataFrame
    best: DataFrame
    fitted: dict[str, PipelineModel]


def compare_models(
    train: DataFrame,
    test: DataFrame,
    names: list[str],
    seed: int = 42,
    model_base: str | None = None,
) -> Comparison:
    """Fit each model, score it beside the mean baseline, and pick the best.

    Training passes over its input many times, so both sides are kept on the
    executors, spilling to disk.
    """
    spark = train.sparkSession
    train = with_category_text(train).persist(StorageLevel.MEMORY_AND_DISK)
    test = with_category_text(test).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        base = regression_metrics(predict_mean(train, test)).first()
        rows = [(BASELINE, base.mae, base.rmse, base.r2, 0.0, "")]
        fitted = {}
        for name in names:
            started = time.monotonic()
            fitted[name] = PIPELINES[name](seed).fit(train)
            seconds = time.monotonic() - started
            path = ""
            if model_base is not None:
                path = f"{model_base}/{name}"
                fitted[name].write().overwrite().save(path)
            m = regression_metrics(fitted[name].transform(test)).first()
            rows.append((name, m.mae, m.rmse, m.r2, seconds, path))
    finally:
        train.unpersist()
        test.unpersist()
    scores = spark.createDataFrame(rows, MODEL_SCORE_SCHEMA)
    best = spark.createDataFrame(best_model(scores).collect(), BEST_MODEL_SCHEMA)
    return Comparison(ranked_models(scores), best, fitted)


class EncodedModel(NamedTuple):
    model: PipelineModel
    encodings: DataFrame

    @property
    def trees(self) -> int:
        return self.model.stages[-1].getNumTrees

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        write_whole(self.encodings, f"{path}/encodings")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> EncodedModel:
        return cls(PipelineModel.load(f"{path}/model"), spark.read.parquet(f"{path}/encodings"))


#: Trees without a smaller held-out error after which boosting has ended.
PATIENCE = 20
#: Trees of the first attempt; while the error still falls, attempts double.
FIRST_TREES = 32


def stopping_point(errors: list[float], patience: int = PATIENCE) -> tuple[int, bool]:
    """How many trees have the smallest held-out error, looking ``patience`` trees
    beyond it at most, and whether so many were seen in vain."""
    best = 0
    for i, error in enumerate(errors):
        if error < errors[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def fit_encoded_boosting(
    train: DataFrame, key: str, iterations: int = 250, seed: int = 42
) -> EncodedModel:
    """Boosting on target-encoded categories.

    Training rows are encoded out of fold. A tenth of them, by key, is held out:
    trees are added until ``PATIENCE`` of them have brought no smaller error on
    it, and the model has the trees up to the smallest. Spark trees have a depth
    limit where the portable model has a leaf limit (31 leaves, about depth 5),
    and no L2 penalty on leaves.
    """
    folded = with_fold(train, key, folds=5, seed=seed)
    table = stored(encoding_table(folded), "encodings")
    encoded = encode(folded, table, out_of_fold=True)
    assembler = _assemble(ENCODED)
    ready = assembler.transform(with_fold(encoded.drop("fold"), key, folds=10, seed=seed + 1))
    ready = ready.select("features", LABEL, "fold").persist(StorageLevel.MEMORY_AND_DISK)
    grown, held_out = ready.filter("fold > 0"), ready.filter("fold = 0")

    def boosted(trees: int):
        return GBTRegressor(
            labelCol=LABEL, maxIter=trees, maxDepth=5, maxBins=255, stepSize=0.08,
            minInstancesPerNode=40, seed=seed,
        ).fit(grown)

    try:
        # A fit with fewer trees is the beginning of one with more.
        blind = held_out.isEmpty()
        trees = iterations if blind or iterations <= 2 * FIRST_TREES else FIRST_TREES
        while True:
            model = boosted(trees)
            best, ended = trees, blind
            if not blind:
                best, ended = stopping_point(model.evaluateEachIteration(held_out, "squared"))
            if ended or trees == iterations:
                model = model if best == trees else boosted(best)
                break
            trees = min(2 * trees, iterations)
    finally:
        ready.unpersist()
    return EncodedModel(PipelineModel(stages=[assembler, model]), table)


def predict_encoded(fitted: EncodedModel, df: DataFrame) -> DataFrame:
    return fitted.model.transform(encode(df, fitted.encodings))


def prediction_columns(predictions: DataFrame) -> DataFrame:
    extra = [LABEL] if LABEL in predictions.columns else []
    return predictions.select(
        *PREDICTION_COLUMNS, *extra, F.col("prediction").cast("double").alias("prediction")
    )
