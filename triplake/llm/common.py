"""Helpers that the corpus operators share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from triplake.session import new_scratch

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Rows that go back to Spark in one Arrow batch at most.
OUT_ROWS = 256


def python_ready(spark: SparkSession) -> None:
    """Let Python workers import this package when it runs from a checkout.

    An installed package, or one sent with --py-files, needs nothing.
    """
    known = spark.sparkContext.environment
    paths = [p for p in known.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        known["PYTHONPATH"] = os.pathsep.join([_ROOT, *paths])


#: Lets Spark delete the shuffle files of a query when the query has ended.
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_cleaned(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_CLEAN_UP, None)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEAN_UP)
        else:
            spark.conf.set(_CLEAN_UP, before)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to the folder all executors share and read it back.

    This cuts the lineage, lets several later steps read one computation, and
    survives the loss of executors, which a cache or a local checkpoint does not.
    Nothing reads the shuffles of the write again, so they go with it.
    """
    path = new_scratch(df.sparkSession, purpose)
    with _shuffles_cleaned(df.sparkSession):
        df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def drop_stored(*frames: DataFrame) -> None:
    """Delete stored tables whose readers have all been stored themselves."""
    for frame in frames:
        spark = frame.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(frame.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def unused(wanted: str, columns: Iterable[str]) -> str:
    """A column name near the wanted one that no given column has in any case."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def other_columns(df: DataFrame, replaced: Iterable[str]) -> list[str]:
    """Columns of a frame apart from those that an operator's results replace."""
    out = {r.lower() for r in replaced}
    return [c for c in df.columns if c.lower() not in out]


def text_digest(text: Column) -> list[Column]:
    """Two differently seeded 64-bit hashes; together they stand for a text."""
    return [F.xxhash64(F.lit(1), text), F.xxhash64(F.lit(2), text)]


def per_row(
    df: DataFrame,
    inputs: list[str],
    fields: list[T.StructField],
    start: Callable[[], Callable[[list[tuple]], Iterable[tuple]]],
    keep: list[str] | None = None,
) -> DataFrame:
    """Add columns that Python computes from some input columns.

    ``start`` is called once per task and returns a function from a list of
    input tuples to as many result tuples. Columns in ``keep`` (default: all
    that results do not replace) pass through as Arrow data. A few hundred rows
    are in Python at a time.
    """
    python_ready(df.sparkSession)
    names = [f.name for f in fields]
    keep = other_columns(df, names) if keep is None else keep
    schema = T.StructType([df.schema[k] for k in keep] + list(fields))
    arrow = to_arrow_schema(schema)
    # Kept columns come first, then the inputs under names of their own.
    source = df.select(
        *[F.col(f"`{k}`") for k in keep],
        *[F.col(f"`{c}`").alias(f"_in{i}") for i, c in enumerate(inputs)],
    )
    held, taken = len(keep), len(inputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = start()
        for batch in batches:
            for begin in range(0, batch.num_rows, OUT_ROWS):
                part = batch.slice(begin, OUT_ROWS)
                rows = list(zip(*(part.column(held + i).to_pylist() for i in range(taken))))
                columns = list(zip(*compute(rows)))
                arrays = [part.column(i).cast(arrow.field(i).type) for i in range(held)]
                arrays += [
                    pa.array(c, arrow.field(held + i).type) for i, c in enumerate(columns)
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return source.mapInArrow(run, schema)


def to_rows(
    df: DataFrame,
    inputs: list[str],
    schema: T.StructType,
    start: Callable[[], Callable[[list[tuple]], Iterable[tuple]]],
) -> DataFrame:
    """Like per_row, but each call may give any number of result rows."""
    python_ready(df.sparkSession)
    arrow = to_arrow_schema(schema)
    source = df.select(*[F.col(f"`{c}`").alias(f"_in{i}") for i, c in enumerate(inputs)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = start()
        for batch in batches:
            for begin in range(0, batch.num_rows, OUT_ROWS):
                part = batch.slice(begin, OUT_ROWS)
                rows = list(zip(*(c.to_pylist() for c in part.columns)))
                columns = list(zip(*compute(rows)))
                if columns:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow
                    )

    return source.mapInArrow(run, schema)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")
