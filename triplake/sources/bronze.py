"""Landing monthly files, and reading landed months and stored messages."""

from __future__ import annotations

from collections import defaultdict
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triplake.functions.timeparts import two_digits
from triplake.operators.canonical import batch_to_canonical, messages_to_canonical
from triplake.sources import folders


def period_of_file(file_name: Column) -> Column:
    """The month in a file name, or NULL."""
    found = F.regexp_extract(file_name, folders.PERIOD_PATTERN, 0)
    return F.when(found != "", found)


def accepted_for_landing(rows: DataFrame, file_name: str, streaming_period: str) -> DataFrame:
    """Rows of files that name a month, except the month kept for the stream."""
    folders.require_period(streaming_period)
    period = period_of_file(F.col(file_name))
    return rows.withColumn("source_period", period).filter(
        F.col("source_period") != F.lit(streaming_period)
    )


def landing_manifest(rows: DataFrame, file_name: str, streaming_period: str) -> DataFrame:
    """Rows and files per landed month."""
    per_file = (
        accepted_for_landing(rows, file_name, streaming_period)
        .groupBy("source_period", file_name)
        .agg(F.count(F.lit(1)).alias("file_rows"))
    )
    return per_file.groupBy("source_period").agg(
        F.sum("file_rows").alias("row_count"),
        F.count(F.lit(1)).alias("source_files"),
    )


#: Folder below the landing target with the files that were landed; readers of
#: the months skip names that start so.
LANDED_FILES = "_landed_files"


def land_files(
    spark: SparkSession,
    source: str,
    target: str,
    streaming_period: str,
    skip_periods: set[str] | None = None,
    only_changed: bool = False,
) -> DataFrame:
    """Write monthly files below ``target/year=/month=`` and return the manifest.

    Files are grouped by schema, so drift between months stays in the landed
    files. Months in ``skip_periods`` are left alone, and with ``only_changed``
    those, too, whose files have the names, sizes and times that they had when
    they were landed.
    """
    folders.require_period(streaming_period)
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "*.parquet"
    ).load(source).select("path", "length", "modificationTime")
    wanted = listing.withColumn(
        "period", period_of_file(F.element_at(F.split("path", "/"), -1))
    ).filter(F.col("period").isNotNull() & (F.col("period") != F.lit(streaming_period)))
    if skip_periods:
        wanted = wanted.filter(~F.col("period").isin(sorted(skip_periods)))
    # One short line per monthly file, and one per month.
    found = wanted.orderBy("path").collect()
    seen: dict[str, list] = defaultdict(list)
    for r in found:
        seen[r.period].append(f"{r.path} {r.length} {r.modificationTime.isoformat()}")
    known_path = f"{target.rstrip('/')}/{LANDED_FILES}"
    known = {}
    if folders.exists(spark, known_path):
        known = {r.period: list(r.files) for r in spark.read.parquet(known_path).collect()}
    period_of = {
        r.path: r.period for r in found
        if not only_changed or known.get(r.period) != seen[r.period]
    }
    manifests, landed = [], set()
    for group in _by_schema(spark, list(period_of)).values():
        # A month whose files differ in schema meets two groups: the first
        # replaces what was there, later ones add to it.
        for mode, paths in (
            ("overwrite", [p for p in group if period_of[p] not in landed]),
            ("append", [p for p in group if period_of[p] in landed]),
        ):
            if paths:
                rows = spark.read.parquet(*paths).withColumn(
                    "source_file", F.col("_metadata.file_name")
                )
                _write_landed(rows, target, streaming_period, mode)
                manifests.append(landing_manifest(rows, "source_file", streaming_period))
        landed |= {period_of[p] for p in group}
    if manifests:
        state = spark.createDataFrame(
            sorted({**known, **seen}.items()), "period string, files array<string>"
        )
        state.coalesce(1).write.mode("overwrite").parquet(known_path)
    if not manifests:
        return spark.createDataFrame(
            [], "source_period string, row_count bigint, source_files bigint"
        )
    return reduce(DataFrame.unionByName, manifests).groupBy("source_period").agg(
        F.sum("row_count").alias("row_count"), F.sum("source_files").alias("source_files")
    )


def _write_landed(rows: DataFrame, target: str, streaming_period: str, mode: str) -> None:
    accepted = accepted_for_landing(rows, "source_file", streaming_period)
    (
        accepted.withColumn("year", F.substring("source_period", 1, 4))
        .withColumn("month", F.substring("source_period", 6, 2))
        .drop("source_file", "source_period")
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy("year", "month")
        .parquet(target)
    )


def _schema_key(schema: T.StructType) -> tuple:
    return tuple((f.name, f.dataType.simpleString()) for f in schema)


def _by_schema(spark: SparkSession, paths: list[str]) -> dict[tuple, list[str]]:
    """Group files by their physical schema."""
    groups: dict[tuple, list[str]] = defaultdict(list)
    for path in paths:
        groups[_schema_key(spark.read.parquet(path).schema)].append(path)
    return groups


def _month_groups(
    spark: SparkSession, months: list[str]
) -> list[tuple[T.StructType, list[str]]]:
    """Group month folders whose files can be read with one schema.

    The footers of a month are merged by a Spark job, so a column that only some
    of its files have is not lost. Only a month whose files disagree on a type is
    taken apart file by file.
    """
    schemas: dict[tuple, T.StructType] = {}
    members: dict[tuple, list[str]] = defaultdict(list)

    def add(path: str, schema: T.StructType) -> None:
        schemas.setdefault(_schema_key(schema), schema)
        members[_schema_key(schema)].append(path)

    merging = spark.read.option("mergeSchema", "true")
    for month in months:
        try:
            add(month, merging.parquet(month).schema)
        except (Py4JJavaError, PySparkException) as error:
            if "UNABLE_TO_INFER_SCHEMA" in str(error):
                continue  # a folder whose files were removed
            if "CANNOT_MERGE_SCHEMAS" not in str(error):
                raise
            files = spark.read.format("binaryFile").option(
                "pathGlobFilter", "*.parquet"
            ).load(month).select("path")
            for row in files.orderBy("path").collect():
                add(row.path, spark.read.parquet(row.path).schema)
    return [(schemas[key], paths) for key, paths in members.items()]


def read_months(
    spark: SparkSession,
    root: str,
    wanted: set[str] | None = None,
    wall_clock: bool = False,
    files: list[str] | None = None,
    file_column: str | None = None,
) -> DataFrame | None:
    """All landed months in the canonical layout; None when none is found.

    One scan per distinct schema instead of one per month: the plan grows with
    the number of drifts, not with the number of months. With ``files`` only
    these are read; ``file_column`` names a column for each row's file.
    """
    months = folders.period_folders(spark, root, wanted)
    frames = []
    for schema, paths in _month_groups(spark, [path for _, path in months]):
        rows = spark.read.schema(schema).option("basePath", root).parquet(*paths)
        rows, beside = _of_files(rows, files, file_column)
        frames.append(batch_to_canonical(rows, _folder_period(), wall_clock, beside))
    return union_all(frames)


def _folder_period() -> Column:
    return F.concat_ws("-", F.col("year").cast("string"), two_digits(F.col("month")))


def _of_files(
    rows: DataFrame, files: list[str] | None, file_column: str | None
) -> tuple[DataFrame, tuple[Column, ...]]:
    """A scan of some files only (others are not opened), and the column that
    names each row's file."""
    path = F.col("_metadata.file_path")
    if files is not None:
        rows = rows.filter(path.isin(files))
    return rows, () if file_column is None else (path.alias(file_column),)


def read_messages(
    spark: SparkSession,
    root: str,
    wall_clock: bool = False,
    files: list[str] | None = None,
    file_column: str | None = None,
    periods: set[str] | None = None,
) -> DataFrame | None:
    """Stored messages in the canonical layout; None when the folder is absent.

    ``files`` and ``file_column`` are as for ``read_months``; ``periods`` keeps
    the folders of these months.
    """
    if not folders.exists(spark, root):
        return None
    rows = spark.read.parquet(root)
    if "raw_json" not in rows.columns:
        raise ValueError(f"{root} has no raw_json column")
    if periods is not None:
        rows = rows.filter(_folder_period().isin(sorted(periods)))
    rows, beside = _of_files(rows, files, file_column)
    return messages_to_canonical(rows, wall_clock, beside)


def union_all(frames: list[DataFrame]) -> DataFrame | None:
    if not frames:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
