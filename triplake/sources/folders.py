"""Folder listing through the file system that the path itself names."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed pattern: a period is a month of this century.
PERIOD_PATTERN = r"(20\d{2})-(0[1-9]|1[0-2])"
_PERIOD = re.compile(PERIOD_PATTERN)


def is_period(text: str) -> bool:
    return _PERIOD.fullmatch(text) is not None


def require_period(text: str) -> str:
    if not is_period(text):
        raise ValueError(f"expected YYYY-MM, got {text!r}")
    return text


def _open(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location, location.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    location, system = _open(spark, path)
    return bool(system.exists(location))


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder with all in it, if there is one."""
    location, system = _open(spark, path)
    system.delete(location, True)


def list_files(spark: SparkSession, root: str, source: str) -> DataFrame:
    """source, file, size and modified of each Parquet file below a folder.

    Only the listing is read. Names are those that ``_metadata.file_path`` has.
    """
    if not exists(spark, root):
        return spark.createDataFrame(
            [], "source string, file string, size bigint, modified timestamp"
        )
    found = spark.read.format("binaryFile").options(
        recursiveFileLookup="true", pathGlobFilter="*.parquet"
    ).load(root)
    return found.select(
        F.lit(source).alias("source"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def latest_version(spark: SparkSession, root: str) -> str | None:
    """The newest complete table below ``root``; see write_version."""
    location, system = _open(spark, root)
    if not system.exists(location):
        return None
    done = [
        status.getPath().toString() for status in system.listStatus(location)
        if exists(spark, f"{status.getPath().toString()}/_SUCCESS")
    ]
    return max(done, default=None)


def write_version(df: DataFrame, root: str) -> None:
    """Write a table beside its last version, then drop that.

    A run that fails on the way leaves the last version in place.
    """
    spark = df.sparkSession
    last = latest_version(spark, root)
    number = int(last.rsplit("-", 1)[-1]) + 1 if last else 1
    df.write.mode("overwrite").parquet(f"{root.rstrip('/')}/version-{number:012d}")
    if last:
        delete(spark, last)


def period_folders(
    spark: SparkSession, root: str, wanted: set[str] | None = None
) -> list[tuple[str, str]]:
    """Sorted ``(YYYY-MM, folder)`` pairs below ``root/year=YYYY/month=MM``."""
    location, system = _open(spark, root)
    if not system.exists(location):
        raise FileNotFoundError(f"no such folder: {root}")
    pattern = spark._jvm.org.apache.hadoop.fs.Path(location, "year=*/month=*")
    found = []
    for status in system.globStatus(pattern):
        folder = status.getPath()
        year = folder.getParent().getName().removeprefix("year=")
        month = folder.getName().removeprefix("month=")
        period = f"{year}-{month}"
        if not status.isDirectory() or not is_period(period):
            continue
        if wanted is None or period in wanted:
            found.append((period, folder.toString()))
    return sorted(found)
