"""Session options the jobs rely on, kept in one place."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_own_folder: list[tempfile.TemporaryDirectory] = []

TRIP_TIME_ZONE = "America/New_York"

OPTIONS = {
    # Casts are written tolerantly where bad input is expected, so anything
    # else that overflows or fails to parse should stop the job.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Splitting a hot join key is worth an extra shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Numbers inside messages need not keep their exact spelling; values stay.
    "spark.sql.json.enableExactStringParsing": "false",
    # No Python stack capture per column expression; it slows plan building.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.parquet.compression.codec": "snappy",
    # A task that meets few periods keeps one writer open per period instead
    # of sorting its rows first.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}


def open_session(
    app_name: str,
    time_zone: str = TRIP_TIME_ZONE,
    shuffle_partitions: int | None = None,
    **extra: str,
) -> SparkSession:
    """Get or create the session; master and resources come from spark-submit."""
    builder = SparkSession.builder.appName(app_name).config(
        "spark.sql.session.timeZone", time_zone
    )
    for key, value in OPTIONS.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in extra.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """A folder every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``. Only a session on one machine
    may lack that setting (tests, a laptop); it gets a temporary folder that goes
    when the process ends. On a cluster other machines would not see that folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _own_folder:
        _own_folder.append(tempfile.TemporaryDirectory(prefix="triplake-"))
    return _own_folder[0].name


def new_scratch(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the shared one."""
    return f"{shared_folder(spark)}/{purpose}-{os.urandom(8).hex()}"
