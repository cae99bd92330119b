"""Zone file reader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from triplake.operators.enrich import zones_from_file_rows
from triplake.sources import folders


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Zones from a CSV with a header. ``N/A`` stays text."""
    if not folders.exists(spark, path):
        raise FileNotFoundError(f"no such zone file: {path}")
    # All text first: the casts are ours and no inference pass is needed.
    return zones_from_file_rows(spark.read.option("header", "true").csv(path))
