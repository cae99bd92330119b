"""Was every message of a finite stream stored, and stored once?"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplake.schemas import MESSAGE_SCHEMA
from triplake.sources import folders

_PROGRESS = "batch_id bigint, end_offset bigint, committed boolean"


def offset_audit(bronze: DataFrame) -> DataFrame:
    """Rows, offset range, gaps and repeats per Kafka partition.

    Offsets are first grouped to one row each, so a topic with all its messages
    in one partition is still spread over the cluster.
    """
    per_offset = bronze.groupBy("kafka_partition", "kafka_offset").agg(
        F.count(F.lit(1)).alias("copies")
    )
    span = F.max("kafka_offset") - F.min("kafka_offset") + 1
    return per_offset.groupBy("kafka_partition").agg(
        F.sum("copies").alias("row_count"),
        F.min("kafka_offset").alias("min_offset"),
        F.max("kafka_offset").alias("max_offset"),
        (span - F.count("kafka_offset")).alias("gaps"),
        (F.sum("copies") - F.count("kafka_offset")).alias("duplicates"),
    )


def completion(
    audit: DataFrame, source_rows: int, progress: DataFrame | None = None
) -> DataFrame:
    """One row comparing what was stored with the rows that were sent.

    A complete stream holds every row once. With ``progress`` (the last batch of
    the checkpoint), that batch must also end behind all rows and the control row,
    and be committed.
    """
    stored = F.coalesce(F.sum("row_count"), F.lit(0))
    repeats = F.coalesce(F.sum("duplicates"), F.lit(0))
    counted = audit.agg(stored.alias("stored_rows"), repeats.alias("duplicates"))
    expected = F.lit(source_rows + 1).cast("bigint")
    done = F.lit(True)
    if progress is not None:
        counted = counted.withColumns(
            {
                "end_offset": progress.agg(F.max("end_offset")).scalar(),
                "committed": F.coalesce(
                    progress.agg(F.bool_or("committed")).scalar(), F.lit(False)
                ),
            }
        )
        done = F.coalesce(F.col("end_offset") == expected, F.lit(False)) & F.col("committed")
    state = (
        F.when((F.col("duplicates") > 0) | (F.col("stored_rows") > source_rows), "overshoot")
        .when((F.col("stored_rows") == source_rows) & done, "complete")
        .otherwise("incomplete")
    )
    more = [] if progress is None else ["end_offset", "committed"]
    return counted.select(
        "stored_rows",
        F.lit(source_rows).cast("bigint").alias("expected_rows"),
        expected.alias("expected_messages"),
        "duplicates",
        *more,
        state.alias("state"),
    )


def checkpoint_progress(spark: SparkSession, checkpoint: str, topic: str) -> DataFrame:
    """Last planned batch of a Kafka query, its total end offset, and its commit.

    Reads the small offset and commit logs of the checkpoint.
    """
    if not folders.exists(spark, f"{checkpoint}/offsets"):
        return spark.createDataFrame([], _PROGRESS)
    by_topic = F.from_json("value", "map<string,map<string,bigint>>")
    planned = (
        _log(spark, f"{checkpoint}/offsets")
        .select("batch_id", F.element_at(by_topic, F.lit(topic)).alias("ends"))
        .filter(F.col("ends").isNotNull())
        .select("batch_id", F.explode("ends").alias("kafka_partition", "end_offset"))
        .groupBy("batch_id")
        .agg(F.sum("end_offset").alias("end_offset"))
        .orderBy(F.desc("batch_id"))
        .limit(1)
    )
    return _with_commit(planned, checkpoint)


def replay_progress(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The same for a query over stored messages.

    The end is the number of messages in the files that were planned up to the
    last batch, which the source's own log names.
    """
    if not folders.exists(spark, f"{checkpoint}/sources/0"):
        return spark.createDataFrame([], _PROGRESS)
    files = spark.read.text(f"{checkpoint}/sources/0", recursiveFileLookup=True).select(
        F.from_json("value", "path string, batchId bigint").alias("f")
    ).select("f.path", "f.batchId").filter(F.col("path").isNotNull()).distinct()
    # A short name for each file.
    planned = files.collect()
    if not planned:
        return spark.createDataFrame([], _PROGRESS)
    messages = spark.read.schema(MESSAGE_SCHEMA).parquet(*[r.path for r in planned])
    batches = _log(spark, f"{checkpoint}/offsets").agg(F.max("batch_id").alias("batch_id"))
    ends = messages.agg(F.count(F.lit(1))).scalar()
    return _with_commit(
        batches.filter(F.col("batch_id").isNotNull()).withColumn("end_offset", ends), checkpoint
    )


def _log(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of a checkpoint log with the number of their batch."""
    lines = spark.read.text(folder, recursiveFileLookup=True)
    return lines.select(
        "value",
        F.regexp_extract(F.col("_metadata.file_name"), r"^(\d+)$", 1)
        .try_cast("bigint")
        .alias("batch_id"),
    ).filter(F.col("batch_id").isNotNull())


def _with_commit(planned: DataFrame, checkpoint: str) -> DataFrame:
    spark = planned.sparkSession
    if not folders.exists(spark, f"{checkpoint}/commits"):
        return planned.withColumn("committed", F.lit(False))
    commits = _log(spark, f"{checkpoint}/commits").select(
        "batch_id", F.lit(True).alias("seen")
    ).distinct()
    return planned.join(commits, "batch_id", "left").select(
        "batch_id", "end_offset", F.coalesce("seen", F.lit(False)).alias("committed")
    )
