"""Message source, decoding, and the partitioned streaming sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from triplake.schemas import MESSAGE_SCHEMA
from triplake.sources.folders import require_period
from triplake.sources.messages import EOF_KEY


def kafka_source(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> DataFrame:
    """All messages from the earliest offset; lost offsets stop the query.

    Messages of one month share a key and therefore one Kafka partition.
    ``min_partitions`` lets Spark read ranges of its offsets in parallel.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("failOnDataLoss", "true")
    )
    if max_offsets_per_trigger is not None:
        _require_positive(max_offsets_per_trigger, "max_offsets_per_trigger")
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    if min_partitions is not None:
        _require_positive(min_partitions, "min_partitions")
        reader = reader.option("minPartitions", min_partitions)
    return reader.load()


def replay_source(
    spark: SparkSession, folder: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The same columns from stored messages, for replays without a broker."""
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if max_files_per_trigger is not None:
        _require_positive(max_files_per_trigger, "max_files_per_trigger")
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(folder)


def _require_positive(value: int, name: str) -> None:
    if value <= 0:
        raise ValueError(f"{name} must be positive")


def decode(messages: DataFrame) -> DataFrame:
    """Text key and payload with Kafka columns and the folder columns."""
    return messages.select(
        F.col("value").cast("string").alias("raw_json"),
        F.col("key").cast("string").alias("year_month"),
        F.substring(F.col("key").cast("string"), 1, 4).alias("year"),
        F.substring(F.col("key").cast("string"), 6, 2).alias("month"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
    )


def is_eof(raw_json: Column) -> Column:
    """True for the closing control row; an unreadable flag counts as false."""
    flag = F.get_json_object(raw_json, f"$.{EOF_KEY}").try_cast("boolean")
    # Only payloads that can hold the flag, plain or escaped, are parsed.
    possible = F.contains(raw_json, F.lit(EOF_KEY)) | F.contains(raw_json, F.lit("\\u"))
    return F.coalesce(possible & flag, F.lit(False))


def accept(decoded: DataFrame, period: str | None = None) -> DataFrame:
    """Trip messages, of one period if given; a missing key is dropped."""
    wanted = F.col("year_month").isNotNull() if period is None else (
        F.col("year_month") == period
    )
    return decoded.filter(wanted & ~is_eof(F.col("raw_json")))


def bronze_writer(
    bronze: DataFrame,
    checkpoint: str,
    trigger_seconds: int = 5,
    until_done: bool = False,
) -> DataStreamWriter:
    """Append to Parquet by year and month; the checkpoint makes restarts exact.

    ``until_done`` processes what is there and stops. Otherwise a batch starts
    every ``trigger_seconds``, or as soon as the last one ends for 0.
    """
    if trigger_seconds < 0:
        raise ValueError("trigger_seconds must not be negative")
    writer = (
        bronze.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .partitionBy("year", "month")
    )
    if until_done:
        return writer.trigger(availableNow=True)
    if trigger_seconds > 0:
        return writer.trigger(processingTime=f"{trigger_seconds} seconds")
    return writer


def start_ingest(
    messages: DataFrame,
    period: str,
    target: str,
    checkpoint: str,
    trigger_seconds: int = 5,
    until_done: bool = False,
) -> StreamingQuery:
    """Decode, filter and store one month of messages."""
    bronze = accept(decode(messages), require_period(period))
    return bronze_writer(bronze, checkpoint, trigger_seconds, until_done).start(target)
