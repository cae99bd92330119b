"""Sending a month as messages, and telling when it has been stored."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplake.sources import folders, messages
from triplake.streaming import audit

PARTITIONS = 3
#: Rows that are sent and acknowledged together.
CHUNK_ROWS = 10_000_000
_LOG = "first bigint, end bigint, acknowledged boolean"


def _control_row(spark: SparkSession, period: str, sent: int, offset: int) -> DataFrame:
    return spark.range(1).select(
        F.lit(0).alias("partition"), F.lit(offset).cast("bigint").alias("offset"),
        F.lit(period).cast("binary").alias("key"),
        F.to_json(
            F.struct(
                F.lit(True).alias(messages.EOF_KEY), F.lit(period).alias("year_month"),
                F.lit(sent).alias("rows_sent"),
            )
        ).cast("binary").alias("value"),
    )


def send_month(
    spark: SparkSession,
    source: str,
    period: str,
    publish: Callable[[DataFrame], None],
    max_rows: int | None = None,
    partitions: int = PARTITIONS,
    log: str | None = None,
    chunk_rows: int = CHUNK_ROWS,
    arrived: Callable[[], DataFrame] | None = None,
) -> int:
    """Publish the rows of a month, then its control row; returns the rows sent.

    ``publish`` returns when its messages are safe. The control row goes out in a
    call of its own afterwards, so it never overtakes a row. Rows go to the
    partitions in turn by their position, which also numbers them.

    With a folder for the ``log``, rows go out in chunks of positions, each noted
    before it goes and when it is safe; a run that failed goes on behind the last
    safe chunk. The one that was on its way may have arrived in part: ``arrived``
    gives partition and offset of what is there, and only the rest is sent.
    Without it that chunk is sent once more.
    """
    folders.require_period(period)
    if max_rows is not None and max_rows <= 0:
        raise ValueError("max_rows must be positive")
    rows = spark.read.parquet(source)
    starts = messages.file_starts(rows)
    total = starts.agg(F.coalesce(F.max("_end"), F.lit(0))).first()[0]
    total = total if max_rows is None else min(total, max_rows)
    done: list[tuple[int, int, bool]] = []
    if log is not None:
        version = folders.latest_version(spark, log)
        if version is not None:
            done = [tuple(r) for r in spark.read.schema(_LOG).parquet(version).orderBy("first").collect()]
    size = total if log is None else chunk_rows

    def note(first: int, end: int, safe: bool) -> None:
        if log is not None:
            done[:] = [d for d in done if d[0] != first] + [(first, end, safe)]
            folders.write_version(spark.createDataFrame(done, _LOG).coalesce(1), log)

    def chunk(first: int, end: int) -> DataFrame:
        place = {
            "partition": F.pmod("_position", F.lit(partitions)).cast("int"),
            "offset": F.expr(f"_position div {partitions}"),
            "_period": F.lit(period),
        }
        part = messages.rows_between(rows, first, end, starts, "_position")
        part = part.withColumns(place).drop("_position")
        return messages.to_messages(part, "_period", beside=("partition", "offset"))

    # The control row is the chunk behind the last row.
    behind = -(-total // partitions)
    pieces = [(n, min(n + size, total)) for n in range(0, total, size)] if total else []
    for first, end in [*pieces, (total, total + 1)]:
        before = next((d for d in done if d[0] == first), None)
        if before is not None and before[2]:
            if before[1] != end:
                raise ValueError("the log was written for other rows or chunks")
            continue
        out = chunk(first, end) if first < total else _control_row(spark, period, total, behind)
        if before is not None and arrived is not None:
            out = out.join(arrived().select("partition", "offset").distinct(), ["partition", "offset"], "left_anti")
        note(first, end, False)
        publish(out)
        note(first, end, True)
    return total


def stream_state(
    spark: SparkSession, stream_root: str, checkpoint: str, topic: str, source_rows: int
) -> DataFrame:
    """Whether a finite stream of a Kafka topic is complete; see audit.completion."""
    if folders.exists(spark, stream_root):
        stored = spark.read.parquet(stream_root).select("kafka_partition", "kafka_offset")
    else:
        stored = spark.createDataFrame([], "kafka_partition int, kafka_offset bigint")
    progress = audit.checkpoint_progress(spark, checkpoint, topic)
    return audit.completion(audit.offset_audit(stored), source_rows, progress)
