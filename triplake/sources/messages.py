"""Trips as keyed JSON messages with a closing control row."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from triplake.operators.enrich import lookup_join
from triplake.sources.tables import stored

EOF_KEY = "__eof__"

# Microseconds are kept; NULL fields stay visible in the payload.
JSON_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "ignoreNullFields": "false",
}


def to_messages(rows: DataFrame, period: str, beside: tuple[str, ...] = ()) -> DataFrame:
    """``key`` and ``value`` of each row.

    Sent are all columns but the period and those named in ``beside``, which are
    carried along next to the message.
    """
    sent = [name for name in rows.columns if name != period and name not in beside]
    return rows.select(
        *beside,
        F.col(period).cast("binary").alias("key"),
        F.to_json(F.struct(*sent), JSON_OPTIONS).cast("binary").alias("value"),
    )


def eof_messages(rows: DataFrame, period: str) -> DataFrame:
    """One control row per period with the number of rows sent."""
    return rows.groupBy(period).agg(F.count(F.lit(1)).alias("rows_sent")).select(
        F.col(period).cast("binary").alias("key"),
        F.to_json(
            F.struct(
                F.lit(True).alias(EOF_KEY),
                F.col(period).alias("year_month"),
                F.col("rows_sent"),
            )
        ).cast("binary").alias("value"),
    )


def file_starts(rows: DataFrame) -> DataFrame:
    """_start_file, _start and _end: the positions that the rows of each file have,
    in the order of file names; stored, one short row for each file.

    ``rows`` must come straight from Parquet files. Files are summed within ranges
    of names, ranges by their totals, so no task holds all files.
    """
    per_file = stored(
        rows.groupBy(F.col("_metadata.file_path").alias("_start_file"))
        .agg(F.count(F.lit(1)).alias("_rows")),
        "file-rows",
    )
    ranged = stored(
        per_file.repartitionByRange("_start_file").withColumn("_range", F.spark_partition_id()),
        "file-ranges",
    )
    # One total for each shuffle partition.
    totals = sorted(ranged.groupBy("_range").agg(F.sum("_rows")).collect())
    behind = [0, *accumulate(n for _, n in totals)]
    before = rows.sparkSession.createDataFrame(
        [(number, start) for (number, _), start in zip(totals, behind)],
        "_range int, _before bigint",
    )
    earlier = Window.partitionBy("_range").orderBy("_start_file").rowsBetween(
        Window.unboundedPreceding, -1
    )
    within = F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
    return stored(
        ranged.select("_start_file", "_range", "_rows", within.alias("_within"))
        .join(before, "_range").withColumn("_start", F.col("_before") + F.col("_within"))
        .select("_start_file", "_start", (F.col("_start") + F.col("_rows")).alias("_end")),
        "file-starts",
    )


def with_position(rows: DataFrame, name: str, starts: DataFrame | None = None) -> DataFrame:
    """Add the position of each row in file and row order, without sorting rows.

    A row's position is its own place in its file behind the rows of earlier
    files; ``starts`` may be given when they are known (see file_starts).
    """
    starts = file_starts(rows) if starts is None else starts
    placed = rows.withColumns(
        {"_file": F.col("_metadata.file_path"), "_index": F.col("_metadata.row_index")}
    )
    located = lookup_join(placed, starts.drop("_end"), "_file", "_start_file", "inner")
    position = (F.col("_start") + F.col("_index")).alias(name)
    return located.select(*rows.columns, position)


def rows_between(
    rows: DataFrame, first: int, end: int, starts: DataFrame, name: str
) -> DataFrame:
    """The rows from one position up to another, with their position. Only files
    that have such rows are opened."""
    files = starts.filter((F.col("_start") < end) & (F.col("_end") > first))
    # A short name for each of these files.
    names = [r[0] for r in files.select("_start_file").collect()]
    wanted = rows.filter(F.col("_metadata.file_path").isin(names))
    position = F.col(name)
    return with_position(wanted, name, files).filter((position >= first) & (position < end))


def first_rows(rows: DataFrame, limit: int) -> DataFrame:
    """The first rows of a scan in file and row order; see with_position."""
    if limit <= 0:
        raise ValueError("limit must be positive")
    found = rows_between(rows, 0, limit, file_starts(rows), "_position")
    return found.drop("_position")


def send(messages: DataFrame, bootstrap_servers: str, topic: str) -> None:
    """Publish to Kafka; needs the Kafka connector on the class path.

    Returns once the brokers have acknowledged every message. A ``partition``
    column, if there is one, says where each message goes.
    """
    kafka = [c for c in ("key", "value", "partition") if c in messages.columns]
    (
        messages.select(*kafka).write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("kafka.acks", "all")
        .option("topic", topic)
        .save()
    )


def store(messages: DataFrame, folder: str, topic: str) -> None:
    """Append messages as the replay source reads them."""
    messages.select(
        "key", "value", F.lit(topic).alias("topic"), F.col("partition").cast("int"),
        F.col("offset").cast("bigint"), F.current_timestamp().alias("timestamp"),
    ).write.mode("append").parquet(folder)
