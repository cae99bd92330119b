"""One fixed trip layout from drifting files and from JSON messages."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triplake.functions.casts import text_to_double, text_to_long, to_kind
from triplake.functions.timeparts import two_digits
from triplake.schemas import TRIP_FIELDS, TripField


def pick_column(available: Iterable[str], candidates: Iterable[str]) -> str | None:
    """First candidate that exists; per candidate, exact case wins."""
    names = list(available)
    for candidate in candidates:
        same = [n for n in names if n == candidate]
        alike = [n for n in names if n.lower() == candidate.lower()]
        if same or alike:
            return (same or alike)[0]
    return None


def _lineage(source: str, period: Column, partition: Column, offset: Column, time: Column):
    return [
        F.lit(source).alias("ingestion_source"),
        period.alias("source_year_month"),
        partition.cast("bigint").alias("kafka_partition"),
        offset.cast("bigint").alias("kafka_offset"),
        time.cast("timestamp").alias("kafka_timestamp"),
    ]


def batch_to_canonical(
    df: DataFrame, period: Column | str, wall_clock: bool = False, beside: tuple[Column, ...] = ()
) -> DataFrame:
    """Project one file layout to the canonical columns; absent ones become NULL.

    Columns in ``beside`` are carried along behind them.
    """
    types = {f.name: f.dataType for f in df.schema}

    def convert(field: TripField) -> Column:
        found = pick_column(df.columns, field.sources)
        if found is None:
            return to_kind(F.lit(None), T.NullType(), field.kind, wall_clock)
        return to_kind(F.col(f"`{found}`"), types[found], field.kind, wall_clock)

    columns = [convert(field).alias(field.name) for field in TRIP_FIELDS]
    period = F.lit(period) if isinstance(period, str) else period
    missing = F.lit(None)
    return df.select(*columns, *_lineage("batch", period, missing, missing, missing), *beside)


def _with_payload(df: DataFrame) -> DataFrame:
    """Parse each message once and add every wanted key as text: k0, k1, and so on.

    Keys that differ only by case cannot be addressed by name, so the parsed
    struct is renamed by position. It is unpacked by a generator because filters
    are not pushed below one: pushed below a projection, every filter on a
    parsed field would parse the message again.
    """
    keys = [key for field in TRIP_FIELDS for key in field.sources]
    parsed = T.StructType([T.StructField(key, T.StringType()) for key in keys])
    renamed = T.StructType(
        [T.StructField(f"k{i}", T.StringType()) for i in range(len(keys))]
    )
    payload = F.from_json("raw_json", parsed).cast(renamed)
    return df.select("*", F.inline(F.array(payload)))


def messages_to_canonical(
    df: DataFrame, wall_clock: bool = False, beside: tuple[Column, ...] = ()
) -> DataFrame:
    """Stored messages (raw JSON and Kafka columns) in the canonical layout.

    Columns in ``beside`` are carried along behind it.
    """
    readers = {
        "long": text_to_long,
        "double": text_to_double,
        "string": lambda text: text,
        "time": lambda text: to_kind(text, T.StringType(), "time", wall_clock),
    }
    columns, position = [], 0
    for field in TRIP_FIELDS:
        texts = [F.col(f"k{position + i}") for i in range(len(field.sources))]
        position += len(texts)
        text = texts[0] if len(texts) == 1 else F.coalesce(*texts)
        columns.append(readers[field.kind](text).alias(field.name))
    period = F.coalesce(
        F.col("year_month"),
        F.concat_ws("-", F.col("year").cast("string"), two_digits(F.col("month"))),
    )
    lineage = _lineage(
        "streaming",
        period,
        F.col("kafka_partition"),
        F.col("kafka_offset"),
        F.col("kafka_timestamp"),
    )
    return _with_payload(df).select(*columns, *lineage, *beside)
