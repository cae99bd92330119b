"""Trip-shaped frames over the test tables (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplake.functions.timeparts import period_text
from triplake.operators.canonical import batch_to_canonical, messages_to_canonical
from triplake.operators.enrich import lookup_join
from triplake.plans.trips import trip_table
from triplake.sources.bronze import union_all
from triplake.sources.messages import to_messages
from triplake.streaming.ingest import accept, decode

TOPIC = "trips"
KEY_PARTITIONS = 3
WRONG_PERIOD = {"month": "2023-12", "day": "2023-12-31"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spread(df: DataFrame, splits: int = 2) -> DataFrame:
    """One small file over all cores, in front of costly parsing. A table that is
    read in so many splits a core is spread as it is, and its splits do not grow."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= splits * cores else df.repartition(cores)


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("bigint").alias("location_id"),
        F.col("r_name").alias("borough"),
        F.col("n_name").alias("zone"),
        F.concat(F.lit("service-"), (F.col("n_regionkey") % 2).cast("string")).alias(
            "service_zone"
        ),
    )


def event_files(spark: SparkSession, sf_dir: str, unit: str = "month") -> DataFrame:
    """Events as rows of a monthly file, with event id and source period."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    seconds = (F.floor(F.col("value") * 60) - 30).cast("decimal(18,6)")
    zero = F.lit(0)
    payments = F.create_map(
        *[F.lit(v) for v in ("click", 1, "view", 2, "purchase", 3, "signup", 4)]
    )
    # A generator keeps later filters from repeating the parse.
    events = _spread(table(spark, sf_dir, "events")).select(
        "*", F.explode(F.array(k)).alias("k")
    )
    return events.select(
        "event_id",
        (F.col("k") % 5).alias("VendorID"),
        F.col("ts").alias("tpep_pickup_datetime"),
        (F.col("ts") + F.make_dt_interval(zero, zero, zero, seconds)).alias(
            "tpep_dropoff_datetime"
        ),
        F.when(F.col("k") % 10 != 9, (F.col("k") % 8).cast("double")).alias("passenger_count"),
        F.when(F.col("k") % 20 == 0, F.lit(-1.0)).otherwise(F.col("k") / F.lit(10.0)).alias(
            "trip_distance"
        ),
        (1 + F.col("k") % 7).alias("RatecodeID"),
        F.when(F.col("k") % 2 == 0, "Y").otherwise("N").alias("store_and_fwd_flag"),
        (F.col("user_id") % 30).alias("PULocationID"),
        ((F.col("user_id") * 7 + F.col("event_id")) % 30).alias("DOLocationID"),
        payments[F.col("event_type")].cast("bigint").alias("payment_type"),
        F.col("value").alias("fare_amount"),
        ((F.col("k") % 4) / F.lit(2.0)).alias("extra"),
        F.when(F.col("k") % 6 != 0, F.col("k") / F.lit(4.0)).alias("tip_amount"),
        F.when(F.col("k") % 9 == 0, F.lit(6.55)).otherwise(F.lit(0.0)).alias("tolls_amount"),
        F.when(F.col("k") % 13 != 0, F.col("value")).alias("total_amount"),
        F.when(F.col("user_id") % 30 == 1, F.lit(1.25)).alias("airport_fee"),
        F.when(F.col("k") == 7, F.lit(WRONG_PERIOD[unit]))
        .otherwise(period_text(F.col("ts"), unit))
        .alias("source_period"),
    )


def events_batch(spark: SparkSession, sf_dir: str, unit: str = "month") -> DataFrame:
    return batch_to_canonical(
        event_files(spark, sf_dir, unit), F.col("source_period"), wall_clock=True
    )


def event_messages(spark: SparkSession, sf_dir: str, unit: str = "month") -> DataFrame:
    """Events as Kafka rows, and a control row at the next offset of partition 0."""
    files = event_files(spark, sf_dir, unit)
    placed = files.withColumns(
        {
            "partition": (F.col("event_id") % KEY_PARTITIONS).cast("int"),
            "offset": F.expr(f"event_id div {KEY_PARTITIONS}"),
            "timestamp": F.col("tpep_pickup_datetime").cast("timestamp"),
        }
    ).drop("event_id")
    kafka = ("partition", "offset", "timestamp")
    messages = to_messages(placed, "source_period", beside=kafka)
    # As above: the JSON text is built once, as if it had been stored.
    messages = messages.select(*kafka, "key", F.explode(F.array("value")).alias("value"))
    eof = placed.agg(
        F.max("source_period").alias("last_period"),
        F.count(F.lit(1)).alias("rows_sent"),
        F.max(F.when(F.col("partition") == 0, F.col("offset"))).alias("last_offset"),
        F.max("timestamp").alias("timestamp"),
    ).select(
        F.lit(0).alias("partition"),
        (F.col("last_offset") + 1).alias("offset"),
        "timestamp",
        F.col("last_period").cast("binary").alias("key"),
        F.to_json(
            F.struct(
                F.lit(True).alias("__eof__"),
                F.col("last_period").alias("year_month"),
                "rows_sent",
            )
        )
        .cast("binary")
        .alias("value"),
    )
    return messages.unionByName(eof).select(
        "key", "value", F.lit(TOPIC).alias("topic"), "partition", "offset", "timestamp"
    )


def event_bronze(spark: SparkSession, sf_dir: str, unit: str = "month") -> DataFrame:
    return accept(decode(event_messages(spark, sf_dir, unit)))


def events_stream(spark: SparkSession, sf_dir: str, unit: str = "month") -> DataFrame:
    return messages_to_canonical(event_bronze(spark, sf_dir, unit), wall_clock=True)


def order_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as rows of monthly files, with source period and file name."""
    lines = _spread(table(spark, sf_dir, "lineitem"), splits=1).select(
        "l_orderkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax",
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority"
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # Orders meet their customers first, so that lines are shuffled once at most.
    orders = lookup_join(orders, customers, "o_custkey", "c_custkey", "inner")
    joined = lookup_join(lines, suppliers, "l_suppkey", "s_suppkey", "inner")
    joined = lookup_join(joined, orders, "l_orderkey", "o_orderkey", "inner")
    month = period_text(F.col("o_orderdate"))
    century_later = F.concat(
        (F.year("o_orderdate") + 20).cast("string"), F.substring(month, 5, 3)
    )
    return joined.select(
        "l_orderkey",
        (F.col("l_suppkey") % 3).alias("VendorID"),
        F.col("o_orderdate").alias("tpep_pickup_datetime"),
        F.col("l_shipdate").alias("tpep_dropoff_datetime"),
        (F.col("l_linenumber") % 7).alias("passenger_count"),
        F.col("l_quantity").alias("trip_distance"),
        F.col("l_linenumber").alias("RatecodeID"),
        F.col("c_nationkey").alias("PULocationID"),
        F.col("s_nationkey").alias("DOLocationID"),
        F.substring("o_orderpriority", 1, 1).alias("payment_type"),
        F.col("l_extendedprice").alias("fare_amount"),
        F.col("l_discount").alias("extra"),
        F.col("l_tax").alias("tip_amount"),
        F.col("o_totalprice").alias("total_amount"),
        month.alias("source_period"),
        F.when(F.col("l_linenumber") == 7, F.lit("misc-7.parquet"))
        .otherwise(
            F.concat(
                F.lit("trips_"), century_later, F.lit("_"), F.col("l_linenumber").cast("string"),
                F.lit(".parquet"),
            )
        )
        .alias("file_name"),
    )


def orders_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_to_canonical(
        order_files(spark, sf_dir), F.col("source_period"), wall_clock=True
    )


def unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as batch months and events as the streamed month."""
    return union_all([orders_batch(spark, sf_dir), events_stream(spark, sf_dir)])


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trip_table(unified(spark, sf_dir), zones(spark, sf_dir))


def daily_period_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event trips with a day as their period, for splits and manifests."""
    stream = events_stream(spark, sf_dir, "day")
    return trip_table(stream, zones(spark, sf_dir), period_unit="day")


def event_id(df: DataFrame) -> DataFrame:
    """The event id, back from partition and offset."""
    return df.withColumn(
        "event_id", F.col("kafka_offset") * KEY_PARTITIONS + F.col("kafka_partition")
    )
