"""Registered queries: each takes a session and a data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from triplake.functions.hashing import in_sample
from triplake.functions.timeparts import period_text
from triplake.operators import (
    canonical,
    cleaning,
    dashboard,
    encoding,
    enrich,
    features,
    manifest,
    metrics,
    models,
    quality,
    regression,
    scoring,
    trees,
)
from triplake.operators.manifest import StageSpec
from triplake.plans import serving
from triplake.session import new_scratch
from triplake.sources import bronze, folders, messages, tables
from triplake.streaming import audit, ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Shown month of the order data, split point of the event data, stream month.
YEAR, MONTH = 1998, 6
TEST_DAY = "2024-01-25"
STREAM_DAY = "2024-01-15"
STREAM_MONTH = "2024-01"
LANDING_STREAM_MONTH = "2021-08"
SEED = 42
BOOSTED_TREES, BOOSTED_STEP = 4, 0.5


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _plain_time(df: DataFrame) -> DataFrame:
    """Kafka times without a zone, for comparison outside Spark."""
    return df.withColumn("kafka_timestamp", F.col("kafka_timestamp").cast("timestamp_ntz"))


# ---------------------------------------------------------------- sources


@query
def canonicalize_batch(spark, sf):
    return _plain_time(fx.events_batch(spark, sf))


@query
def json_canonicalize(spark, sf):
    return _plain_time(fx.events_stream(spark, sf))


@query
def union_batch_months(spark, sf):
    """Three layouts of the order months: a double count, a renamed and a new fee."""
    rows = fx.order_files(spark, sf)
    early = rows.filter("tpep_pickup_datetime < timestamp_ntz'1997-01-01'").withColumn(
        "passenger_count", F.col("passenger_count").cast("double")
    )
    middle = rows.filter(
        "tpep_pickup_datetime >= timestamp_ntz'1997-01-01'"
        " AND tpep_pickup_datetime < timestamp_ntz'1999-01-01'"
    ).withColumn("airport_fee", F.col("extra"))
    late = rows.filter("tpep_pickup_datetime >= timestamp_ntz'1999-01-01'").withColumns(
        {"Airport_fee": F.col("extra"), "cbd_congestion_fee": F.col("tip_amount")}
    )
    frames = [
        canonical.batch_to_canonical(f, F.col("source_period"), wall_clock=True)
        for f in (early, middle, late)
    ]
    return _plain_time(bronze.union_all(frames))


@query
def unified_sources(spark, sf):
    return quality.row_counts(fx.unified(spark, sf), "ingestion_source", "source_year_month")


@query
def landing_manifest(spark, sf):
    return bronze.landing_manifest(fx.order_files(spark, sf), "file_name", LANDING_STREAM_MONTH)


@query
def zone_lookup(spark, sf):
    customers = fx.table(spark, sf, "customer")
    return enrich.zones_from_file_rows(
        customers.select(
            F.col("c_nationkey").cast("string").alias("LocationID"),
            F.col("c_mktsegment").alias("Borough"),
            F.col("c_name").alias("Zone"),
            F.substring("c_name", -1, 1).alias("service_zone"),
        )
    )


@query
def silver_month_slice(spark, sf):
    return _plain_time(tables.period_slice(fx.trips(spark, sf), YEAR, MONTH))


@query
def messages_roundtrip(spark, sf):
    rows = fx.event_files(spark, sf, "day").drop("event_id")
    sent = messages.to_messages(rows, "source_period").unionByName(
        messages.eof_messages(rows, "source_period")
    )
    text = F.col("value").cast("string")
    read = sent.select(
        F.col("key").cast("string").alias("year_month"),
        ingest.is_eof(text).alias("is_eof"),
        F.get_json_object(text, "$.rows_sent").cast("bigint").alias("rows_sent"),
        F.get_json_object(text, "$.tpep_pickup_datetime").cast("timestamp_ntz").alias("pickup"),
        F.get_json_object(text, "$.PULocationID").cast("bigint").alias("location"),
    )
    return read.groupBy("year_month").agg(
        F.count(F.lit(1)).alias("message_count"),
        F.count_if("is_eof").alias("eof_count"),
        F.max("rows_sent").alias("rows_sent"),
        F.max("pickup").alias("last_pickup"),
        F.sum("location").alias("location_sum"),
    )


# ---------------------------------------------------------------- streaming


PAYLOAD = (
    "VendorID bigint, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
    "passenger_count double, trip_distance double, RatecodeID bigint, store_and_fwd_flag string, "
    "PULocationID bigint, DOLocationID bigint, payment_type bigint, fare_amount double, "
    "extra double, tip_amount double, tolls_amount double, total_amount double, "
    "airport_fee double, rows_sent bigint"
)


def _with_payload(decoded: DataFrame) -> DataFrame:
    """Every field of the stored JSON in place of its text."""
    fields = F.from_json("raw_json", PAYLOAD).alias("payload")
    return _plain_time(decoded).select("*", fields).select("*", "payload.*").drop("raw_json", "payload")


@query
def stream_decode(spark, sf):
    return _with_payload(ingest.decode(fx.event_messages(spark, sf, "day")))


@query
def stream_accept(spark, sf):
    decoded = ingest.decode(fx.event_messages(spark, sf, "day"))
    return _with_payload(ingest.accept(decoded, STREAM_DAY))


@query
def stream_ingest(spark, sf):
    """A real streaming run over stored messages, then a run that adds nothing."""
    base = new_scratch(spark, "stream")
    fx.event_messages(spark, sf).write.parquet(f"{base}/messages")
    for _ in range(2):
        source = ingest.replay_source(spark, f"{base}/messages", max_files_per_trigger=4)
        run = ingest.start_ingest(
            source, STREAM_MONTH, f"{base}/bronze", f"{base}/checkpoint", until_done=True
        )
        run.awaitTermination()
    stored = spark.read.parquet(f"{base}/bronze")
    return stored.groupBy("year_month", "kafka_partition").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("kafka_offset").alias("min_offset"),
        F.max("kafka_offset").alias("max_offset"),
    )


@query
def offset_audit(spark, sf):
    return audit.offset_audit(fx.event_bronze(spark, sf))


@query
def offset_audit_replayed(spark, sf):
    """Messages without a payment type were lost, those of type 3 came twice."""
    payment = F.get_json_object("raw_json", "$.payment_type")
    stored = fx.event_bronze(spark, sf).filter(payment.isNotNull())
    return audit.offset_audit(stored.unionByName(stored.filter(payment == "3")))


@query
def stream_completion(spark, sf):
    """A run whose last batch was planned and not committed, as after a crash, and the
    run after it, both judged by their checkpoint."""
    base = new_scratch(spark, "completion")
    spread = fx.event_messages(spark, sf, "day").withColumn("key", F.lit(STREAM_MONTH).cast("binary"))
    spread.write.parquet(f"{base}/messages")
    sent = fx.table(spark, sf, "events").count()

    def run() -> None:
        source = ingest.replay_source(spark, f"{base}/messages", max_files_per_trigger=2)
        ingest.start_ingest(
            source, STREAM_MONTH, f"{base}/bronze", f"{base}/checkpoint", until_done=True
        ).awaitTermination()

    def state(step: str) -> DataFrame:
        progress = audit.replay_progress(spark, f"{base}/checkpoint")
        stored = audit.offset_audit(spark.read.parquet(f"{base}/bronze"))
        found = audit.completion(stored, sent, progress).select(F.lit(step).alias("step"), "*")
        return tables.stored(found, "completion-state")

    run()
    last = audit.replay_progress(spark, f"{base}/checkpoint").first().batch_id
    folders.delete(spark, f"{base}/checkpoint/commits/{last}")
    crashed = state("crashed")
    run()
    return crashed.union(state("restarted"))


# ---------------------------------------------------------------- trip table


@query
def clean_trips(spark, sf):
    return _plain_time(cleaning.keep_usable(fx.unified(spark, sf)))


@query
def time_features(spark, sf):
    rows = cleaning.with_calendar(cleaning.keep_usable(fx.events_stream(spark, sf)))
    return fx.event_id(rows).select(
        "event_id", "trip_duration_minutes", "pickup_date", "pickup_year", "pickup_month",
        "pickup_day", "pickup_hour", "pickup_day_of_week",
    )


@query
def enrich_pickup(spark, sf):
    joined = enrich.with_zone(fx.events_stream(spark, sf), fx.zones(spark, sf), "pickup")
    return fx.event_id(joined).select(
        "event_id", "pickup_location_id", "pickup_zone", "pickup_borough", "pickup_service_zone"
    )


@query
def enrich_zones(spark, sf):
    joined = enrich.with_zones(fx.events_stream(spark, sf), fx.zones(spark, sf))
    return fx.event_id(joined).select(
        "event_id",
        "pickup_location_id", "pickup_zone", "pickup_borough", "pickup_service_zone",
        "dropoff_location_id", "dropoff_zone", "dropoff_borough", "dropoff_service_zone",
    )


@query
def silver_full(spark, sf):
    return _plain_time(fx.trips(spark, sf))


# ---------------------------------------------------------------- serving tables


@query
def daily_summary(spark, sf):
    return metrics.serving_table(fx.trips(spark, sf), "daily_summary")


@query
def hourly_demand(spark, sf):
    return metrics.serving_table(fx.trips(spark, sf), "hourly_demand")


@query
def pickup_zone_monthly(spark, sf):
    return metrics.serving_table(fx.trips(spark, sf), "pickup_zone_monthly")


@query
def payment_monthly(spark, sf):
    return metrics.serving_table(fx.trips(spark, sf), "payment_monthly")


@query
def daily_summary_from_state(spark, sf):
    state = metrics.metric_state(fx.trips(spark, sf))
    return metrics.serving_table_from_state(state, "daily_summary")


# ---------------------------------------------------------------- quality


@query
def enrichment_nulls(spark, sf):
    return quality.enrichment_gaps(fx.trips(spark, sf))


@query
def rows_by_source(spark, sf):
    return quality.row_counts(fx.trips(spark, sf), "ingestion_source", "pickup_year")


@query
def rows_by_partition(spark, sf):
    return quality.rows_by_partition(fx.trips(spark, sf))


@query
def month_coverage(spark, sf):
    return quality.period_count(fx.trips(spark, sf))


@query
def clean_removed_pct(spark, sf):
    return quality.cleaning_loss(fx.unified(spark, sf), cleaning.usable())


def _trips_and_tables(spark, sf) -> tuple[DataFrame, dict[str, DataFrame]]:
    trips = tables.stored(fx.trips(spark, sf), "trips")
    return trips, {
        name: metrics.serving_table(trips, name) for name in metrics.serving_tables()
    }


@query
def gold_profile(spark, sf):
    """Of the tables as the jobs write and read them."""
    base = new_scratch(spark, "gold")
    tables.write_periods(fx.trips(spark, sf), f"{base}/trips", rebalance=True)
    serving.build_serving(spark, f"{base}/trips", f"{base}/serving")
    return quality.table_profile(serving.read_serving(spark, f"{base}/serving"))


@query
def gold_reconcile(spark, sf):
    return quality.reconcile(*_trips_and_tables(spark, sf))


@query
def gold_verdict(spark, sf):
    return quality.all_pass(quality.reconcile(*_trips_and_tables(spark, sf)))


# ---------------------------------------------------------------- manifests


@query
def period_manifest(spark, sf):
    rows = fx.order_files(spark, sf)
    return manifest.period_manifest(
        rows, "source_period", "tpep_pickup_datetime", "file_name"
    ).select("source_period", "row_count", "file_count", "min_time", "max_time")


@query
def fingerprint(spark, sf):
    """Over all columns of the files, in a form that SQL can repeat."""
    return manifest.fingerprints(fx.order_files(spark, sf), "source_period", portable=True)


@query
def fingerprint_typed(spark, sf):
    """Is the engine's own form the same for another layout, and does it see a
    change of one column, or of one value moved to another column?"""
    rows = tables.stored(fx.order_files(spark, sf), "order-rows")
    one = manifest.fingerprints(rows, "source_period")
    # As many even partitions as the rows need, with the lines of an order apart.
    laid_out = rows.hint("rebalance", "l_orderkey", "RatecodeID")

    def against(other: DataFrame, name: str) -> DataFrame:
        found = manifest.fingerprints(other, "source_period")
        return found.select("source_period", F.col("fingerprint").alias(name))

    moved = rows.withColumns({"extra": F.lit(None).cast("double"), "tip_amount": F.col("extra")})
    return (
        one.join(against(laid_out, "again"), "source_period")
        .join(against(rows.withColumn("extra", F.col("extra") + 0.01), "changed"), "source_period")
        .join(against(moved, "moved"), "source_period")
        .select(
            "source_period", "row_count",
            (F.col("again") == F.col("fingerprint")).alias("same_for_other_layout"),
            (F.col("changed") != F.col("fingerprint")).alias("sees_a_change"),
            (F.col("moved") != F.col("fingerprint")).alias("sees_a_moved_value"),
        )
    )


@query
def rebuild_plan(spark, sf):
    """Early days changed where they had an error event; late days are new."""
    events = fx.table(spark, sf, "events")
    rows = events.select(
        period_text(F.col("ts"), "day").alias("period"),
        F.dayofmonth("ts").alias("day"),
        F.dayofweek("ts").alias("weekday"),
        *events.columns,
    )
    whole = ("period", *events.columns)
    current = manifest.fingerprints(rows.select(*whole), "period", portable=True)
    known = rows.filter("day <= 24 AND (day > 10 OR event_type != 'error')")
    saved = manifest.fingerprints(known.select(*whole), "period", portable=True)
    outputs = rows.filter("day >= 4 AND weekday != 2").select("period").distinct()
    parents = rows.select(
        "period",
        F.when(F.col("weekday") <= 3, "rebuilt").otherwise("unchanged").alias("parent_status"),
    ).distinct()
    return manifest.rebuild_plan(current, saved, outputs, parents)


@query
def fingerprint_incremental(spark, sf):
    """Fingerprints from the states of files, of which one group was replaced, one
    removed and one added since the states were first taken."""
    rows = fx.order_files(spark, sf)
    base = new_scratch(spark, "order-files")
    root, later = f"{base}/given=now", f"{base}/given=later"

    def part_rows(folder: str, part: int) -> DataFrame:
        return spark.read.schema(rows.schema).parquet(f"{folder}/part={part}")

    def states(known: DataFrame) -> DataFrame:
        listing = tables.stored(folders.list_files(spark, root, "orders"), "order-listing")
        changed = [r.file for r in manifest.changed_files(listing, known).collect()]
        path = F.col("_metadata.file_path")
        found = spark.read.schema(rows.schema).parquet(root).filter(path.isin(changed))
        fresh = manifest.file_fingerprints(
            found.withColumn("_file", path).drop("part"), "_file", "source_period", portable=True
        )
        return tables.stored(manifest.refreshed_files(known, listing, fresh), "order-states")

    # The rows are made once; what changes later is written from the files.
    late = F.col("RatecodeID") == 6
    group = F.col("RatecodeID") % 3
    rows.filter(late | group.isin(0, 1, 2)).withColumns({
        "given": F.when(late, "later").otherwise("now"), "part": F.when(late, 9).otherwise(group),
    }).write.partitionBy("given", "part").parquet(base)
    known = states(spark.createDataFrame(
        [], "source string, file string, size bigint, modified timestamp, period string, "
        "row_count bigint, hash_sum decimal(38,0)",
    ))
    part_rows(root, 1).withColumn("extra", F.col("extra") + 0.01).write.parquet(f"{root}/part=4")
    for part in (1, 2):
        folders.delete(spark, f"{root}/part={part}")
    part_rows(later, 9).write.parquet(f"{root}/part=9")
    return manifest.fingerprints_of_files(states(known)).withColumnRenamed(
        "period", "source_period"
    )


@query
def rebuild_cascade(spark, sf):
    """Trips by day, serving tables by day and one model, of which the last run had
    other early days, and for Sundays other rules of the serving tables. A day of
    which events are no longer there was built then, too."""
    events = fx.table(spark, sf, "events")
    rows = events.select(
        period_text(F.col("ts"), "day").alias("period"), F.dayofmonth("ts").alias("day"),
        F.dayofweek("ts").alias("weekday"), *events.columns,
    )
    whole = ("period", *events.columns)
    trips, tables_, model = (
        StageSpec("trips", None, "rules 1"), StageSpec("serving", "trips", "rules 2"),
        StageSpec("model", "serving", "seed 42", whole=True),
    )
    sources = manifest.fingerprints(rows.select(*whole), "period", portable=True)
    known = rows.filter("day <= 24 AND (day > 10 OR event_type != 'error')")
    days = rows.groupBy("period").agg(F.first("day").alias("day"), F.first("weekday").alias("weekday"))
    sunday = days.filter("weekday = 1").select("period")
    before = manifest.stage_fingerprints(
        manifest.fingerprints(known.select(*whole), "period", portable=True), trips
    )
    served = manifest.stage_fingerprints(before, tables_).join(sunday, "period", "left_anti")
    older = manifest.stage_fingerprints(before, tables_._replace(settings="rules 1")).join(
        sunday, "period", "left_semi"
    )
    gone = spark.createDataFrame([("1999-01-01", "0")], "period string, fingerprint string")
    saved = (
        before.union(gone).select(F.lit("trips").alias("stage"), "*")
        .union(served.union(older).union(gone).select(F.lit("serving").alias("stage"), "*"))
    )
    outputs = (
        days.filter("day >= 4 AND weekday != 2").select(F.lit("trips").alias("stage"), "period")
        .union(days.filter("day >= 3").select(F.lit("serving").alias("stage"), "period"))
        .union(gone.select(F.lit("serving").alias("stage"), "period"))
    )
    return manifest.cascade(sources, [trips, tables_, model], saved, outputs)


# ---------------------------------------------------------------- dashboard


def _daily(spark, sf) -> DataFrame:
    return metrics.serving_table(fx.trips(spark, sf), "daily_summary")


def _zone_month(spark, sf) -> DataFrame:
    month = tables.period_slice(fx.trips(spark, sf), YEAR, MONTH)
    return metrics.serving_table(month, "pickup_zone_monthly")


@query
def overview_kpis(spark, sf):
    kpis = dashboard.overview(_daily(spark, sf), "1996-01-01", "2000-12-31")
    return kpis.select("total_trips", *[
        F.round(c, 6).alias(c) for c in kpis.columns if c != "total_trips"
    ])


@query
def date_range(spark, sf):
    return dashboard.date_bounds(_daily(spark, sf))


@query
def daily_trend(spark, sf):
    return dashboard.daily_trend(_daily(spark, sf), "1996-01-01", "2000-12-31")


@query
def hourly_curve(spark, sf):
    hourly = metrics.serving_table(fx.trips(spark, sf), "hourly_demand")
    return dashboard.hourly_curve(dashboard.month_of(hourly, 2024, 1))


@query
def demand_heatmap(spark, sf):
    hourly = metrics.serving_table(fx.trips(spark, sf), "hourly_demand")
    return dashboard.weekday_by_hour(dashboard.month_of(hourly, 2024, 1))


@query
def zone_month_rollup(spark, sf):
    table = metrics.serving_table(fx.trips(spark, sf), "pickup_zone_monthly")
    totals = dashboard.zone_totals(dashboard.with_integer_keys(table))
    return totals.select(
        "pickup_location_id", "pickup_zone", "pickup_borough", "trip_count",
        *[F.round(c, 6).alias(c) for c in dashboard.ZONE_METRICS if c != "trip_count"],
    )


@query
def zone_map(spark, sf):
    totals = dashboard.zone_totals(_zone_month(spark, sf))
    return dashboard.zone_map(fx.zones(spark, sf), totals, "trip_count").select(
        "location_id", "zone", "borough", "trip_count", "total_revenue"
    )


@query
def top_zones(spark, sf):
    return dashboard.top_zones(dashboard.zone_totals(_zone_month(spark, sf)), "total_revenue")


@query
def available_periods(spark, sf):
    return dashboard.available_periods(
        metrics.serving_table(fx.trips(spark, sf), "payment_monthly")
    )


@query
def coerce_keys(spark, sf):
    """Keys that come as text, some of them no numbers."""
    documents = fx.table(spark, sf, "documents")
    odd = documents.select(
        "doc_id",
        F.when(F.col("doc_id") % 3 == 0, F.col("source"))
        .otherwise((2000 + F.col("doc_id") % 30).cast("string"))
        .alias("pickup_year"),
        F.concat((1 + F.col("doc_id") % 12).cast("string"), F.lit(".0")).alias("pickup_month"),
        F.when(F.col("doc_id") % 4 != 0, (F.col("doc_id") % 265).cast("double")).alias(
            "pickup_location_id"
        ),
    )
    return dashboard.with_integer_keys(odd)


# ---------------------------------------------------------------- model data


def _features(spark, sf) -> DataFrame:
    rows = fx.event_id(fx.daily_period_trips(spark, sf))
    return features.duration_features(rows, keep=("event_id",))


def _rounded(df: DataFrame) -> DataFrame:
    waves = [c for c in df.columns if c.endswith(("_sin", "_cos"))]
    return df.withColumns({c: F.round(c, 9) for c in waves})


@query
def ml_clean(spark, sf):
    rows = features.model_rows(fx.event_id(fx.daily_period_trips(spark, sf)))
    return rows.select(
        "event_id", "trip_duration_minutes", "trip_distance", "passenger_count",
        "pickup_location_id", "dropoff_location_id", "rate_code_id", "pickup_hour",
        "pickup_month",
    )


@query
def ml_features(spark, sf):
    return _rounded(_features(spark, sf))


@query
def cyclic_features(spark, sf):
    months = fx.order_files(spark, sf).select(
        F.hour("tpep_dropoff_datetime").alias("dropoff_hour"),
        F.month("tpep_pickup_datetime").alias("pickup_month"),
        F.dayofmonth("tpep_pickup_datetime").alias("day"),
        F.dayofweek("tpep_pickup_datetime").alias("pickup_day_of_week_num"),
    )
    # Order dates carry no hour; the day of the month stands in for one.
    keyed = months.select(
        (F.col("day") % 24).alias("pickup_hour"), "pickup_month", "pickup_day_of_week_num"
    )
    return _rounded(features.with_engineered(keyed.distinct()))


@query
def temporal_split(spark, sf):
    train, test = features.split_by_period(_features(spark, sf), TEST_DAY)
    parts = train.select(F.lit("train").alias("part"), "event_id", "label").unionByName(
        test.select(F.lit("test").alias("part"), "event_id", "label")
    )
    return parts


@query
def sample_hash(spark, sf):
    events = fx.table(spark, sf, "events").select("event_id", "event_type")
    return features.keyed_sample(events, "event_id", 0.05, SEED)


@query
def sample_independence(spark, sf):
    """Samples of two seeds, and folds inside a sample, do not depend on each other."""
    events = fx.table(spark, sf, "events").select("event_id")
    folded = encoding.with_fold(events, "event_id", 5, SEED)
    first = in_sample(F.col("event_id"), 0.5, SEED)
    second = in_sample(F.col("event_id"), 0.5, SEED + 1)
    return folded.groupBy("fold").agg(
        F.count_if(first).alias("in_first"), F.count_if(second).alias("in_second"),
        F.count_if(first & second).alias("in_both"),
    )


@query
def sample_bernoulli(spark, sf):
    """A random share of the rows, near what was asked for; rows are whole."""
    rows = _features(spark, sf)
    share = rows.count() * 0.05
    kept = features.bernoulli_sample(rows, 0.05, SEED)
    return kept.agg(
        F.count(F.lit(1)).between(share - 6 * share**0.5, share + 6 * share**0.5).alias("near"),
        (F.count_distinct("event_id") == F.count(F.lit(1))).alias("each_once"),
    )


@query
def label_stats(spark, sf):
    stats = features.label_stats(_features(spark, sf), exact_median=True)
    return stats.withColumn("avg_duration", F.round("avg_duration", 6))


@query
def categorical_strings(spark, sf):
    return encoding.with_category_text(_features(spark, sf)).select(
        "event_id", *models.TEXTS
    )


@query
def string_index(spark, sf):
    texts = encoding.with_category_text(_features(spark, sf))
    return models.category_indexer().fit(texts).transform(texts).select(
        "event_id", *models.INDEXES
    )


@query
def one_hot_width(spark, sf):
    """Length of each one-hot vector and the slot that is set, per feature and category."""
    texts = encoding.with_category_text(_features(spark, sf))
    indexed = models.category_indexer().fit(texts).transform(texts)
    encoded = models.one_hot().fit(indexed).transform(indexed)
    cells = F.array(*[
        F.struct(
            F.lit(name).alias("feature"), F.col(f"{name}_cat").alias("category"),
            vector_to_array(f"{name}_ohe").alias("slots"),
        )
        for name in features.CATEGORICAL
    ])
    slots = encoded.select(F.explode(cells).alias("c")).select("c.*").distinct()
    return slots.select(
        "feature", "category",
        F.size("slots").alias("width"),
        (F.array_position("slots", 1.0) - 1).cast("int").alias("slot"),
    )


@query
def target_encode_oof(spark, sf):
    folded = encoding.with_fold(_features(spark, sf), "event_id", 5, SEED)
    encoded = encoding.encode(folded, encoding.encoding_table(folded), out_of_fold=True)
    return encoded.select(
        "event_id", "fold", *[F.round(c, 6).alias(c) for c in models.ENCODED]
    )


@query
def target_encode_test(spark, sf):
    train, test = features.split_by_period(_features(spark, sf), TEST_DAY)
    encoded = encoding.encode(test, encoding.encoding_table(train))
    return encoded.select("event_id", *[F.round(c, 6).alias(c) for c in models.ENCODED])


# ---------------------------------------------------------------- models


@query
def mean_baseline(spark, sf):
    train, test = features.split_by_period(_features(spark, sf), TEST_DAY)
    predicted = regression.predict_mean(train, test)
    return predicted.select("event_id", "label", F.round("prediction", 6).alias("prediction"))


def _simple_predictions(spark, sf) -> DataFrame:
    """Three plain predictors of the fare, one row per predictor and trip."""
    rows = fx.daily_period_trips(spark, sf)
    mean_fare = rows.agg(F.avg("fare_amount")).scalar()
    return rows.withColumn("mean_fare", mean_fare).select(
        F.col("fare_amount").alias("label"),
        F.expr(
            "stack(3, 'by_distance', 20.0D + 2.0D * coalesce(trip_distance, 0.0D),"
            " 'by_duration', 1.0D + 0.9D * trip_duration_minutes,"
            " 'mean_baseline', mean_fare) as (model, prediction)"
        ),
    )


def _scores(spark, sf) -> DataFrame:
    scores = regression.regression_metrics(_simple_predictions(spark, sf), "model")
    return scores.select("model", *[F.round(c, 6).alias(c) for c in ("mae", "rmse", "r2")])


@query
def regression_metrics(spark, sf):
    return regression.ranked_models(_scores(spark, sf))


@query
def best_model(spark, sf):
    return regression.best_model(_scores(spark, sf))


def _fares(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Model rows whose label follows distance and duration, so that models can learn.

    They are stored, since models read them several times."""
    rows = _features(spark, sf).withColumn(
        "label", 3.0 + 2.5 * F.col("trip_distance") + 0.2 * F.col("pickup_hour")
    )
    return features.split_by_period(tables.stored(rows, "fare-rows"), TEST_DAY)


@query
def model_comparison(spark, sf):
    """Every model, and whether it is better than the mean where there is a signal."""
    scores = models.compare_models(
        *_fares(spark, sf), models.chosen_models("linear,rf,gbt")
    ).scores
    base = scores.filter(F.col("model") == regression.BASELINE).agg(F.max("rmse")).scalar()
    return scores.select(
        "model", (F.col("rmse") < base).alias("beats_the_mean"),
        (F.col("mae") <= F.col("rmse")).alias("errors_in_order"),
    )


@query
def linear_fit(spark, sf):
    """Least squares with one input, held against the closed form."""
    train, _ = features.split_by_period(_features(spark, sf), TEST_DAY)
    rows = VectorAssembler(inputCols=["trip_distance"], outputCol="features").transform(train)
    fitted = LinearRegression(labelCol="label", regParam=0.0, solver="normal").fit(rows)
    return spark.range(1).select(
        F.round(F.lit(float(fitted.coefficients[0])), 6).alias("slope"),
        F.round(F.lit(float(fitted.intercept)), 6).alias("intercept"),
    )


@query
def encoded_boosting(spark, sf):
    """Every test row is predicted, better than the mean, by more than a few trees."""
    train, test = _fares(spark, sf)
    fitted = models.fit_encoded_boosting(train, "event_id", iterations=40)
    predicted = models.predict_encoded(fitted, test)
    base = regression.regression_metrics(regression.predict_mean(train, test))
    return predicted.agg(
        F.count("prediction").alias("predicted"),
        (F.sqrt(F.avg((F.col("prediction") - F.col("label")) ** 2)) < base.select("rmse").scalar())
        .alias("beats_the_mean"),
        F.lit(fitted.trees > 2).alias("has_trees"),
    )


def _small_model(train: DataFrame, regressor) -> PipelineModel:
    """Trees on two inputs whose splits SQL can find again."""
    assembler = VectorAssembler(inputCols=["trip_distance", "pickup_hour"], outputCol="features")
    return Pipeline(stages=[assembler, regressor]).fit(train)


def _small_boosting(train: DataFrame) -> PipelineModel:
    return _small_model(train, GBTRegressor(
        labelCol="label", maxIter=BOOSTED_TREES, maxDepth=1, maxBins=300, stepSize=BOOSTED_STEP,
        seed=SEED,
    ))


def _by_both(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Predictions of a model's SQL form, and whether the model itself gives them."""
    both = model.transform(rows).withColumn("by_sql", F.expr(trees.ensemble_sql(model)))
    return both.select(
        "event_id", F.round("by_sql", 6).alias("prediction"),
        (F.abs(F.col("by_sql") - F.col("prediction")) < 1e-9).alias("as_the_model"),
    )


@query
def boosted_values(spark, sf):
    train, test = _fares(spark, sf)
    return _by_both(_small_boosting(train), test)


@query
def forest_values(spark, sf):
    train, test = _fares(spark, sf)
    return _by_both(_small_model(train, RandomForestRegressor(
        labelCol="label", numTrees=3, maxDepth=2, maxBins=300, bootstrap=False,
        featureSubsetStrategy="all", seed=SEED,
    )), test)


def _planned(spark, sf) -> DataFrame:
    planned = fx.event_files(spark, sf, "day").select(
        "event_id",
        F.col("PULocationID").alias("pickup_location_id"),
        F.col("DOLocationID").alias("dropoff_location_id"),
        F.col("passenger_count").cast("bigint").alias("passenger_count"),
        F.col("trip_distance").alias("estimated_trip_distance"),
        F.col("RatecodeID").alias("rate_code_id"),
        F.col("tpep_pickup_datetime").alias("pickup_datetime"),
    )
    return scoring.inputs_from_pickup_time(planned)


@query
def score_input_validity(spark, sf):
    return scoring.with_validity(_planned(spark, sf)).select("event_id", "valid", "failed_rule")


@query
def score_features(spark, sf):
    valid = scoring.with_validity(_planned(spark, sf)).filter("valid")
    return _rounded(scoring.scoring_features(valid)).select(
        "event_id", *[c for c in features.DATASET_COLUMNS if c != features.LABEL]
    )


@query
def batch_score(spark, sf):
    train, _ = _fares(spark, sf)
    return scoring.score_trips(_small_boosting(train), _planned(spark, sf)).select(
        "event_id", "valid", "failed_rule", F.round("prediction", 6).alias("prediction")
    )
