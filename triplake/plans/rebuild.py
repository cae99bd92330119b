"""Bring all tables up to date with changed sources, lookups and rules.

The state below a folder has the fingerprint of each source file, so that only
new and replaced files are read to see what changed, and for each stage and
period the fingerprint of what it was built from.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplake.functions.hashing import row_hash, set_fingerprint
from triplake.functions.timeparts import two_digits
from triplake.operators.manifest import (
    FILE_KEY,
    WHOLE,
    StageSpec,
    changed_files,
    file_fingerprints,
    fingerprints_of_files,
    parent_statuses,
    rebuild_plan,
    refreshed_files,
    stage_fingerprints,
)
from triplake.operators.metrics import (
    STATE_KEYS,
    metric_state,
    serving_table_from_state,
    serving_tables,
)
from triplake.plans import duration, serving
from triplake.plans.trips import RULES, gather_sources, trip_table
from triplake.sources.bronze import read_messages, read_months, union_all
from triplake.sources.folders import (
    delete,
    exists,
    latest_version,
    list_files,
    write_version,
)
from triplake.sources.tables import stored, write_periods
from triplake.sources.zones import read_zones

_FILES = (
    "source string, file string, size bigint, modified timestamp, period string, "
    "row_count bigint, hash_sum decimal(38,0)"
)
_STAGES = "stage string, period string, fingerprint string, has_output boolean"
_PLAN = "stage string, period string, status string, reason string"


def _saved(spark: SparkSession, root: str, schema: str) -> DataFrame:
    version = latest_version(spark, root)
    if version is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(version)


def source_listing(
    spark: SparkSession, batch_root: str | None, stream_root: str | None
) -> DataFrame:
    """The files of all sources, stored."""
    roots = {"batch": batch_root, "stream": stream_root}
    return stored(
        union_all([list_files(spark, root, name) for name, root in roots.items() if root]),
        "source-files",
    )


def changed_rows(
    spark: SparkSession,
    batch_root: str | None,
    stream_root: str | None,
    listing: DataFrame,
    known: DataFrame,
    wall_clock: bool = False,
) -> DataFrame | None:
    """Canonical rows, with their ``_file``, of listed files that are not known; no
    other file is opened. None when there is no such file."""
    roots = {"batch": batch_root, "stream": stream_root}
    month = _period_of_folders("year", "month")
    # A short line for each changed file; Spark's own listing has them all.
    changed = changed_files(listing, known).select("source", "file", month.alias("month")).collect()
    frames = []
    for name, root in roots.items():
        files = [r.file for r in changed if r.source == name]
        if not files:
            continue
        if name == "batch":
            months = {r.month for r in changed if r.source == name}
            rows = read_months(spark, root, months, wall_clock, files, "_file")
        else:
            rows = read_messages(spark, root, wall_clock, files, "_file")
        frames.append(rows)
    return union_all([frame for frame in frames if frame is not None])


def source_states(
    spark: SparkSession,
    batch_root: str | None,
    stream_root: str | None,
    known: DataFrame,
    wall_clock: bool = False,
) -> DataFrame:
    """State of every source file; only files without a known state are read."""
    listing = source_listing(spark, batch_root, stream_root)
    rows = changed_rows(spark, batch_root, stream_root, listing, known, wall_clock)
    if rows is None:
        fresh = spark.createDataFrame([], "file string, period string, row_count bigint, hash_sum decimal(38,0)")
    else:
        fresh = file_fingerprints(rows, "_file", "source_year_month")
    return stored(refreshed_files(known, listing, fresh), "file-states")


class Stage(NamedTuple):
    """How to tell, build and remove the outputs of a stage."""

    spec: StageSpec
    #: periods whose output exists
    outputs: Callable[[], set[str]]
    build: Callable[[list[str]], None]
    remove: Callable[[list[str]], None]


def run_stages(
    spark: SparkSession, sources: DataFrame, stages: Iterable[Stage], state: str
) -> DataFrame:
    """Build and remove what the plan of each stage names, parents first.

    Returns stage, period, status and reason. The state is written after each
    stage, so a run that fails goes on where it stopped. Periods are months, so
    they are few; they pass through the driver.
    """
    plans, desired, report = {}, {}, []
    for stage in stages:
        spec = stage.spec
        saved = [r for r in _saved(spark, state, _STAGES).collect()]
        own = [r for r in saved if r.stage == spec.name]
        inputs = sources if spec.parent is None else desired[spec.parent]
        wanted = stored(stage_fingerprints(inputs, spec), "stage-fingerprints")
        if spec.parent is None:
            parents = spark.createDataFrame([], "period string, parent_status string")
        else:
            parents = parent_statuses(plans[spec.parent], spec.whole)
        # A period that gave no rows has no output and is settled all the same.
        settled = {r.period for r in own if not r.has_output} | stage.outputs()
        plan = rebuild_plan(
            wanted,
            spark.createDataFrame([(r.period, r.fingerprint) for r in own], "period string, fingerprint string"),
            spark.createDataFrame([(p,) for p in sorted(settled)], "period string"),
            parents,
        ).collect()
        stage.build(sorted(r.period for r in plan if r.status == "rebuilt"))
        stage.remove(sorted(r.period for r in plan if r.status == "removed"))
        there = stage.outputs()
        for r in plan:
            empty = r.status == "rebuilt" and r.period not in there
            report.append((spec.name, r.period, r.status, "no usable rows" if empty else r.reason))
        now = [(spec.name, r.period, r.fingerprint, r.period in there) for r in wanted.collect()]
        others = [tuple(r) for r in saved if r.stage != spec.name]
        write_version(spark.createDataFrame(others + now, _STAGES).coalesce(1), state)
        desired[spec.name] = wanted
        plans[spec.name] = spark.createDataFrame(
            [(r.period, r.status) for r in plan], "period string, status string"
        )
    return spark.createDataFrame(report, _PLAN)


def table_periods(spark: SparkSession, path: str) -> set[str]:
    """Periods that a partitioned table has files for; only the listing is read."""
    files = list_files(spark, path, "table").select(_period_of_path().alias("period"))
    return {r.period for r in files.filter("period <> ''").distinct().collect()}


def _period_of_path():
    return _period_of_folders("pickup_year", "pickup_month")


def _period_of_folders(year: str, month: str):
    """The period that a file's folders name, or an empty text."""
    found = rf"/{year}=(\d{{4}})/{month}=(\d{{1,2}})/"
    period = F.concat_ws(
        "-", F.regexp_extract("file", found, 1),
        F.lpad(F.regexp_extract("file", found, 2), 2, "0"),
    )
    return F.when(F.col("file").rlike(found), period).otherwise("")


def remove_periods(spark: SparkSession, path: str, periods: Iterable[str]) -> None:
    """Delete folders of periods; the month may be written with one digit."""
    for period in periods:
        year, month = period.split("-")
        for name in {month, str(int(month))}:
            delete(spark, f"{path.rstrip('/')}/pickup_year={year}/pickup_month={name}")


def replace_periods(df: DataFrame, path: str, periods: list[str], **how) -> None:
    """Overwrite some periods of a table, also with nothing.

    An overwrite by period leaves periods alone that the rows do not have; their
    files are those that were there before, and go.
    """
    spark = df.sparkSession
    of_periods = _period_of_path().isin(periods)
    before = stored(list_files(spark, path, "table").filter(of_periods), "files-before")
    write_periods(df, path, "overwrite", **how)
    after = list_files(spark, path, "table").filter(of_periods)
    stale = after.join(before, list(FILE_KEY), "left_semi").select(_period_of_path().alias("period"))
    remove_periods(spark, path, [r.period for r in stale.distinct().collect()])


def trip_stage(
    spark: SparkSession, batch_root: str | None, stream_root: str | None, zone_file: str,
    target: str, rebalance: bool = False, wall_clock: bool = False,
) -> Stage:
    zones = read_zones(spark, zone_file)
    lookup = zones.agg(set_fingerprint(row_hash(zones)).alias("f")).first().f
    spec = StageSpec("trips", None, f"rules {RULES}, wall clock {wall_clock}, zones {lookup}")

    def build(periods: list[str]) -> None:
        if periods:
            rows = gather_sources(
                spark, batch_root, stream_root, set(periods), wall_clock, set(periods)
            )
            rows = rows.filter(F.col("source_year_month").isin(periods))
            replace_periods(trip_table(rows, zones), target, periods, rebalance=rebalance)

    return Stage(
        spec, lambda: table_periods(spark, target), build,
        lambda periods: remove_periods(spark, target, periods),
    )


def serving_stage(spark: SparkSession, trips_path: str, base: str) -> Stage:
    paths = {name: f"{base.rstrip('/')}/{name}" for name in serving_tables()}

    def outputs() -> set[str]:
        return set.intersection(*[table_periods(spark, path) for path in paths.values()])

    def build(periods: list[str]) -> None:
        if not periods:
            return
        if not table_periods(spark, trips_path):  # nothing to read a layout from
            return remove(periods)
        tables = serving.serving_of_periods(spark, trips_path, periods)
        for name, spec in serving_tables().items():
            replace_periods(tables[name], paths[name], periods, rebalance=True, order=spec.order)

    def remove(periods: list[str]) -> None:
        for path in paths.values():
            remove_periods(spark, path, periods)

    return Stage(StageSpec("serving", "trips", f"rules {serving.RULES}"), outputs, build, remove)


def _whole_stage(spark: SparkSession, spec: StageSpec, paths: list[str], build) -> Stage:
    def remove(periods: list[str]) -> None:
        for path in paths if periods else ():
            delete(spark, path)

    return Stage(
        spec,
        lambda: {WHOLE} if all(exists(spark, f"{p}/_SUCCESS") for p in paths) else set(),
        lambda periods: build() if periods else None,
        remove,
    )


def dataset_stage(
    spark: SparkSession, trips_path: str, base: str, test_period: str,
    train_fraction: float = duration.TRAIN_FRACTION,
    test_fraction: float = duration.TEST_FRACTION,
    seed: int = duration.SEED,
) -> Stage:
    settings = f"test {test_period}, shares {train_fraction} {test_fraction}, seed {seed}"
    return _whole_stage(
        spark, StageSpec("dataset", "trips", settings, whole=True),
        [f"{base}/train", f"{base}/test"],
        lambda: duration.build_dataset(
            spark, trips_path, base, test_period, train_fraction, test_fraction, seed
        ),
    )


def model_stage(
    spark: SparkSession, dataset_base: str, target: str, iterations: int = 250,
    seed: int = duration.SEED,
) -> Stage:
    return _whole_stage(
        spark, StageSpec("model", "dataset", f"iterations {iterations}, seed {seed}", whole=True),
        [f"{target}/metrics"],
        lambda: duration.train_encoded(spark, dataset_base, target, iterations, seed),
    )


def rebuild(
    spark: SparkSession,
    batch_root: str | None,
    stream_root: str | None,
    stages: list[Stage],
    manifest: str,
    wall_clock: bool = False,
) -> DataFrame:
    """Bring the outputs of all stages up to date; returns what was done.

    File states are saved last: after a failure files are looked at again, and
    stages that were built are not built again.
    """
    if batch_root is None and stream_root is None:
        raise ValueError("batch and stream cannot both be skipped")
    root = manifest.rstrip("/")
    known = _saved(spark, f"{root}/files", _FILES)
    states = source_states(spark, batch_root, stream_root, known, wall_clock)
    sources = stored(
        fingerprints_of_files(states).filter(F.col("period").isNotNull()), "source-fingerprints"
    )
    plan = run_stages(spark, sources, stages, f"{root}/stages")
    write_version(states.coalesce(1), f"{root}/files")
    return plan


def rebuild_trips(
    spark: SparkSession,
    batch_root: str | None,
    stream_root: str | None,
    zone_file: str,
    target: str,
    manifest: str,
    rebalance: bool = False,
    wall_clock: bool = False,
) -> DataFrame:
    """Only the trip table: period, status (``unchanged``, ``bootstrapped``,
    ``rebuilt`` or ``removed``) and reason."""
    stage = trip_stage(
        spark, batch_root, stream_root, zone_file, target, rebalance, wall_clock
    )
    plan = rebuild(spark, batch_root, stream_root, [stage], manifest, wall_clock)
    return plan.drop("stage")


def refresh_serving(
    spark: SparkSession,
    batch_root: str | None,
    stream_root: str | None,
    zone_file: str,
    base: str,
    state: str,
    wall_clock: bool = False,
) -> list[str]:
    """Bring the serving tables up to date from mergeable metrics of each file.

    The state has the metrics of every source file at the finest grain. Only new
    and replaced files are read, once; those of files that are gone or were
    replaced leave the state, and the periods that any of them has are rolled up
    again. Other rules or zones start the state anew. Returns these periods.
    """
    root = state.rstrip("/")
    zones = read_zones(spark, zone_file)
    lookup = zones.agg(set_fingerprint(row_hash(zones)).alias("f")).first().f
    rules = f"{RULES} {serving.RULES} {wall_clock} {lookup}"
    # Rows say by which rules they were made; those by others are not known.
    files = "source string, file string, size bigint, modified timestamp, rules string"
    every = _saved(spark, f"{root}/files", files)
    known = every.filter(F.col("rules") == rules)
    listing = source_listing(spark, batch_root, stream_root)
    # All other metrics leave, also those of a run that failed on the way.
    kept_files = stored(
        known.join(listing, list(FILE_KEY), "left_semi").select("file"), "kept-files"
    )
    is_kept = F.col("_file") == F.col("file")
    rows = changed_rows(spark, batch_root, stream_root, listing, known, wall_clock)
    fresh, before = None, None
    if rows is not None:
        trips = trip_table(rows, zones, beside=("_file",))
        fresh = stored(metric_state(trips, (*STATE_KEYS, "_file")), "fresh-metrics")
    if table_periods(spark, f"{root}/metrics"):
        before = spark.read.parquet(f"{root}/metrics")
    year_month = F.concat_ws(
        "-", F.col("pickup_year").cast("string"), two_digits(F.col("pickup_month"))
    )
    leaving = None if before is None else before.join(kept_files, is_kept, "left_anti")
    touched = union_all([
        frame.select(year_month.alias("period")) for frame in (fresh, leaving) if frame is not None
    ])
    # Months, so there are few.
    periods = [] if touched is None else sorted(r.period for r in touched.distinct().collect())
    if periods:
        parts = []
        if before is not None:
            own = before.filter(year_month.isin(periods))
            parts.append(own.join(kept_files, is_kept, "left_semi"))
        if fresh is not None:
            again = fresh.withColumn("pickup_month", F.col("pickup_month").cast("int"))
            parts.append(again)
        merged = stored(union_all(parts), "merged-metrics")
        replace_periods(merged, f"{root}/metrics", periods)
        for name, spec in serving_tables().items():
            replace_periods(
                serving_table_from_state(merged, name), f"{base.rstrip('/')}/{name}", periods,
                rebalance=True, order=spec.order,
            )
    write_version(listing.withColumn("rules", F.lit(rules)).coalesce(1), f"{root}/files")
    return periods
