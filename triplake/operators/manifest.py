"""Per-period manifests and the decision what to rebuild."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triplake.functions.hashing import portable_row_hash, row_hash, set_fingerprint

#: What identifies the content of a file without reading it.
FILE_KEY = ("source", "file", "size", "modified")
#: The period of stages that are built as a whole.
WHOLE = "*"


def period_manifest(
    df: DataFrame, period: str, moment: str, file_name: str | None = None
) -> DataFrame:
    """Rows, files and time range of each period.

    ``file_name`` names a column with the file of each row, for instance
    ``_metadata.file_name`` of a scan. Files are counted by grouping twice, so
    both steps are aggregated before the shuffle.
    """
    measures = [
        F.count(F.lit(1)).alias("n"),
        F.min(moment).alias("min_time"),
        F.max(moment).alias("max_time"),
    ]
    if file_name is None:
        return df.groupBy(period).agg(*measures).withColumnRenamed("n", "row_count")
    per_file = df.groupBy(period, file_name).agg(*measures)
    return per_file.groupBy(period).agg(
        F.sum("n").alias("row_count"),
        F.count(F.lit(1)).alias("file_count"),
        F.min("min_time").alias("min_time"),
        F.max("max_time").alias("max_time"),
    )


def fingerprints(df: DataFrame, period: str, portable: bool = False) -> DataFrame:
    """Content fingerprint per period, independent of row order and files.

    The portable form can be recomputed by another engine; the default hashes
    typed values and is faster.
    """
    hashes = portable_row_hash(df) if portable else row_hash(df)
    return df.select(period, hashes.alias("_hash")).groupBy(period).agg(
        F.count(F.lit(1)).alias("row_count"),
        set_fingerprint(F.col("_hash")).alias("fingerprint"),
    )


def file_fingerprints(
    rows: DataFrame, file: str, period: str, portable: bool = False
) -> DataFrame:
    """file, period, ``row_count`` and ``hash_sum`` of rows that name their file.

    Sums of row hashes add up: those of a period's files are the period's own.
    """
    content = rows.drop(file)
    hashes = portable_row_hash(content) if portable else row_hash(content)
    return (
        rows.select(F.col(file).alias("file"), F.col(period).alias("period"), hashes.alias("_hash"))
        .groupBy("file", "period")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.sum(F.col("_hash").cast("decimal(20,0)")).cast("decimal(38,0)").alias("hash_sum"),
        )
    )


def changed_files(listing: DataFrame, known: DataFrame) -> DataFrame:
    """Listed files without a known state: new ones, and such as were replaced."""
    return listing.join(known.select(*FILE_KEY).distinct(), list(FILE_KEY), "left_anti")


def refreshed_files(known: DataFrame, listing: DataFrame, fresh: DataFrame) -> DataFrame:
    """States of the listed files: those known, and ``fresh`` ones of changed files.

    Files that are gone are forgotten. A file without rows has a state without
    period, so that it is not read again.
    """
    kept = known.join(listing, list(FILE_KEY), "left_semi")
    added = changed_files(listing, known).join(fresh, "file", "left").select(
        *FILE_KEY, "period", F.coalesce("row_count", F.lit(0)).alias("row_count"), "hash_sum"
    )
    return kept.select(*added.columns).union(added)


def fingerprints_of_files(states: DataFrame) -> DataFrame:
    """Fingerprint of each period from the states of its files."""
    return states.filter("row_count > 0").groupBy("period").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("hash_sum").cast("string").alias("fingerprint"),
    )


def rebuild_plan(
    current: DataFrame, saved: DataFrame, outputs: DataFrame, parents: DataFrame
) -> DataFrame:
    """What to do with the output of each period.

    Inputs are keyed by ``period``: ``current`` and ``saved`` carry
    ``fingerprint``, ``outputs`` lists periods whose output exists, ``parents``
    carries ``parent_status``. An output is ``removed`` when its period has no
    input any more, ``unchanged`` when it exists and its saved fingerprint is the
    current one, and ``bootstrapped`` (adopted as it is) when none was saved and
    the parent was not rebuilt; otherwise it must be ``rebuilt``.
    """
    desired = current.select("period", F.col("fingerprint").alias("desired"))
    previous = saved.select("period", F.col("fingerprint").alias("previous"))
    present = outputs.select("period", F.lit(True).alias("present"))
    joined = (
        desired.join(previous, "period", "full_outer")
        .join(present, "period", "full_outer")
        .join(parents.select("period", "parent_status"), "period", "left")
    )
    exists = F.coalesce(F.col("present"), F.lit(False))
    parent_rebuilt = F.coalesce(F.col("parent_status") == "rebuilt", F.lit(False))
    same = F.coalesce(F.col("previous") == F.col("desired"), F.lit(False))
    status = (
        F.when(F.col("desired").isNull(), "removed")
        .when(exists & same, "unchanged")
        .when(exists & F.col("previous").isNull() & ~parent_rebuilt, "bootstrapped")
        .otherwise("rebuilt")
    )
    reason = (
        F.when(status == "removed", "no input")
        .when(status != "rebuilt", F.lit(None))
        .when(~exists, "output missing")
        .when(parent_rebuilt, "parent rebuilt")
        .otherwise("input changed")
    )
    return joined.select("period", status.alias("status"), reason.alias("reason"))


class StageSpec(NamedTuple):
    """A stage: what it is made from, and a text that stands for its rules,
    lookups and options. A ``whole`` stage has one output for all periods."""

    name: str
    parent: str | None
    settings: str
    whole: bool = False


def stage_fingerprints(parent: DataFrame, stage: StageSpec) -> DataFrame:
    """What a stage's output should be made from: its parent's periods and its
    settings. ``parent`` has period and fingerprint of the parent, or of the
    sources."""

    def combined(inputs: Column) -> Column:
        return F.sha2(F.concat_ws("\n", F.lit(stage.name), inputs, F.lit(stage.settings)), 256)

    if not stage.whole:
        return parent.select("period", combined(F.col("fingerprint")).alias("fingerprint"))
    each = F.concat_ws("=", "period", "fingerprint")
    # One short text for each period.
    listed = F.array_join(F.array_sort(F.collect_list(each)), ",")
    return (
        parent.agg(F.count(F.lit(1)).alias("n"), listed.alias("inputs")).filter("n > 0")
        .select(F.lit(WHOLE).alias("period"), combined(F.col("inputs")).alias("fingerprint"))
    )


def parent_statuses(plan: DataFrame, whole: bool) -> DataFrame:
    """period and ``parent_status`` for the next stage, from its parent's plan. A
    whole stage's parent counts as rebuilt when any period was built or removed."""
    if not whole:
        return plan.select("period", F.col("status").alias("parent_status"))
    touched = F.coalesce(F.bool_or(F.col("status").isin("rebuilt", "removed")), F.lit(False))
    return plan.agg(touched.alias("touched")).select(
        F.lit(WHOLE).alias("period"),
        F.when(F.col("touched"), "rebuilt").otherwise("unchanged").alias("parent_status"),
    )


def cascade(
    sources: DataFrame, stages: Sequence[StageSpec], saved: DataFrame, outputs: DataFrame
) -> DataFrame:
    """stage, period, status and reason for every stage, parents before children.

    ``sources`` has period and fingerprint; ``saved`` has stage, period and
    fingerprint of what was built, ``outputs`` stage and period of what exists. A
    change of a period's sources, or of a stage's settings, changes the
    fingerprints of all that follows.
    """
    plans, desired, result = {}, {}, None
    for stage in stages:
        inputs = sources if stage.parent is None else desired[stage.parent]
        wanted = stage_fingerprints(inputs, stage)
        if stage.parent is None:
            parents = wanted.select("period", F.lit(None).cast("string").alias("parent_status"))
        else:
            parents = parent_statuses(plans[stage.parent], stage.whole)
        own = F.col("stage") == stage.name
        plan = rebuild_plan(wanted, saved.filter(own), outputs.filter(own), parents)
        desired[stage.name], plans[stage.name] = wanted, plan
        named = plan.select(F.lit(stage.name).alias("stage"), "period", "status", "reason")
        result = named if result is None else result.union(named)
    return result
