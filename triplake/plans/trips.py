"""Landed months and stored messages to the cleaned, enriched trip table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from triplake.operators.cleaning import keep_usable, with_calendar
from triplake.operators.enrich import with_zones
from triplake.schemas import TRIP_TABLE_COLUMNS
from triplake.sources.bronze import read_messages, read_months, union_all
from triplake.sources.folders import require_period
from triplake.sources.tables import write_periods
from triplake.sources.zones import read_zones

#: Raised when the rules below give other rows, so that stored periods are rebuilt.
RULES = "1"


def trip_table(
    canonical: DataFrame, zones: DataFrame, period_unit: str = "month", beside: tuple[str, ...] = ()
) -> DataFrame:
    """Canonical rows to the trip table: one narrow stage, no shuffle.

    Columns in ``beside`` are carried along behind it.
    """
    usable = with_calendar(keep_usable(canonical, period_unit=period_unit))
    return with_zones(usable, zones).select(*TRIP_TABLE_COLUMNS, *beside)


def gather_sources(
    spark: SparkSession,
    batch_root: str | None,
    stream_root: str | None,
    months: set[str] | None = None,
    wall_clock: bool = False,
    stream_months: set[str] | None = None,
) -> DataFrame:
    """Union of the sources that are given and present; ``months`` restricts the
    landed files, ``stream_months`` the stored messages."""
    if batch_root is None and stream_root is None:
        raise ValueError("batch and stream cannot both be skipped")
    for month in months or ():
        require_period(month)
    found = []
    if batch_root is not None:
        found.append(read_months(spark, batch_root, months, wall_clock))
    if stream_root is not None:
        found.append(read_messages(spark, stream_root, wall_clock, periods=stream_months))
    rows = union_all([frame for frame in found if frame is not None])
    if rows is None:
        raise FileNotFoundError("no batch month and no stored message was found")
    return rows


def build_trips(
    spark: SparkSession,
    batch_root: str | None,
    stream_root: str | None,
    zone_file: str,
    target: str,
    months: set[str] | None = None,
    mode: str = "overwrite",
    rebalance: bool = False,
    wall_clock: bool = False,
) -> None:
    """Write the trip table. Sources are laid out by month already, so by default
    rows are written where they are read."""
    canonical = gather_sources(spark, batch_root, stream_root, months, wall_clock)
    trips = trip_table(canonical, read_zones(spark, zone_file))
    write_periods(trips, target, mode, rebalance)
