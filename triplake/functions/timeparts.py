"""Calendar parts of a pickup time.

Everything here gives the same answer for a zone-aware and a wall-clock
timestamp of the same local time, except elapsed seconds: those follow the real
clock for the first and the dial for the second.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Weekday names, Sunday first.
DAY_NAMES = (
    "Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday",
)

PERIOD_WIDTH = {"month": 7, "day": 10}


def is_wall_clock(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.TimestampNTZType)


def period_text(moment: Column, unit: str = "month") -> Column:
    """``2025-12`` (month) or ``2025-12-31`` (day)."""
    # A date prints as ISO text, which is cheaper than a pattern formatter.
    return F.substring(moment.cast("date").cast("string"), 1, PERIOD_WIDTH[unit])


def epoch_seconds(moment: Column, wall_clock: bool) -> Column:
    """Whole seconds; fractions are cut, not rounded."""
    if not wall_clock:
        return F.unix_seconds(moment)
    # Built from fields, so no session time zone can shift a wall-clock time.
    days = F.datediff(moment.cast("date"), F.lit("1970-01-01").cast("date"))
    return (
        days.cast("bigint") * 86400
        + F.hour(moment) * 3600
        + F.minute(moment) * 60
        + F.second(moment)
    )


def elapsed_minutes(start: Column, end: Column, wall_clock: bool) -> Column:
    seconds = epoch_seconds(end, wall_clock) - epoch_seconds(start, wall_clock)
    return seconds / F.lit(60.0)


def day_name(moment: Column) -> Column:
    names = F.array(*[F.lit(name) for name in DAY_NAMES])
    return F.element_at(names, F.dayofweek(moment.cast("date")))


def day_number_from_sunday(name: Column) -> Column:
    """Sunday 1 to Saturday 7; NULL for anything else."""
    return _position(name, DAY_NAMES)


def day_number_from_monday(name: Column) -> Column:
    """Monday 1 to Sunday 7; NULL for anything else."""
    return _position(name, DAY_NAMES[1:] + DAY_NAMES[:1])


def _position(name: Column, ordered: tuple[str, ...]) -> Column:
    found = F.array_position(F.array(*[F.lit(n) for n in ordered]), name)
    return F.when(found > 0, found.cast("int"))


def two_digits(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")
