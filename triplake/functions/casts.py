"""Casts that turn bad input into NULL while the session stays in ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def text_to_long(text: Column) -> Column:
    """``"7"`` and ``"7.0"`` both give 7; large ids do not pass through a double."""
    return F.coalesce(
        text.try_cast("bigint"), text.try_cast("double").try_cast("bigint")
    )


def text_to_double(text: Column) -> Column:
    """A NaN written as text counts as missing."""
    number = text.try_cast("double")
    return F.when(~F.isnan(number), number)


def to_kind(column: Column, have: T.DataType, kind: str, wall_clock: bool) -> Column:
    """Convert a column of type ``have`` to the kind named in a trip field.

    ``wall_clock`` keeps times without a zone; otherwise they are read in the
    session time zone.
    """
    is_text = isinstance(have, T.StringType)
    if kind == "string":
        return column.cast("string")
    if kind == "long":
        return text_to_long(column) if is_text else column.try_cast("bigint")
    if kind == "double":
        return column.try_cast("double")
    if kind == "time":
        return column.try_cast("timestamp_ntz" if wall_clock else "timestamp")
    raise ValueError(f"unknown kind: {kind}")


def nullable_int(column: Column) -> Column:
    """Key columns arrive as text, int or double; what is no number is NULL."""
    return text_to_long(column.cast("string")).try_cast("int")
