"""Order-free content fingerprints and repeatable sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Buckets a key can fall into; a share is resolved to a millionth.
HASH_BUCKETS = 1_000_000


def key_bucket(key: Column, seed: int, purpose: str = "sample") -> Column:
    """Bucket of a key; any SQL engine can repeat it.

    Purpose and seed are part of the hashed text, so buckets of two purposes, or
    of two seeds, have nothing to do with each other.
    """
    text = F.concat_ws("|", F.lit(purpose), F.lit(str(seed)), key.cast("string"))
    return F.pmod(_number(F.md5(text)), F.lit(HASH_BUCKETS))


def in_sample(key: Column, fraction: float, seed: int) -> Column:
    if not 0 < fraction <= 1:
        raise ValueError("fraction must be in (0, 1]")
    return key_bucket(key, seed) < F.lit(int(round(fraction * HASH_BUCKETS)))


def _number(hex_digest: Column) -> Column:
    """The first 60 bits of a hexadecimal digest."""
    return F.conv(F.substring(hex_digest, 1, 15), 16, 10).cast("bigint")


def row_hash(df: DataFrame) -> Column:
    """64-bit hash over all columns, in name order, for use inside the engine.

    The hash function skips NULL, so which columns are NULL is hashed as well.
    """
    names = sorted(df.columns)
    nulls = F.concat_ws("", *[F.when(F.col(n).isNull(), "1").otherwise("0") for n in names])
    return F.xxhash64(nulls, *[F.col(n) for n in names])


def portable_row_hash(df: DataFrame) -> Column:
    """60-bit hash of a canonical text form, which other engines can recompute.

    Each column gives its name, the length of its text and the text, so that no
    text can pass for another column's; NULL gives a mark that no text has.
    """
    parts = []
    for name in sorted(df.columns):
        text = _canonical_text(df, name)
        named = F.concat(F.lit(f"{name}="), F.length(text).cast("string"), F.lit(":"), text)
        parts.append(F.coalesce(named, F.lit(f"{name}~")))
    return _number(F.md5(F.concat_ws("|", *parts)))


def _canonical_text(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    column = F.col(name)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return _double_text(column.cast("double"))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return column.cast("string")


def _double_text(value: Column) -> Column:
    """A double as whole part, billionths, and billionths of a billionth.

    Each step is plain double arithmetic, so every engine gets the same digits,
    and values that differ give different ones. What is not finite or has no
    digits after the point any more is written as the engine prints it.
    """
    whole = F.floor(value)
    first = (value - whole) * F.lit(1e9)
    second = (first - F.floor(first)) * F.lit(1e9)
    digits = [whole, F.floor(first), F.floor(second)]
    text = F.concat_ws("+", *[d.cast("string") for d in digits])
    return F.when(F.abs(value) < F.lit(1e15), text).otherwise(value.cast("string"))


def set_fingerprint(hashes: Column) -> Column:
    """Sum of row hashes: the same for any row order and any file layout."""
    return F.sum(hashes.cast("decimal(20,0)")).cast("string")
