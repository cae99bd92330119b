"""Categories as text, and smoothed target encoding without leakage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from triplake.functions.exact import MINUTE_STEPS, exact_sum
from triplake.functions.hashing import HASH_BUCKETS, key_bucket
from triplake.operators.features import CATEGORICAL, LABEL
from triplake.sources.tables import stored


def with_category_text(df: DataFrame) -> DataFrame:
    return df.withColumns({f"{c}_cat": F.col(c).cast("string") for c in CATEGORICAL})


def with_fold(df: DataFrame, key: str, folds: int = 5, seed: int = 42) -> DataFrame:
    """Assign each row to a fold by its key, independently of any sampling."""
    bucket = key_bucket(F.col(key), seed, f"fold of {folds}")
    fold = F.floor(bucket * F.lit(folds) / F.lit(HASH_BUCKETS))
    return df.withColumn("fold", fold.cast("int"))


def _smoothed(n: Column, s: Column, ss: Column, all_n: Column, all_s: Column, all_ss: Column):
    """Category mean pulled to the overall mean, more so for small categories.

    The weight of the category mean is n*T / (n*T + V) with the overall label
    variance T and the variance V inside the category.
    """
    prior = all_s / F.nullif(all_n, F.lit(0))
    overall = F.greatest(all_ss / F.nullif(all_n, F.lit(0)) - prior * prior, F.lit(0.0))
    mean = s / F.nullif(n, F.lit(0))
    inside = F.greatest(ss / F.nullif(n, F.lit(0)) - mean * mean, F.lit(0.0))
    weight = n * overall / F.nullif(n * overall + inside, F.lit(0.0))
    return F.coalesce(weight * mean + (F.lit(1.0) - weight) * prior, prior)


def encoding_table(
    train: DataFrame, columns: tuple[str, ...] = CATEGORICAL, label: str = LABEL
) -> DataFrame:
    """Encodings learnt from ``train``: feature, category, fold, encoding.

    With a ``fold`` column, the row of fold f is learnt from all other folds, for
    every pair of category and fold that occurs. The row with a NULL fold is
    learnt from everything and is for unseen data. The row with a NULL category
    is the overall mean, for unseen categories. Trips are read once; what follows
    works on one row per feature, category and fold.
    """
    folded = train if "fold" in train.columns else train.withColumn("fold", F.lit(0))
    pairs = ", ".join(f"'{c}', cast({c} as string)" for c in columns)
    long = folded.select(
        "fold",
        F.col(label).alias("y"),
        F.expr(f"stack({len(columns)}, {pairs}) as (feature, category)"),
    )
    cells = (
        long.filter(F.col("category").isNotNull())
        .groupBy("feature", "category", "fold")
        .agg(
            F.count("y").alias("n"),
            exact_sum(F.col("y"), MINUTE_STEPS).alias("s"),
            exact_sum(F.col("y") * F.col("y"), MINUTE_STEPS * MINUTE_STEPS).alias("ss"),
        )
    )
    # Written for the steps below, so that trips are not read again.
    cells = stored(cells, "encoding-cells")
    sums = ("n", "s", "ss")

    def total(rows: DataFrame, prefix: str, *keys: str, source: str = "") -> DataFrame:
        columns = [F.sum(f"{source}{c}").alias(f"{prefix}{c}") for c in sums]
        return rows.groupBy(*keys).agg(*columns)

    # One row per feature and fold, and one per feature: fit for broadcast.
    per_fold = total(cells, "fold_", "feature", "fold")
    per_feature = total(per_fold, "all_", "feature", source="fold_")
    # A group of this window has one row per fold.
    in_category = Window.partitionBy("feature", "category")
    others = (
        cells.join(F.broadcast(per_fold), ["feature", "fold"])
        .join(F.broadcast(per_feature), "feature")
        .select(
            "feature",
            "category",
            "fold",
            *[(F.sum(c).over(in_category) - F.col(c)).alias(c) for c in sums],
            *[(F.col(f"all_{c}") - F.col(f"fold_{c}")).alias(f"all_{c}") for c in sums],
        )
    )
    no_fold = F.lit(None).cast("int").alias("fold")
    whole = (
        total(cells, "", "feature", "category")
        .join(F.broadcast(per_feature), "feature")
        .select("feature", "category", no_fold, *sums, *[f"all_{c}" for c in sums])
    )
    encoded = others.unionByName(whole).select(
        "feature",
        "category",
        "fold",
        _smoothed(*[F.col(c) for c in (*sums, "all_n", "all_s", "all_ss")]).alias("encoding"),
    )
    means = per_feature.select(
        "feature",
        F.lit(None).cast("string").alias("category"),
        no_fold,
        (F.col("all_s") / F.nullif("all_n", F.lit(0))).alias("encoding"),
    )
    return encoded.unionByName(means)


#: Entries of an encoding table up to which it is looked up in memory.
MAP_ENTRIES = 50_000
#: Parts of that lookup, so that few entries are searched for a key.
MAP_BUCKETS = 4096


def _key(feature: Column, fold: Column, category: Column) -> Column:
    """A text for a row of the table; NULL is not the text of any category."""
    return F.concat(
        feature, F.lit("|"), F.coalesce(fold.cast("string"), F.lit("*")), F.lit("|"),
        F.coalesce(F.concat(F.lit("="), category), F.lit("")),
    )


def _bucket(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(MAP_BUCKETS)).cast("int")


def _in_memory(table: DataFrame) -> Callable[[Column], Column]:
    """Looks a key up in one value that holds the whole table: an array of small
    maps, so that neither a join nor a shuffle of the data is needed."""
    entry = F.struct(
        _key(F.col("feature"), F.col("fold"), F.col("category")).alias("key"), "encoding"
    )
    keyed = table.select(entry.alias("entry")).withColumn("bucket", _bucket(F.col("entry.key")))
    every = table.sparkSession.range(MAP_BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    buckets = every.join(keyed, "bucket", "left").groupBy("bucket").agg(
        F.collect_list("entry").alias("entries")
    )
    in_order = F.array_sort(F.collect_list(F.struct("bucket", "entries")))
    maps = F.transform(in_order, lambda b: F.map_from_entries(b["entries"]))
    whole = stored(buckets.agg(maps.alias("maps")), "encoding-lookup").scalar()
    return lambda key: F.get(whole, _bucket(key))[key]


def encode(
    df: DataFrame,
    table: DataFrame,
    columns: tuple[str, ...] = CATEGORICAL,
    out_of_fold: bool = False,
) -> DataFrame:
    """Add ``<column>_te``. Training rows use their own fold's encodings.

    ``table`` is best a stored one: it is small (one row per category and fold).
    Up to ``MAP_ENTRIES`` rows it is looked up in memory; a larger one is joined,
    once for each column.
    """
    if table.count() > MAP_ENTRIES:
        return _encode_by_joins(df, table, columns, out_of_fold)
    value = _in_memory(table)
    none = F.lit(None).cast("string")
    fold = F.col("fold") if out_of_fold else none

    def encoded(column: str) -> Column:
        own = value(_key(F.lit(column), fold, F.col(column).cast("string")))
        known = own if not out_of_fold else F.when(F.col("fold").isNotNull(), own)
        return F.coalesce(known, value(_key(F.lit(column), none, none)))

    return df.withColumns({f"{column}_te": encoded(column) for column in columns})


def _encode_by_joins(
    df: DataFrame, table: DataFrame, columns: tuple[str, ...], out_of_fold: bool
) -> DataFrame:
    result = df
    for column in columns:
        rows = table.filter(F.col("feature") == column)
        prior = rows.filter(F.col("category").isNull()).agg(F.max("encoding")).scalar()
        wanted = F.col("fold").isNotNull() if out_of_fold else F.col("fold").isNull()
        lookup = rows.filter(wanted & F.col("category").isNotNull()).select(
            F.col("category").alias("_category"), F.col("fold").alias("_fold"),
            F.col("encoding").alias(f"{column}_te"),
        )
        same = F.col(column).cast("string") == F.col("_category")
        if out_of_fold:
            same = same & (F.col("fold") == F.col("_fold"))
        joined = result.join(lookup, same, "left").drop("_category", "_fold")
        result = joined.withColumn(f"{column}_te", F.coalesce(f"{column}_te", prior))
    return result
