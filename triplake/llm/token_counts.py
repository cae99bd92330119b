"""Exact token counts for every context limit from a histogram of lengths.

Documents are encoded once and counted by length. All that can be asked of a
context limit follows from sums over the longer lengths, so one row for each
length answers totals, quantiles and truncated totals exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triplake.llm.common import per_row, stored
from triplake.llm.vocabulary import default_path, fast_encoder

#: Lengths that share one block of the suffix sums.
BLOCK = 1024


def lengths(df: DataFrame, text_col: str = "text", path: str | None = None) -> DataFrame:
    """``n_tokens`` of each whole text; NULL and empty texts have 0."""
    path = path or default_path()

    def start():
        encode = fast_encoder(path)
        return lambda rows: [(len(encode(t)) if t else 0,) for (t,) in rows]

    field = T.StructField("n_tokens", T.LongType(), False)
    return per_row(df, [text_col], [field], start, keep=[])


def histogram(df: DataFrame, text_col: str = "text", path: str | None = None) -> DataFrame:
    """One row for each length that occurs, as a context limit.

    ``n_tokens`` (the limit), ``n_docs`` of that length, ``docs_over`` and
    ``tokens_over`` of longer documents, ``total_docs``, ``total_tokens``,
    ``truncated_tokens`` (kept when every document is cut at the limit),
    ``lost_tokens`` and ``share_at_most`` (the quantile that the length is). An
    empty table has no rows; repeated rows count once each.
    """
    counts = stored(
        lengths(df, text_col, path).groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs")),
        "length-histogram",
    ).withColumn("block", F.floor(F.col("n_tokens") / BLOCK))
    # Suffix sums in two steps, so that no task sorts all lengths: over blocks,
    # of which there are a thousandth as many, then within each block.
    tokens = F.col("n_tokens") * F.col("n_docs")
    blocks = counts.groupBy("block").agg(
        F.sum("n_docs").alias("block_docs"), F.sum(tokens).alias("block_tokens")
    )
    later = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("block_docs").over(later), F.lit(0)).alias("later_docs"),
        F.coalesce(F.sum("block_tokens").over(later), F.lit(0)).alias("later_tokens"),
        F.sum("block_docs").over(every).alias("total_docs"),
        F.sum("block_tokens").over(every).alias("total_tokens"),
    )
    longer = (
        Window.partitionBy("block").orderBy(F.col("n_tokens").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    over_docs = F.coalesce(F.sum("n_docs").over(longer), F.lit(0)) + F.col("later_docs")
    over_tokens = F.coalesce(F.sum(tokens).over(longer), F.lit(0)) + F.col("later_tokens")
    out = counts.join(blocks, "block").select(
        "n_tokens", "n_docs", over_docs.alias("docs_over"), over_tokens.alias("tokens_over"),
        "total_docs", "total_tokens",
    )
    kept = F.col("total_tokens") - F.col("tokens_over") + F.col("docs_over") * F.col("n_tokens")
    return out.withColumns(
        {
            "truncated_tokens": kept,
            "lost_tokens": F.col("total_tokens") - kept,
            "share_at_most": (F.col("total_docs") - F.col("docs_over")) / F.col("total_docs"),
        }
    )


def at_limit(table: DataFrame, limit: int) -> DataFrame:
    """Totals when every document is cut at any limit, occurring or not: the row
    of the largest length up to the limit, carried to the limit itself. A limit
    below the shortest length cuts every document; an empty table gives NULLs."""
    below = table.filter(F.col("n_tokens") <= limit)
    at = below.agg(F.max_by(F.struct("*"), "n_tokens").alias("r"))
    every = table.agg(
        F.max("total_docs").alias("total_docs"), F.max("total_tokens").alias("total_tokens")
    )
    more = F.col("r.docs_over") * (F.lit(limit) - F.col("r.n_tokens"))
    # Below the shortest length every document is cut.
    cut = F.col("total_docs") * F.lit(max(limit, 0))
    return at.crossJoin(every).select(
        F.lit(limit).cast("long").alias("limit"),
        F.coalesce("r.docs_over", "total_docs").alias("docs_over"),
        F.coalesce(F.col("r.truncated_tokens") + more, cut).alias("truncated_tokens"),
        F.coalesce(F.col("r.lost_tokens") - more, F.col("total_tokens") - cut).alias("lost_tokens"),
    )


def quantile(table: DataFrame, share: float) -> DataFrame:
    """The least length that at least this share of documents does not exceed."""
    return table.filter(F.col("share_at_most") >= share).agg(F.min("n_tokens").alias("n_tokens"))
