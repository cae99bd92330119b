"""From raw documents to packed training sequences, stage by stage.

Each stage takes the documents that the one before kept and is written before the
next one reads it. All but the last return the columns of documents, whatever they
are called. NULL and empty texts pass every stage but the first, which rejects
what has fewer than 20 words; they get a piece when they reach the last. Repeated
rows stay or go together, are packed once each, and an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplake.llm import jaccard, lines, packing, quality, secrets
from triplake.llm.common import documents, labels, stored, unused


def _with_length(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``n_chars`` again the length of the text, and the columns in their order."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules learned from the labels reject go."""
    return quality.keep_good(docs, quality.fit(docs, labels(spark, sf_dir)))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines seen before go, and documents of which no line is left by that."""
    exact, near = unused("exact", docs.columns), unused("near", docs.columns)
    kept = lines.dedup(docs, exact_col=exact, near_col=near)
    emptied = (F.col(exact) + F.col(near) > 0) & (
        F.btrim("text", F.lit(" \t\n\x0b\x0c\r")) == ""
    )
    return _with_length(kept.filter(~emptied), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group alike by 80 % of five-word shingles stays."""
    return jaccard.keep_one(docs, words=5, percent=80)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live secrets are masked; examples that many owners copied stay."""
    return _with_length(secrets.mask_live(docs), docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

#: Tokenising and learned rules are beyond SQL. Tests hold the operators against
#: brute force, and look at the rows that each stage keeps, masks and packs.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for number, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = stored(docs, name.replace("_", "-"))
    return docs
