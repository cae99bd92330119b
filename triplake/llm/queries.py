"""The corpus operators over their whole tables, as registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triplake.llm import (
    bpe, decontaminate, fingerprints, html, jaccard, lines, negatives, packing, quality,
    secrets, token_counts, warc, whitening,
)
from triplake.llm.common import benchmark, documents, embeddings, labels, pages
from triplake.session import new_scratch


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of each document, as digests."""
    coded = bpe.round_trip(documents(spark, sf_dir).select("doc_id", "text"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of each document; sources own the documents they hold."""
    found = secrets.scan(documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["kind"] < 3)

    def count(kind: int):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    def standing(name: str):
        return F.size(F.filter("spans", lambda s: s["standing"] == name)).cast("long")

    return found.select(
        "doc_id",
        count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(secrets.span_text(base), 256).alias("base_sha256"),
        secrets.span_text(F.col("spans")).alias("spans"),
        standing("live").alias("n_live"), standing("example").alias("n_example"),
    )


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of each text and its edited form, and how alike they are."""
    found = fingerprints.compare_edited(documents(spark, sf_dir))
    return found.select(
        "doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    )


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of each document, and the verdict of rules learned from the labels."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    rules = quality.fit(docs, labels(spark, sf_dir))
    return quality.judge(docs, rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "rule", "kept",
    )


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back from them."""
    path = new_scratch(spark, "warc")
    warc.write_archives(pages(spark, sf_dir), path)
    return warc.read_archives(spark, path, with_payload=False).drop("payload")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals for every context limit, from the exact histogram of lengths."""
    return token_counts.histogram(documents(spark, sf_dir))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document in sequences of 2048 tokens."""
    return packing.pack(documents(spark, sf_dir).select("doc_id", "text"))


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, without the templates of its site."""
    found = html.extract(pages(spark, sf_dir).select("page_id", "url", "html"))
    return found.select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_template"
    )


def op9_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without lines that stand earlier, alike or one edit away."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return lines.dedup(docs)


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose sets of three-word shingles are 90 % alike."""
    return jaccard.link(documents(spark, sf_dir), words=3, percent=90)


def op11_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document inside windows of benchmark items, and the items."""
    found = decontaminate.find(documents(spark, sf_dir), benchmark(spark, sf_dir))
    n_hit = F.size("hit_words").cast("long")
    return found.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives for the positives of every hundredth embedding."""
    other = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10)
    vectors = embeddings(spark, sf_dir).withColumn("label", F.coalesce(other, "label"))
    return negatives.mine(vectors, every=100)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first components of each embedding, one row for each of them."""
    white = whitening.whiten(embeddings(spark, sf_dir).select("vec_id", "embedding"))
    return white.select("*", F.posexplode("whitened").alias("at", "entry")).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation",
        F.col("entry").alias("whitened"), F.get("explained", F.col("at")).alias("explained"),
        "identity_error",
    )


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_secrets": op2_secrets,
    "op3_fingerprints": op3_fingerprints,
    "op4_quality": op4_quality,
    "op5_warc": op5_warc,
    "op6_token_counts": op6_token_counts,
    "op7_packing": op7_packing,
    "op8_html": op8_html,
    "op9_lines": op9_lines,
    "op10_jaccard": op10_jaccard,
    "op11_decontaminate": op11_decontaminate,
    "op12_negatives": op12_negatives,
    "op13_whitening": op13_whitening,
}
