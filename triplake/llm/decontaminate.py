"""Benchmark decontamination by winnowing, in DataFrame operations only.

Words are runs of digits, a-z (A-Z in lower case) and characters beyond ASCII. A
window is ``WINDOW`` consecutive words of a benchmark item, or all words of a
shorter item; document words inside an occurrence of a window are hit.

Every word k-gram is hashed, and of each run of neighbouring k-grams the smallest
hash is kept, with its place. A window is one run of k-grams long, so a document
that holds it keeps the same smallest hash at the same place of the window as the
benchmark does: no occurrence is missed, though only about a third of the hashes
is kept. Hashes that both sides keep are extended to the windows around them,
which count if the benchmark has them. A shorter item is one gram of its own
length; only lengths that the benchmark has are looked for.

The result depends on the text alone, so texts found several times are extended
once. Documents with the same windows share one list of items.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triplake.llm.common import stored, text_digest

#: Words of a benchmark window; shared spans of so many words are always found.
WINDOW = 10
#: Words of a hashed gram; of every WINDOW - GRAM + 1 grams the smallest is kept.
GRAM = 5
#: Slots of the broadcast sieves: at most this many rows, whatever the tables hold.
FILTER_SLOTS = 1 << 18
_BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text as an array; none for NULL."""
    lowered = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    words = F.filter(F.split(lowered, _BETWEEN_WORDS, -1), lambda w: w != "")
    return F.coalesce(words, F.array().cast("array<string>"))


def _gram_hashes(count: int, span: int) -> Column:
    """Hashes of all grams of ``count`` words, from the columns hashed and n."""
    places = F.when(F.col("n") >= count, F.sequence(F.lit(0), F.col("n") - count))
    return F.transform(
        places,
        lambda i: F.xxhash64(F.lit(span), *[F.get("hashed", i + j) for j in range(count)]),
    )


def _print_of(span: int):
    return lambda x, i: F.struct(x.alias("key"), F.lit(span).alias("span"), i.alias("at"))


def _with_prints(df: DataFrame, spans: list[int], window: int, gram: int) -> DataFrame:
    """Explode rows with an array ``words`` into their kept hashes: key, span, at.

    The other columns stay.
    """
    kept = [c for c in df.columns if c != "words"]
    run = window - gram + 1
    df = df.withColumns(
        {"hashed": F.transform("words", lambda w: F.xxhash64(w)), "n": F.size("words")}
    ).drop("words")
    # A place keeps its hash if that is the smallest of any run of grams over it;
    # no run's smallest is larger, so the largest of these is compared.
    columns = {f"grams{s}": _gram_hashes(gram if s == window else s, s) for s in spans}
    df = df.withColumns(columns)
    arrays = []
    for span in spans:
        grams = F.col(f"grams{span}")
        if span == window:
            runs = F.when(F.col("n") >= window, F.sequence(F.lit(0), F.col("n") - window))
            df = df.withColumn(
                "least",
                F.transform(runs, lambda i: F.least(*[F.get(f"grams{window}", i + j) for j in range(run)])),
            )
            marked = F.transform(
                grams,
                lambda x, i: F.when(
                    F.greatest(*[F.get("least", i - j) for j in range(run)]) == x,
                    _print_of(window)(x, i),
                ),
            )
            marked = F.filter(marked, lambda p: p.isNotNull())
        else:
            marked = F.transform(grams, _print_of(span))
        none = F.array().cast("array<struct<key:bigint,span:int,at:int>>")
        arrays.append(F.coalesce(marked, none))
    return df.select(*kept, F.explode(F.concat(*arrays)).alias("p")).select(
        *kept, "p.key", "p.span", "p.at"
    )


def _slot(key: Column) -> Column:
    return F.pmod(key, F.lit(FILTER_SLOTS)).cast("int")


def _sieved(df: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """Rows whose key may be among the wanted ones; the sieve's size is bounded."""
    slots = wanted.select(_slot(F.col(column)).alias("slot")).distinct()
    return df.join(F.broadcast(slots), _slot(F.col(column)) == F.col("slot"), "left_semi")


def _item_windows(items: DataFrame, window: int) -> DataFrame:
    """class, w1, w2: digests of the windows of each distinct word sequence."""
    span = F.least(F.col("n"), F.lit(window))
    texts = F.transform(
        F.sequence(F.lit(0), F.col("n") - span),
        lambda i: F.array_join(F.slice("words", i + 1, span), " "),
    )
    return (
        items.withColumn("n", F.size("words"))
        .select("c1", "c2", F.explode(texts).alias("text"))
        .select("c1", "c2", *[d.alias(f"w{i}") for i, d in enumerate(text_digest(F.col("text")), 1)])
        .distinct()
    )


def _occurrences(texts: DataFrame, windows: DataFrame, window: int, gram: int) -> DataFrame:
    """d1, d2, hit_words, found: of texts with places to extend (``spots``), the
    words inside occurring windows and the digests of these windows."""

    # A place is one number, at and span together: sets of numbers are hashed,
    # where Spark compares each two structs of an array.
    def packed(at: Column, span: Column) -> Column:
        return at.cast("long") * (window + 1) + span

    def around(p: Column) -> Column:
        first = F.greatest(p["at"] - (window - gram), F.lit(0))
        last = F.least(p["at"], F.col("n") - window)
        return F.when(
            p["span"] == window,
            F.transform(F.sequence(first, last), lambda i: packed(i, p["span"])),
        ).otherwise(F.array(packed(p["at"], p["span"])))

    def digested(place: Column) -> Column:
        span = (place % (window + 1)).cast("int")
        at = F.floor(place / (window + 1)).cast("int")
        text = F.array_join(F.slice("words", at + 1, span), " ")
        return F.struct(
            at.alias("at"), span.alias("span"),
            *[d.alias(f"w{i}") for i, d in enumerate(text_digest(text), 1)],
        )

    tried = F.array_distinct(F.flatten(F.transform("spots", around)))
    met = (
        texts.withColumn("n", F.size("words")).withColumn("tried", tried)
        .select("d1", "d2", F.explode(F.transform("tried", digested)).alias("t"))
        .select("d1", "d2", "t.at", "t.span", "t.w1", "t.w2")
    )
    windows = windows.select("w1", "w2").distinct()
    inside = F.flatten(
        F.transform("places", lambda p: F.sequence(p["at"], p["at"] + p["span"] - 1))
    )
    return (
        _sieved(met, "w1", windows).join(windows, ["w1", "w2"])
        .groupBy("d1", "d2")
        .agg(
            F.collect_set(F.struct("at", "span")).alias("places"),
            F.array_sort(F.collect_set(F.struct("w1", "w2"))).alias("found"),
        )
        .select("d1", "d2", F.array_sort(F.array_distinct(inside)).alias("hit_words"), "found")
    )


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """id, ``n_words``, ``hit_words`` and ``items`` of every row of ``docs``.

    ``hit_words`` are the places of words inside occurring windows, ``items`` the
    ids, as sorted strings, of items with such windows. Texts that are NULL, empty
    or without words are clean, and such items have no windows. Rows alike or with
    the same or no id each get their result. Items of the same id are one item; an
    item without id hits words but is not listed. With an empty benchmark, or no
    documents, nothing is hit. A text of any length is one row: its words, their
    hashes and the windows tried sit in arrays, a few times its size. Other columns
    do not matter.
    """
    text, item_text = F.col(f"`{text_col}`"), F.col(f"`{item_text_col}`")
    items = stored(
        benchmark.select(F.col(f"`{item_col}`").cast("string").alias("item"),
                         words_of(item_text).alias("words"))
        .filter(F.size("words") > 0)
        .withColumns(dict(zip(("c1", "c2"), text_digest(F.array_join("words", " "))))),
        "benchmark-items",
    )
    sequences = items.groupBy("c1", "c2").agg(F.first("words").alias("words"))
    # At most ``window`` numbers, whatever the benchmark holds.
    spans = sorted(r[0] for r in sequences.select(F.least(F.size("words"), F.lit(window))).distinct().collect())
    none = docs.select(
        F.col(f"`{id_col}`").alias(id_col), F.size(words_of(text)).alias("n_words"),
        F.array().cast("array<int>").alias("hit_words"),
        F.array().cast("array<string>").alias("items"),
    )
    if not spans:
        return none
    windows = stored(_item_windows(sequences, window), "benchmark-windows")
    prints = stored(
        _with_prints(sequences.select("words"), spans, window, gram).select("key").distinct(),
        "benchmark-prints",
    )
    keyed = docs.select(
        F.col(f"`{id_col}`").alias("id"), text.alias("text"),
        *[d.alias(f"d{i}") for i, d in enumerate(text_digest(text), 1)],
    )
    with_words = keyed.select("d1", "d2", words_of(F.col("text")).alias("words"))
    hits = _sieved(_with_prints(with_words, spans, window, gram), "key", prints)
    spots = stored(
        hits.join(prints, "key").select("d1", "d2", "span", "at").distinct()
        .groupBy("d1", "d2").agg(F.collect_list(F.struct("span", "at")).alias("spots")),
        "hit-places",
    )
    texts = stored(
        _sieved(keyed.select("d1", "d2", "text"), "d1", spots)
        .join(spots.select("d1", "d2"), ["d1", "d2"], "left_semi")
        .groupBy("d1", "d2").agg(F.first("text").alias("text")),
        "hit-texts",
    )
    texts = texts.join(spots, ["d1", "d2"]).select(
        "d1", "d2", words_of(F.col("text")).alias("words"), "spots"
    )
    occurring = stored(
        _occurrences(texts, windows, window, gram)
        .withColumns(dict(zip(("s1", "s2"), text_digest(F.to_json("found"))))),
        "occurring-windows",
    )
    named = items.filter(F.col("item").isNotNull()).select("c1", "c2", "item").distinct()
    lists = stored(
        occurring.groupBy("s1", "s2").agg(F.first("found").alias("found"))
        .select("s1", "s2", F.explode("found").alias("w")).select("s1", "s2", "w.w1", "w.w2")
        .join(windows, ["w1", "w2"]).select("s1", "s2", "c1", "c2").distinct()
        .join(named, ["c1", "c2"])
        .groupBy("s1", "s2").agg(F.array_sort(F.collect_set("item")).alias("items")),
        "item-lists",
    )
    results = occurring.join(lists, ["s1", "s2"], "left").select("d1", "d2", "hit_words", "items")
    counted = keyed.select("id", "d1", "d2", F.size(words_of(F.col("text"))).alias("n_words"))
    return counted.join(results, ["d1", "d2"], "left").select(
        F.col("id").alias(id_col), "n_words",
        F.coalesce("hit_words", F.array().cast("array<int>")).alias("hit_words"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )
