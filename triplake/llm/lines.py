"""Line dedup by a deletion-neighbourhood join, in DataFrame operations only.

A line goes if an earlier line of the corpus equals it or is one edit away (one
character replaced, inserted or deleted). Two such lines become equal when at
most one character of each is deleted, so each line emits its variants with one
character deleted, as hashes, and equal hashes meet.

Emitting every variant of every line would be as many rows as characters. A pair
that is one edit apart shares its first half or its last half, so only lines that
share a half with another line emit variants, and only for edits in the other
half. A variant is hashed in three pieces (what is before a block of characters,
the block without the character, what is after), so a long line is not hashed
once more for each character.

Variants carry the place of the deletion where lines of one length meet: such
lines differ in that place alone, all of them from each other, so each is joined
to the earliest and no pairs within a group are made. Where lengths differ by
one, the shorter line is the variant itself and is joined to the longer ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triplake.llm.common import stored, text_digest, unused

#: Characters from which lines are compared with an edit; shorter ones must be equal.
LEAST_CHARS = 20
#: Characters of a block of a variant at least; longer lines have longer blocks.
LEAST_BLOCK = 32
#: Slots of the broadcast filter: at most this many rows, whatever the corpus.
FILTER_SLOTS = 1 << 18
_SPACES = " \t\x0b\x0c\r"


def _lines(docs: DataFrame) -> DataFrame:
    """Lines that are not blank: document key, place, text without outer spaces."""
    return (
        docs.select("id", "d1", "d2", F.posexplode(F.split("text", "\n", -1)).alias("at", "line"))
        .withColumn("line", F.btrim("line", F.lit(_SPACES)))
        .filter(F.col("line") != "")
        .withColumn("l1", F.xxhash64(F.lit(1), "line"))
        .withColumn("l2", F.xxhash64(F.lit(2), "line"))
        .withColumn("place", F.struct(F.col("id").isNull().alias("no_id"), "id", "d1", "d2", "at"))
    )


def _half_keys() -> Column:
    """Keys of the first and last half, for the line as the shorter and as the
    longer one of a pair; ``base`` is the shorter one's length."""

    def keys(base: Column, role: int) -> list[Column]:
        half = F.floor(base / 2).cast("int")
        return [
            F.struct(
                base.alias("base"), F.lit(role).alias("role"), F.lit(side).alias("side"),
                F.xxhash64(base, F.lit(side), part).alias("key"),
            )
            for side, part in (
                (0, F.left("line", half)), (1, F.right("line", half))
            )
        ]

    size = F.col("size")
    both = F.array(*keys(size, 0), *keys(size - 1, 1))
    own = F.array(*keys(size, 0))
    return F.when(size > LEAST_CHARS, both).when(size == LEAST_CHARS, own)


def _sharing_a_half(lines: DataFrame, spread: DataFrame) -> DataFrame:
    """Lines with the halves in which a partner agrees: for each base, whether a
    line of the same length, or one of the other role, shares the first half
    (then the edit is in the rest) or the last half."""
    met = spread.groupBy("key").agg(
        F.min(F.when(F.col("role") == 0, F.col("l1"))).alias("low"),
        F.max(F.when(F.col("role") == 0, F.col("l1"))).alias("high"),
        F.max("role").alias("longer"),
    )
    met = stored(
        met.select(
            "key",
            F.coalesce(F.col("low") != F.col("high"), F.lit(False)).alias("same"),
            (F.col("low").isNotNull() & (F.col("longer") == 1)).alias("other"),
        ).filter("same or other"),
        "shared-halves",
    )

    def flag(name: str, side: int) -> Column:
        return F.bool_or(F.col(name) & (F.col("side") == side))

    return (
        spread.join(met, "key")
        .groupBy("l1", "l2", "base", "role")
        .agg(
            flag("same", 0).alias("same_first"), flag("same", 1).alias("same_last"),
            flag("other", 0).alias("other_first"), flag("other", 1).alias("other_last"),
        )
        .filter("role = 0 or other_first or other_last")
    )


def _variants(lines: DataFrame) -> DataFrame:
    """Hashed variants: kind 0 with a place replaced, 1 with one deleted, 2 whole."""
    base, size, middle = F.col("base"), F.col("size"), F.col("middle")
    half = F.floor(base / 2).cast("int")
    block = F.greatest(F.lit(LEAST_BLOCK), F.ceil(F.sqrt(base.cast("double"))).cast("int"))
    cut = (
        lines.withColumn("block", block)
        .withColumn(
            "n",
            F.explode(F.sequence(F.lit(0), F.ceil(base / F.col("block")).cast("int") - 1)),
        )
        .withColumn("begin", (F.col("n") * F.col("block")).cast("int"))
        .withColumn("end", F.least(base, F.col("begin") + F.col("block")).cast("int"))
    )
    late, early = F.col("end") > half, F.col("begin") < base - half
    cut = (
        cut.withColumn(
            "same", (F.col("same_first") & late) | (F.col("same_last") & early)
        )
        .withColumn("other", (F.col("other_first") & late) | (F.col("other_last") & early))
        .filter("same or other")
        .withColumn(
            "around",
            F.xxhash64(
                base, "n", F.left("line", F.col("begin")), F.lit("|"),
                F.right("line", (base - F.col("end")).cast("int")),
            ),
        )
        .withColumn(
            "middle",
            F.substr(
                "line", F.col("begin") + 1, (F.col("end") - F.col("begin") + size - base).cast("int")
            ),
        )
    )
    places = F.sequence(F.lit(1), F.length(middle))

    def without(i: Column) -> list[Column]:
        return [F.left(middle, i - 1), F.substr(middle, i + 1)]

    replaced = F.transform(
        places,
        lambda i: F.struct(
            F.lit(0).alias("kind"),
            F.xxhash64(F.lit(0), "around", i, without(i)[0], F.lit("|"), without(i)[1]).alias("key"),
        ),
    )
    deleted = F.transform(
        places,
        lambda i: F.struct(
            F.lit(1).alias("kind"),
            F.xxhash64(F.lit(1), "around", F.concat(*without(i))).alias("key"),
        ),
    )
    whole = F.array(
        F.struct(F.lit(2).alias("kind"), F.xxhash64(F.lit(1), "around", middle).alias("key"))
    )
    none = F.array().cast("array<struct<kind:int,key:bigint>>")
    short = F.col("role") == 0
    emitted = F.concat(
        F.when(short & F.col("same"), replaced).otherwise(none),
        F.when(short & F.col("other"), whole).otherwise(none),
        F.when(~short & F.col("other"), deleted).otherwise(none),
    )
    return cut.select("me", F.explode(emitted).alias("v")).select("me", "v.kind", "v.key")


def near_lines(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """l1, l2 of distinct lines that an earlier line is one edit away from.

    ``lines`` has the distinct lines: l1, l2, size, first place and half keys.
    """
    spread = lines.filter(F.col("halves").isNotNull()).select(
        "l1", "l2", F.explode("halves").alias("h")
    ).select("l1", "l2", "h.base", "h.role", "h.side", "h.key")
    sharing = stored(_sharing_a_half(lines, spread), "sharing-a-half")
    wanted = stored(
        sharing.select("l1", "l2").distinct().join(lines.select("l1", "l2", "first"), ["l1", "l2"]),
        "wanted-lines",
    )
    # Texts of these lines: a small filter whose size does not depend on the
    # corpus sieves the lines before the exact join.
    def slot(column: Column) -> Column:
        return F.pmod(column, F.lit(FILTER_SLOTS)).cast("int")

    slots = wanted.select(slot(F.col("l1")).alias("slot")).distinct()
    texts = (
        _lines(docs)
        .join(F.broadcast(slots), slot(F.col("l1")) == F.col("slot"), "left_semi")
        .join(wanted, ["l1", "l2"])
        .filter(F.col("place") == F.col("first"))
        .select("l1", "l2", "first", "line")
        .dropDuplicates(["l1", "l2"])
    )
    texts = stored(texts.withColumn("size", F.length("line")), "wanted-texts")
    variants = _variants(
        sharing.join(
            texts.withColumn("me", F.struct("first", "l1", "l2")).drop("first"), ["l1", "l2"]
        )
    )

    def earliest(kind: int) -> Column:
        return F.min(F.when(F.col("kind") == kind, F.col("me")))

    groups = stored(
        variants.groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("members"), earliest(0).alias("replaced"),
            earliest(1).alias("longer"), earliest(2).alias("whole"),
        )
        .filter("members > 1 and (replaced is not null or (longer is not null and whole is not null))")
        .select(
            "key", "members",
            F.array("replaced", "whole", "longer").alias("partners"),
        ),
        "equal-variants",
    )
    pairs = (
        variants.join(groups, "key")
        .select("me", F.element_at("partners", F.col("kind") + 1).alias("other"))
        .filter(F.col("other") < F.col("me"))
        .select(
            F.col("me.l1").alias("l1"), F.col("me.l2").alias("l2"),
            F.col("other.l1").alias("o1"), F.col("other.l2").alias("o2"),
        )
        .distinct()
    )
    one = texts.select("l1", "l2", F.col("line").alias("line"))
    two = texts.select(F.col("l1").alias("o1"), F.col("l2").alias("o2"), F.col("line").alias("other"))
    return (
        pairs.join(one, ["l1", "l2"]).join(two, ["o1", "o2"])
        # -1 stands for more than one edit.
        .filter(F.levenshtein("line", "other", 1).between(0, 1))
        .select("l1", "l2").distinct()
    )


def dedup(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    exact_col: str = "n_exact",
    near_col: str = "n_near",
) -> DataFrame:
    """The documents without their repeated lines, and how many went.

    Lines are split at \\n and compared without outer ASCII white space. Earlier
    means a smaller id, then an earlier line; NULL ids come last, and rows that
    share an id are ordered by a digest of the text. Blank lines stay. A NULL text
    stays NULL. Rows alike in id and text are one document and give the same
    result. All columns stay; input columns named like the counts are replaced.
    """
    row = unused("row", df.columns)
    docs = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(row),
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"),
    ).withColumns(dict(zip(("d1", "d2"), text_digest(F.col("text")))))
    keyed = docs.select("id", "d1", "d2", "text")
    lines = stored(
        _lines(keyed)
        .withColumn("size", F.length("line"))
        .withColumn("halves", _half_keys())
        .groupBy("l1", "l2")
        .agg(
            F.min("place").alias("first"), F.count(F.lit(1)).alias("times"),
            F.first("size").alias("size"), F.first("halves").alias("halves"),
        ),
        "distinct-lines",
    )
    near = stored(near_lines(keyed, lines).withColumn("near", F.lit(True)), "near-lines")
    repeated = stored(
        lines.select("l1", "l2", "first", "times").join(near, ["l1", "l2"], "left")
        .filter("times > 1 or near")
        .select("l1", "l2", "first", F.coalesce("near", F.lit(False)).alias("near")),
        "repeated-lines",
    )
    gone = (
        _lines(keyed).select("id", "d1", "d2", "at", "place", "l1", "l2")
        .join(repeated, ["l1", "l2"])
        .withColumn("near", F.col("near") & (F.col("place") == F.col("first")))
        .filter(F.col("near") | (F.col("place") != F.col("first")))
        .groupBy("id", "d1", "d2")
        .agg(
            F.collect_set("at").alias("at"),
            F.count_distinct(F.when(F.col("near"), F.col("at"))).alias("near"),
        )
        .select(
            F.col("id").alias("g"), F.col("d1").alias("g1"), F.col("d2").alias("g2"), "at", "near"
        )
    )
    joined = docs.join(
        gone,
        F.col("id").eqNullSafe(F.col("g")) & (F.col("d1") == F.col("g1"))
        & (F.col("d2") == F.col("g2")),
        "left",
    )
    split = F.split("text", "\n", -1)
    places = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col("at"))
    kept = F.when(
        F.col("at").isNotNull(),
        F.array_join(F.transform(places, lambda i: F.element_at(split, i + 1)), "\n"),
    ).otherwise(F.col("text"))
    near_count = F.coalesce(F.col("near"), F.lit(0)).cast("long")
    columns = [
        kept.alias(c) if c == text_col else F.col(f"{row}.`{c}`").alias(c)
        for c in df.columns if c.lower() not in (exact_col.lower(), near_col.lower())
    ]
    return joined.select(
        *columns,
        (F.coalesce(F.size("at"), F.lit(0)) - near_count).cast("long").alias(exact_col),
        near_count.alias(near_col),
    )
