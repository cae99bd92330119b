"""Document fingerprints from content-defined chunks.

A gear hash runs over the normalised text; a chunk ends where bits of the hash
are zero. More bits are asked for below the usual length and fewer above it
(normalised chunking), which keeps lengths close together. A boundary depends on
the 32 bytes before it only, so an edit changes the chunks that it touches and
the others keep their digests wherever they move.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from triplake.llm.common import per_row, python_ready

# Chunk lengths in bytes of normalised text, and zero bits asked for.
MIN_CHUNK, USUAL_CHUNK, MAX_CHUNK = 8, 32, 128
STRICT_BITS, LOOSE_BITS = 6, 4
#: Documents of one range of ids, when neighbours are looked up.
RANGE_ROWS = 20_000


def _gear() -> np.ndarray:
    """A random-looking number for each byte, by the splitmix64 rule."""
    with np.errstate(over="ignore"):
        x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return ((x ^ (x >> np.uint64(31))) >> np.uint64(32)).astype(np.uint32)


_GEAR = _gear()


def normalised(text: str) -> bytes:
    """Lower case, every run of white space one space, none at the ends."""
    return " ".join(text.lower().split()).encode("utf-8", "surrogatepass")


def gear_hashes(data: bytes) -> np.ndarray:
    """hash[i] = hash[i-1] * 2 + gear[data[i]], 32 bits wide, for all i.

    The sum over 32 bytes is built from sums over 1, 2, 4, 8 and 16.
    """
    out = _GEAR[np.frombuffer(data, np.uint8)]
    width = 1
    while width < 32:
        out[width:] += out[:-width] << np.uint32(width)
        width *= 2
    return out


def chunk_ends(data: bytes) -> list[int]:
    size = len(data)
    if size <= MIN_CHUNK:
        return [size] if size else []
    # The high bits depend on all 32 bytes.
    hashes = gear_hashes(data)
    loose = np.flatnonzero(hashes < np.uint32(1 << (32 - LOOSE_BITS))) + 1
    strict = loose[hashes[loose - 1] < np.uint32(1 << (32 - STRICT_BITS))].tolist()
    loose = loose.tolist()
    strict.append(size + MAX_CHUNK)
    loose.append(size + MAX_CHUNK)
    ends, begin = [], 0
    while begin < size:
        usual = begin + USUAL_CHUNK
        end = strict[bisect_left(strict, begin + MIN_CHUNK)]
        if end >= usual:
            end = loose[bisect_left(loose, usual)]
        end = min(end, begin + MAX_CHUNK, size)
        ends.append(end)
        begin = end
    return ends


def chunks(text: str | None) -> dict[str, int]:
    """Length of each distinct chunk, by digest."""
    data = normalised(text or "")
    out, begin = {}, 0
    for end in chunk_ends(data):
        out[xxhash.xxh3_64_hexdigest(data[begin:end])] = end - begin
        begin = end
    return out


def fingerprint(found: dict[str, int]) -> str:
    """``digest:length`` by digest, joined by commas."""
    return ",".join([f"{d}:{found[d]}" for d in sorted(found)])


def containment(inner: dict[str, int], outer: dict[str, int]) -> float:
    """Share of the first's length in chunks that the second has too.

    An empty fingerprint is contained in another empty one only.
    """
    total = sum(inner.values())
    if not total:
        return float(not outer)
    return sum([inner[d] for d in inner.keys() & outer.keys()]) / total


def _beginning(text: Column) -> Column:
    """The first seven bytes of a text as a number in the same order; NULL is first."""
    digits = F.rpad(F.hex(F.substring(text.cast("binary"), 1, 7)), 14, "0")
    return F.coalesce(F.conv(digits, 16, 10).cast("bigint"), F.lit(-1))


def _in_places(source: DataFrame, ranges: int) -> tuple[DataFrame, list[int]]:
    """Rows of id and text with the ``place`` that they have in the order, and the
    places that have rows. Cuts are a few numbers for each place."""
    keyed = source.withColumn("key", F.col("id").cast("double"))
    probabilities = [i / ranges for i in range(1, ranges)]
    cuts = keyed.approxQuantile("key", probabilities, 1 / (4 * ranges)) if ranges > 1 else []
    # An id that many cuts fall on has a range of its own.
    alone = {math.nextafter(c, math.inf) for c, n in Counter(cuts).items() if n > 1}
    splits = [-math.inf, *(sorted({*cuts, *alone}) or [0.0]), math.inf]
    ranged = Bucketizer(
        splits=splits, inputCol="key", outputCol="range", handleInvalid="keep"
    ).transform(keyed).withColumn(
        "range", F.coalesce(F.col("range").cast("int"), F.lit(len(splits)))  # NULL ids last
    ).drop("key")
    counts = ranged.groupBy("range").agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("low"), F.max("id").alias("high")
    ).collect()
    parts = {
        r.range: math.ceil(r.n / RANGE_ROWS) for r in counts
        if r.n > 2 * RANGE_ROWS and r.low == r.high
    }
    begins: dict[int, list[int]] = {}
    if parts:
        most = max(parts.values())
        found = ranged.filter(F.col("range").isin(sorted(parts))).groupBy("range").agg(
            F.percentile_approx(
                _beginning(F.col("text")), [i / most for i in range(1, most)], F.lit(10 * most)
            ).alias("cuts")
        )
        begins = {r.range: sorted(set(r.cuts)) for r in found.collect()}
    bases, at = [], 0
    for number in range(len(splits) + 1):
        bases.append(at)
        at += 1 + len(begins.get(number, ()))
    place = F.get(F.lit(bases), F.col("range"))
    for number, own in begins.items():
        later = F.size(F.filter(F.lit(own), lambda c: c <= _beginning(F.col("text"))))
        place = F.when(F.col("range") == number, F.lit(bases[number]) + later).otherwise(place)
    ranged = ranged.select("id", "text", place.cast("int").alias("place"))
    places = sorted(r.place for r in ranged.select("place").distinct().collect())
    return ranged, places


def with_following(
    df: DataFrame, start, fields: list[T.StructField], id_col: str, text_col: str
) -> DataFrame:
    """Results of a function of text and next text beside each row's id.

    ``start`` is called once per task and returns that function; ids are numbers.

    Rows are in ascending order of id, then text; NULL ids come last and the
    last row is followed by the first. Ids are cut into ranges of similar size, and
    an id (or NULL) with more rows than a range should have is cut again by the
    beginnings of its texts. The first row of each range is copied to the range
    before, and each range is then read in order: one shuffle, and no task sees
    more than its range, unless more rows begin alike.
    """
    spark = df.sparkSession
    python_ready(spark)
    count = df.count()
    ranges = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(count / RANGE_ROWS), 1
    )
    source = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    ranged, places = _in_places(source, ranges)
    # The place before each, for the copy of its first row.
    before = [0] * (max(places, default=0) + 1)
    for i, place in enumerate(places):
        before[place] = places[i - 1]
    start_of = (
        ranged.select("place", F.struct("id", _beginning(F.col("text")).alias("begins")).alias("key"))
        .groupBy("place").agg(F.min("key").alias("key"))
        .select(F.col("place").alias("p"), F.col("key.id").alias("i"), F.col("key.begins").alias("b"))
    )
    # One row for each place, and as many as begin like its first one before the last step.
    heads = (
        ranged.join(
            F.broadcast(start_of),
            (F.col("place") == F.col("p")) & F.col("id").eqNullSafe(F.col("i"))
            & (_beginning(F.col("text")) == F.col("b")),
        )
        .groupBy("place").agg(F.min(F.struct("id", "text")).alias("row"))
        .select(
            F.get(F.lit(before), F.col("place")).alias("place"), F.lit(1).alias("ahead"),
            "row.id", "row.text",
        )
    )
    placed = (
        ranged.select("place", F.lit(0).alias("ahead"), "id", "text").union(heads)
        .repartitionById(max(len(before), ranges), F.col("place"))
        .sortWithinPartitions("place", "ahead", F.col("id").asc_nulls_last(), "text")
    )
    schema = T.StructType([T.StructField(id_col, df.schema[id_col].dataType), *fields])
    arrow = to_arrow_schema(schema)

    def run(batches):
        compute = start()
        waiting = None  # the last own row, until the row after it is seen
        out = []
        for batch in batches:
            columns = batch.columns
            for i in range(batch.num_rows):
                place, ahead = columns[0][i].as_py(), columns[1][i].as_py()
                row = columns[2][i].as_py(), columns[3][i].as_py()
                if waiting is not None:
                    out.append((waiting[1][0], *compute(waiting[1][1], row[1])))
                waiting = None if ahead else (place, row)
                if len(out) >= 64:
                    yield _batch(out, arrow)
                    out = []
        if out:
            yield _batch(out, arrow)

    return placed.mapInArrow(run, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema
    )


def fingerprints(df: DataFrame, text_col: str = "text", out_col: str = "fingerprint") -> DataFrame:
    """Add each text's fingerprint; NULL and empty texts have an empty one."""
    def start():
        return lambda rows: [(fingerprint(chunks(t)),) for (t,) in rows]

    return per_row(df, [text_col], [T.StructField(out_col, T.StringType(), False)], start)


def edited(text: str, following: str) -> str:
    """The last quarter of a text, replaced by as much of the next one's start."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def compare_edited(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text's fingerprint beside that of its edited text and the next text.

    NULL texts count as empty. Rows that share an id follow each other in the
    order of their texts; repeated rows are rows of their own.
    """
    fields = [
        T.StructField("n_chars", T.LongType(), False),
        T.StructField("edited_text", T.StringType(), False),
        T.StructField("fingerprint", T.StringType(), False),
        T.StructField("edited_fingerprint", T.StringType(), False),
        T.StructField("near_edited", T.DoubleType(), False),
        T.StructField("near_next", T.DoubleType(), False),
    ]

    def start():
        recent = lru_cache(maxsize=2)(chunks)  # the next text is the next row's own

        def compute(text, following):
            text, following = text or "", following or ""
            changed = edited(text, following)
            own, other, after = recent(text), chunks(changed), recent(following)
            return (
                len(text), changed, fingerprint(own), fingerprint(other),
                containment(own, other), containment(own, after),
            )

        return compute

    return with_following(df, start, fields, id_col, text_col)
