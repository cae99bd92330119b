"""Best-fit packing with certified bounds and repacking across partitions.

Documents are tokenised and cut into pieces, and the pieces of a partition are
packed best-fit decreasing. Dual feasible functions give a lower bound on the
bins that any packing of the same pieces needs; a partition that meets it is
certified. Bins that are not full are what a partition could still gain from, so
these are opened, their pieces are dealt to partitions anew, fewer each time as
fewer are left, and packed again. That ends when the bound over all that is open
is met or a round gains nothing.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triplake.llm.common import python_ready, stored, to_rows
from triplake.llm.vocabulary import default_path, fast_encoder

CAPACITY = 2048
#: Pieces that a partition packs at a time.
PARTITION_PIECES = 40_000
#: Bins of which at least this share is free are opened by certified partitions;
#: others open every bin that is not full.
OPEN_SHARE = 1 / 64
#: The id of the token that ends a document.
END_ID = 0

_PIECE = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("piece", T.IntegerType(), False),
        T.StructField("start", T.LongType(), False),
        T.StructField("length", T.LongType(), False),
        T.StructField("ids_crc32", T.LongType(), False),
    ]
)


#: A piece with the number of its stored row, by which it is dealt to partitions.
_DEALT = T.StructType([*_PIECE.fields, T.StructField("row", T.LongType(), False)])


def cut(size: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """Start and end of the pieces; what does not fill one comes first."""
    rest = size % capacity
    edges = [0, *range(rest or capacity, size + 1, capacity)]
    return list(zip(edges, edges[1:]))


def pieces(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    path: str | None = None,
) -> DataFrame:
    """The pieces of each whole text: its ids, then the end id."""
    path = path or default_path()

    def start():
        encode = fast_encoder(path)

        def compute(rows):
            for doc_id, text in rows:
                ids = np.append(encode(text or ""), END_ID).astype("<u4")
                for number, (begin, end) in enumerate(cut(len(ids), capacity)):
                    yield doc_id, number, begin, end - begin, zlib.crc32(ids[begin:end].tobytes())

        return compute

    return to_rows(df, [id_col, text_col], _PIECE, start)


def lower_bound(counts: np.ndarray, capacity: int = CAPACITY) -> int:
    """Bins that any packing needs, by two families of dual feasible functions.

    ``counts`` has the number of pieces of each length from 0 to the capacity.

    A dual feasible function never sums to more than 1 over pieces that fit one
    bin, so its sum over all pieces is a bound. The first family counts pieces
    over capacity - t as whole bins and forgets those under t; the second rounds
    (n + 1) x down to whole n-ths.
    """
    sizes = np.arange(capacity + 1)
    total = np.concatenate([[0], np.cumsum(counts * sizes)])  # of sizes below i
    number = np.concatenate([[0], np.cumsum(counts)])
    t = np.arange(0, capacity // 2 + 1)
    large = number[-1] - number[capacity - t + 1]
    middle = total[capacity - t + 1] - total[t]
    best = int((large + -(-middle // capacity)).max())
    for n in range(1, 101):
        scaled = (n + 1) * sizes
        exact = scaled % capacity == 0
        # In units of 1 / (n capacity), so that all is whole numbers.
        value = np.where(exact, n * sizes, scaled // capacity * capacity)
        best = max(best, -(-int((counts * value).sum()) // (n * capacity)))
    return best


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each piece, and the free room of each bin.

    Longest first, each into the fullest bin that has room. Bins are kept by
    their free room, and a whole number has a bit for each room that some bin
    has, so the next larger room is its lowest bit.
    """
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, free = 0, []
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        fits = rooms >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            bin_ = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, bin_ = capacity, len(free)
            free.append(capacity)
        bins[i], offsets[i] = bin_, capacity - room
        room -= length
        free[bin_] = room
        if room:
            by_room[room].append(bin_)
            rooms |= 1 << room
    return bins, offsets, np.array(free, np.int64)


_PACKED = T.StructType(
    [
        *_DEALT.fields,
        T.StructField("sequence_id", T.LongType(), False),
        T.StructField("offset", T.LongType(), False),
        T.StructField("open", T.BooleanType(), False),
    ]
)


def _pack(table: DataFrame, parts: int, round_: int, capacity: int) -> DataFrame:
    """Pack each partition of pieces; mark the bins that may be packed again."""
    python_ready(table.sparkSession)
    parts_limit, bins_limit = 1 << 30, 1 << 24  # round, partition and bin in one number

    def run(part: pd.DataFrame) -> pd.DataFrame:
        number = int(part["part"].iloc[0])
        lengths = part["length"].to_numpy(np.int64)
        bins, offsets, free = best_fit(lengths, capacity)
        certified = len(free) == lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        opened = free >= capacity * OPEN_SHARE if certified else free > 0
        out = part[[f.name for f in _DEALT.fields]].copy()
        out["sequence_id"] = (round_ * parts_limit + number) * bins_limit + bins
        out["offset"] = offsets
        out["open"] = opened[bins]
        return out

    # Rows alike in all columns have numbers of their own, so they spread too.
    salt = F.xxhash64(F.lit(round_), "row")
    packed = (
        table.withColumn("part", F.pmod(salt, F.lit(parts)).cast("int"))
        .groupBy("part").applyInPandas(run, _PACKED)
    )
    return stored(packed, "packed-pieces")


def _bins(packed: DataFrame) -> int:
    return packed.agg(F.count_distinct("sequence_id")).first()[0]


def pack(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    path: str | None = None,
    partition_pieces: int = PARTITION_PIECES,
) -> DataFrame:
    """Each piece with its sequence and its place there.

    NULL and empty texts are a document of the end id alone. Repeated rows are
    packed once each. Every piece is in one sequence, none is dropped. Ids are
    whole numbers; a NULL id stays NULL.
    """
    table = pieces(df, id_col, text_col, capacity, path)
    table = stored(table.withColumn("row", F.monotonically_increasing_id()), "pieces")
    count = table.count()
    packed = _pack(table, max(1, -(-count // partition_pieces)), 0, capacity)
    out, round_ = packed.filter(~F.col("open")), 0
    while True:
        packed = packed.filter("open")
        # At most one row for each length.
        counts = np.zeros(capacity + 1, np.int64)
        for size in packed.groupBy("length").count().collect():
            counts[size["length"]] = size["count"]
        bins = _bins(packed)
        if bins <= lower_bound(counts, capacity):
            break
        round_ += 1
        pieces_left = packed.select([f.name for f in _DEALT.fields])
        again = _pack(pieces_left, -(-int(counts.sum()) // partition_pieces), round_, capacity)
        if _bins(again) >= bins:
            break
        out = out.union(again.filter(~F.col("open")))
        packed = again
    return out.union(packed).drop("open", "row").withColumnRenamed("doc_id", id_col)
