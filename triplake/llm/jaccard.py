"""Set-similarity join of word shingles by PartEnum signatures, and its groups.

A document is the set of its distinct word shingles. Two sets of sizes s and t
whose Jaccard similarity is at least p have a symmetric difference of at most
(s + t)(1 - p)/(1 + p) elements. Sizes fall into bands; the join of a band takes
pairs whose larger set lies in it, so a set takes part in the join of its own
band and in that of the next. With k the largest difference that a band allows,
the domain of shingles is cut by a hash into more than k / 2 partitions of a few
parts each. Similar sets differ by one element at most in some partition, and so
agree in all but one of its parts: the signatures are the subsets of so many
parts. An empty subset says nothing of a set and is no signature, as long as a
band has spare partitions for the empty ones.

Equal sets are one node from the start. Sets that share a signature are tried
against the first of them, then, unless they are in one group by then, against
each other, so that large groups of copies give as many pairs as members. Every
pair is verified on the whole sets.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triplake.llm.common import (
    OUT_ROWS, drop_stored, per_row, python_ready, stored, to_rows, unused,
)

#: Elements that a subset of a partition should have.
SUBSET = 6
#: Nodes of a signature that make a block; blocks are compared two at a time.
BLOCK_NODES = 4096
#: Characters of the texts whose sets and signatures a task makes at once.
PORTION = 1 << 17

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finish: spreads each bit of a number over all bits."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str | None], words: int) -> tuple[np.ndarray, np.ndarray]:
    """The sets of several texts one after another, and how many elements each has.

    A set is the sorted 64-bit hashes of the distinct shingles of a text. Words are
    runs of other than the six ASCII spaces, with A-Z in lower case. A text of fewer
    words is one shingle, one without words has none.
    """
    found = [(t or "").encode("utf-8", "surrogatepass").lower().split() for t in texts]
    counts = np.fromiter(map(len, found), np.int64, len(found))
    total = int(counts.sum())
    hashed = np.fromiter(
        map(xxhash.xxh3_64_intdigest, chain.from_iterable(found)), np.uint64, total
    )
    first = np.cumsum(counts) - counts
    sizes = np.where(counts < words, np.minimum(counts, 1), counts - words + 1)
    out = np.empty(int(sizes.sum()), np.uint64)
    starts = np.cumsum(sizes) - sizes
    # Shingles begin at each word that has enough words of its text behind it.
    full = np.flatnonzero(counts >= words)
    begin = _spans(first[full], sizes[full])
    out[_spans(starts[full], sizes[full])] = _rolled(hashed, begin, words)
    for width in range(1, words):
        short = np.flatnonzero(counts == width)
        out[starts[short]] = _rolled(hashed, first[short], width)
    for start, size in zip(starts.tolist(), sizes.tolist()):
        out[start : start + size].sort()
    new = np.ones(len(out), bool)
    new[1:] = out[1:] != out[:-1]
    new[starts[sizes > 0]] = True
    distinct = np.diff(np.concatenate([[0], np.cumsum(new)])[np.append(starts, len(out))])
    return out[new], distinct


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its size says."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def _rolled(hashed: np.ndarray, begin: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the shingles of so many words that begin at some words."""
    out = np.full(len(begin), np.uint64(width))
    for i in range(width):
        out = _mixed(out * _STEP + hashed[begin + i])
    return out


def shingles(text: str | None, words: int) -> np.ndarray:
    """The set of one text."""
    return shingle_sets([text], words)[0]


def _portions(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``PORTION`` characters, whose sets are made at once."""
    begin = held = 0
    for i, text in enumerate(texts):
        held += len(text or "")
        if held >= PORTION:
            yield begin, i + 1
            begin, held = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def each_set(texts: list[str | None], words: int) -> Iterator[np.ndarray]:
    """The set of each text in turn."""
    for begin, end in _portions(texts):
        elements, sizes = shingle_sets(texts[begin:end], words)
        yield from np.split(elements, np.cumsum(sizes)[:-1])


class Signatures:
    """PartEnum for sets with at least ``percent`` / 100 similarity.

    ``parts`` is how many parts each partition has; one of them may differ. More
    parts make larger subsets, which fewer sets share by chance, and more
    signatures. By default two are enough where they have ``SUBSET`` elements.
    """

    def __init__(self, percent: int, parts: int | None = None):
        # A partition's elements, for a set of the least size that joins a band.
        held = percent * percent * (100 + percent) / 10_000 / (100 - percent) if percent < 100 else 1e9
        self.percent = percent
        self.parts = parts or (2 if held / 2 >= SUBSET else 3)
        self.bands: list[tuple[int, int, int, int]] = []

    @property
    def rounds(self) -> int:
        """In how many rounds of bands signatures are made, so that those of a round
        number about half the shingles whatever the percentage."""
        large = self.band(self.band_of(100_000))
        return max(1, math.ceil(2 * 2 * self.parts * large[2] / large[1]))

    def band(self, number: int) -> tuple[int, int, int, int]:
        """First and last size of a band, partitions, and spare partitions."""
        while len(self.bands) <= number:
            self.bands.append(self._next_band(self.bands[-1][1] + 1 if self.bands else 1))
        return self.bands[number]

    def _next_band(self, first: int) -> tuple[int, int, int, int]:
        last = max(first, first * 100 // self.percent)
        # Both sets have at most ``last`` elements in this band's join.
        most = 2 * last * (100 - self.percent) // (100 + self.percent)
        if most == 0:
            return first, last, 0, 0  # only equal sets, which are one node already
        needed = most // 2 + 1
        spare = self._spare(needed, first * self.percent // 100)
        return first, last, needed + spare, spare

    def _spare(self, needed: int, least: int) -> int:
        """Partitions beyond those needed, so that the smallest sets of a band, which
        have ``least`` elements, seldom have more with an empty subset. Bands of
        small sets cannot have as many; of theirs a few sets have more."""
        for spare in range(1, needed // 2 + 1):
            partitions = needed + spare
            subset = least / (partitions * self.parts) * (self.parts - 1)
            empty = partitions * min(1.0, self.parts * math.exp(-subset))
            if empty + 2 * math.sqrt(empty) <= spare:
                return spare
        return 1 + needed // 4

    def band_of(self, size: int) -> int:
        number = 0
        while self.band(number)[1] < size:
            number += 1
        return number

    def of(self, found: np.ndarray, rounds: int = 1, number: int = 0) -> np.ndarray:
        """Signatures of a set for its own band and the next one, as far as these
        bands are dealt with in a round."""
        return self.of_sets(found, np.array([len(found)]), rounds, number)[0]

    def of_sets(
        self, elements: np.ndarray, sizes: np.ndarray, rounds: int = 1, number: int = 0
    ) -> tuple[np.ndarray, np.ndarray]:
        """Signatures of sets that lie one after another, and whose each is."""
        keys, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        if not len(elements):
            return keys[0], places[0]
        self.band(self.band_of(int(sizes.max())) + 1)
        bands = np.array(self.bands)
        own = np.searchsorted(bands[:, 1], sizes)
        # A set too small for any partner in the next band need not join there.
        reaches = 100 * sizes >= self.percent * bands[own + 1, 0]
        starts = np.cumsum(sizes) - sizes
        for joined, wanted in ((own, sizes > 0), (own + 1, (sizes > 0) & reaches)):
            chosen = wanted & (joined % rounds == number) & (bands[joined, 2] > 0)
            sets = np.flatnonzero(chosen)
            if len(sets):
                held = elements[_spans(starts[sets], sizes[sets])]
                found, whose = self._in_bands(held, sizes[sets], joined[sets], bands[joined[sets]])
                keys.append(found)
                places.append(sets[whose])
        return np.concatenate(keys), np.concatenate(places)

    def _in_bands(
        self, elements: np.ndarray, sizes: np.ndarray, numbers: np.ndarray, bands: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Signatures of sets in one band each, and whose each is."""
        partitions, spare = bands[:, 2], bands[:, 3]
        cells = partitions * self.parts
        total = int(cells.sum())
        cell = ((elements >> np.uint64(32)) * np.repeat(cells, sizes).astype(np.uint64)) >> np.uint64(32)
        cell = cell.astype(np.int64) + np.repeat(np.cumsum(cells) - cells, sizes)
        # Each part's elements as one number. Elements come sorted, and so do parts.
        first = np.flatnonzero(np.diff(cell, prepend=-1))
        sums, filled = np.zeros(total, np.uint64), np.zeros(total, bool)
        sums[cell[first]] = np.add.reduceat(_mixed(elements ^ _STEP), first)
        filled[cell[first]] = True
        sums, filled = sums.reshape(-1, self.parts), filled.reshape(-1, self.parts)
        whose = np.repeat(np.arange(len(sizes)), partitions)
        place = _spans(np.zeros(len(sizes), np.int64), partitions) * (1 << 20) + numbers[whose] * 8
        out, some = [], []
        for chosen in combinations(range(self.parts), self.parts - 1):
            value = (place + (chosen[0] + chosen[-1])).astype(np.uint64)
            for part in chosen:
                value = _mixed(value * _STEP + sums[:, part])
            out.append(value)
            some.append(filled[:, chosen].any(axis=1))
        out, some = np.array(out), np.array(some)
        # Partitions in which sets agree number more than the spare ones, so a
        # set with few partitions of empty subsets shares a signature that is
        # not of an empty subset. A set with many needs the empty ones too.
        empty = np.bincount(whose, ~some.all(axis=0), len(sizes))
        some |= (empty > spare)[whose]
        return out[some], np.broadcast_to(whose, some.shape)[some]


_KEYED = T.StructType([T.StructField("key", T.LongType()), T.StructField("node", T.LongType())])
_PAIRS = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def sets_of(df: DataFrame, words: int) -> DataFrame:
    """id, size of the set and two halves of its digest, for rows of id and text."""

    def start():
        def compute(rows):
            for found in each_set([text for (text,) in rows], words):
                digest = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
                yield len(found), *np.frombuffer(digest, np.int64).tolist()

        return compute

    fields = [T.StructField(n, T.LongType(), False) for n in ("n_shingles", "d1", "d2")]
    return per_row(df, ["text"], fields, start, keep=["id"])


def keyed_by_signature(
    df: DataFrame, words: int, signatures: Signatures, rounds: int = 1, number: int = 0
) -> DataFrame:
    """key, node: a row for each signature of each text, for rows of id and text."""
    python_ready(df.sparkSession)

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for begin in range(0, batch.num_rows, OUT_ROWS):
                texts = batch.column(1).slice(begin, OUT_ROWS).to_pylist()
                for low, high in _portions(texts):
                    sets = shingle_sets(texts[low:high], words)
                    keys, places = signatures.of_sets(*sets, rounds, number)
                    nodes = ids[begin + low + places]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys.view(np.int64)), pa.array(nodes, pa.int64())],
                        names=["key", "node"],
                    )

    return df.select("id", "text").mapInArrow(run, _KEYED)


def shared_signatures(keyed: DataFrame) -> DataFrame:
    """key, node, first: the rows of signatures that several nodes have, beside
    the smallest node of each.

    Nearly all signatures are of one node, and all of them take more room than the
    texts. So they are never stored but made twice: once to combine the first and
    last node of each before the shuffle, and once to meet those of several nodes,
    in a join that can split a signature that a large part of the nodes has.
    """
    several = stored(
        keyed.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last"))
        .filter("first < last").select("key", "first"),
        "several-nodes",
    )
    shared = stored(keyed.join(several, "key").select("key", "node", "first"), "shared-signatures")
    drop_stored(several)
    return shared


def cross_units(shared: DataFrame, placed: DataFrame, block: int) -> DataFrame | None:
    """key, unit, side, group, node: what has to be compared within signatures
    whose nodes are in several groups, cut into units of about two blocks at most.

    ``placed`` has the group of each node. Groups of over ``block`` nodes have
    blocks of their own, the others of a signature share some. A unit is two
    blocks (sides 0 and 1) that are not of the same group, or a shared block
    (side 0) that is compared with itself. None when no signature has two groups.
    """
    rows = stored(
        shared.select("key", "node").join(placed.select("node", "group").distinct(), "node")
        .select("key", "group", "node"),
        "grouped-signatures",
    )
    several = stored(
        rows.groupBy("key").agg(F.min("group").alias("low"), F.max("group").alias("high"))
        .filter("low < high").select("key"),
        "several-groups",
    )
    if several.isEmpty():
        drop_stored(rows, several)
        return None
    mixed = stored(rows.join(several, "key"), "mixed-signatures")
    drop_stored(rows, several)
    rows = mixed
    large = F.col("n") > block
    sizes = stored(
        rows.groupBy("key", "group").agg(F.count(F.lit(1)).alias("n"))
        .select("key", "group", "n", large.alias("alone"),
                F.when(large, F.col("group")).otherwise(F.lit(0)).alias("owner")),
        "group-sizes",
    )
    blocks = stored(
        sizes.groupBy("key", "alone", "owner")
        .agg(F.ceil(F.sum("n") / block).cast("int").alias("parts")),
        "group-blocks",
    )
    part = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    each = blocks.withColumn("part", part).select(
        "key", F.struct("alone", "owner", "part").alias("b")
    )
    left, right = each.withColumnRenamed("b", "l"), each.withColumnRenamed("b", "r")
    pairs = left.join(right, "key").filter(
        "l <= r and not (l.alone and r.alone and l.owner = r.owner)"
    )
    one, two = (
        F.struct(F.lit(side).alias("side"), F.col(b).alias("b")) for side, b in ((0, "l"), (1, "r"))
    )
    sides = F.when(F.col("l") == F.col("r"), F.array(one)).otherwise(F.array(one, two))
    units = stored(
        pairs.select("key", F.xxhash64("l", "r").alias("unit"), F.explode(sides).alias("s"))
        .select("key", "unit", "s.side", "s.b.alone", "s.b.owner", "s.b.part"),
        "cross-units",
    )
    owners = stored(
        sizes.drop("n").join(blocks, ["key", "alone", "owner"])
        .select("key", "group", "alone", "owner", "parts"),
        "group-owners",
    )
    cut = stored(
        rows.join(owners, ["key", "group"])
        .withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")).drop("parts"),
        "cut-groups",
    )
    drop_stored(rows, sizes, blocks, owners)
    return cut.join(units, ["key", "alone", "owner", "part"]).select(
        "key", "unit", "side", "group", "node"
    )


def sketch(found: np.ndarray, bits: int) -> np.ndarray:
    """For each of so many cells, whether an odd number of elements is in it.

    An element that one set has and another lacks changes one bit, so the bits in
    which two sketches differ never number more than the sets' difference.
    """
    cells = _mixed(found + _STEP) & np.uint64(bits - 1)
    odd = np.bincount(cells.astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def fitting_sketch(found: np.ndarray) -> np.ndarray:
    """A sketch with one to two cells an element."""
    return sketch(found, 1 << max(6, len(found).bit_length()))


def _folded(sketches: np.ndarray, words: int) -> np.ndarray:
    """Rows of sketches made as short as so many words."""
    while sketches.shape[1] > words:
        half = sketches.shape[1] // 2
        sketches = sketches[:, :half] ^ sketches[:, half:]
    return sketches


def sketches_apart(one: np.ndarray, two: np.ndarray) -> int:
    """Bits in which two sketches differ; the longer is folded to the shorter,
    whose cells are those of the longer taken together."""
    while len(one) > len(two):
        one = one[: len(one) // 2] ^ one[len(one) // 2 :]
    while len(two) > len(one):
        two = two[: len(two) // 2] ^ two[len(two) // 2 :]
    return int(np.bitwise_count(one ^ two).sum())


def most_apart(size_one, size_two, percent: int):
    """The largest difference of two sets of these sizes that are similar."""
    return (size_one + size_two) * (100 - percent) // (100 + percent)


def _across(
    batches: Iterator[pa.RecordBatch], percent: int, nearest: bool = False
) -> Iterator[pa.RecordBatch]:
    """Pairs within a unit whose nodes are in different groups, as far as sizes
    and sketches allow them to be similar; ``nearest`` gives the closest pair alone
    for each two groups.

    Rows come sorted by key, unit, side and group; the rows of a unit, which has
    two blocks at most, sit in arrays until it ends.
    """
    held: list[list[np.ndarray]] = []
    unit = None
    for batch in batches:
        if not batch.num_rows:
            continue
        names = [batch.column(i).to_numpy() for i in (0, 1)]
        rows = [batch.column(i).to_numpy() for i in (2, 3, 4, 5)]
        marks = np.empty(batch.num_rows, object)
        marks[:] = batch.column(6).to_pylist()
        rows.append(marks)
        new = np.any([n[1:] != n[:-1] for n in names], axis=0)
        edges = [0, *(np.flatnonzero(new) + 1), batch.num_rows]
        for begin, end in zip(edges, edges[1:]):
            name = (names[0][begin], names[1][begin])
            if name != unit:
                yield from _compared(held, percent, nearest)
                unit, held = name, []
            held.append([r[begin:end] for r in rows])
    yield from _compared(held, percent, nearest)


def _compared(
    held: list[list[np.ndarray]], percent: int, nearest: bool
) -> Iterator[pa.RecordBatch]:
    """The possible pairs of one unit: of both its sides, or else of its only one."""
    if not held:
        return
    sides, groups, nodes, sizes, marks = map(np.concatenate, zip(*held))
    lengths = np.array([len(m) for m in marks])
    # The sets of a signature are of one band, so their sketches are about as long.
    sketches = np.zeros((len(marks), lengths.min() // 8), np.uint64)
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        rows = np.frombuffer(b"".join(marks[at]), np.uint64).reshape(len(at), -1)
        sketches[at] = _folded(rows, sketches.shape[1])
    lefts = int(np.searchsorted(sides, 1))
    alone = lefts == len(sides)
    closest: dict[tuple[int, int], tuple[int, int, int]] = {}
    for i in range(0 if alone else lefts, len(sides)):
        # A node meets those of smaller groups, or the other side.
        before = int(np.searchsorted(groups[:lefts], groups[i])) if alone else lefts
        if not before:
            continue
        most = most_apart(sizes[:before], sizes[i], percent)
        apart = np.bitwise_count(sketches[:before] ^ sketches[i]).sum(axis=1)
        at = np.flatnonzero((apart <= most) & (groups[:before] != groups[i]))
        if nearest:
            # Rows come by group, so each group's run is looked at on its own.
            for run in np.split(at, np.flatnonzero(np.diff(groups[at])) + 1) if len(at) else ():
                best = run[np.argmin(apart[run])]
                one, two = sorted((int(groups[best]), int(groups[i])))
                found = int(apart[best]), *sorted((int(nodes[best]), int(nodes[i])))
                closest[one, two] = min(found, closest.get((one, two), found))
        elif len(at):
            close = nodes[at]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.minimum(close, nodes[i])), pa.array(np.maximum(close, nodes[i]))],
                names=["a", "b"],
            )
    if closest:
        pairs = [pair[1:] for pair in closest.values()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in zip(*pairs)], names=["a", "b"]
        )


def _untried(
    units: DataFrame, placed: DataFrame, percent: int, nearest: bool, tried: DataFrame
) -> DataFrame:
    """Pairs of different groups in all units, without those that were tried."""
    return (
        units.join(placed.select("node", "size", "sketch"), "node")
        .select("key", "unit", "side", "group", "node", "size", "sketch")
        .repartition("key", "unit").sortWithinPartitions("key", "unit", "side", "group", "node")
        .mapInArrow(lambda batches: _across(batches, percent, nearest), _PAIRS).distinct()
        .join(tried, ["a", "b"], "left_anti")
    )


def _both(pairs: DataFrame, sets: DataFrame, columns: list[str]) -> DataFrame:
    """Columns of both nodes beside each pair, first all of a, then all of b."""
    out = pairs
    for side in ("a", "b"):
        own = sets.select(
            F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns]
        )
        out = out.join(own, side)
    return out.select("a", "b", *[f"{c}_{side}" for side in ("a", "b") for c in columns])


def _kept(batches: Iterator[pa.RecordBatch], test) -> Iterator[pa.RecordBatch]:
    """The pairs of which a test of the other columns' values holds."""
    for batch in batches:
        kept = pa.array(
            [test(*[c[i] for c in batch.columns[2:]]) for i in range(batch.num_rows)], pa.bool_()
        )
        yield batch.select([0, 1]).filter(kept)


def _similar(
    pairs: DataFrame, marks: DataFrame, texts: DataFrame, words: int, percent: int
) -> DataFrame:
    """The pairs that are similar enough, stored: by sketches, then by whole sets."""
    python_ready(pairs.sparkSession)

    def possible(size_a, sketch_a, size_b, sketch_b) -> bool:
        one, two = (np.frombuffer(s.as_buffer(), np.uint64) for s in (sketch_a, sketch_b))
        most = most_apart(size_a.as_py(), size_b.as_py(), percent)
        return sketches_apart(one, two) <= most

    def similar(elements_a, elements_b) -> bool:
        one, two = elements_a.values.to_numpy(), elements_b.values.to_numpy()
        both = len(np.intersect1d(one, two, assume_unique=True))
        return both > 0 and 100 * both >= percent * (len(one) + len(two) - both)

    close = stored(
        _both(pairs, marks, ["size", "sketch"])
        .mapInArrow(lambda batches: _kept(batches, possible), _PAIRS).distinct(),
        "possible-pairs",
    )
    nodes = close.select(F.col("a").alias("id")).union(close.select("b")).distinct()
    nodes = stored(nodes, "possible-nodes")
    sets = stored(_elements(texts.join(nodes, "id", "left_semi"), words), "shingle-elements")
    alike = stored(
        _both(close, sets, ["elements"])
        .mapInArrow(lambda batches: _kept(batches, similar), _PAIRS).distinct(),
        "similar-pairs",
    )
    drop_stored(close, nodes, sets)
    return alike


def components(edges: DataFrame) -> DataFrame:
    """node, group: the smallest node that each node of an edge (a, b) can reach.

    Rounds of large stars and small stars: every node hands its larger
    neighbours, then its smaller ones, to the smallest neighbour. The edges of a
    round are written, so lineage stays short and a lost executor costs a round
    at most. Every join side is a written table, so that hubs can be split.
    """

    def smallest(table: DataFrame) -> DataFrame:
        return stored(table.groupBy("u").agg(F.min("v").alias("m")), "smallest-neighbour")

    edges = stored(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter("u <> v").distinct(),
        "component-edges",
    )
    state = None
    while True:
        now = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if now == state or not now[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("group"))
        state, last = now, edges
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = smallest(both).select("u", F.least("u", "m").alias("m"))
        large = stored(
            both.filter("v > u").join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v").distinct(),
            "large-star",
        )
        low = smallest(large)
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(
            small.union(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct(),
            "component-edges",
        )
        drop_stored(last, large)


def link(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    percent: int = 80,
    parts: int | None = None,
) -> DataFrame:
    """id, ``n_shingles`` and ``component_id`` of every row.

    The component is the smallest id that links lead to, the row's own included.
    Texts without words (NULL, empty, blank) have no set and stand alone. Equal
    sets are linked. A row without id has no component and links nothing; rows
    that share an id stand for one document. Ids are whole numbers; other columns
    do not matter.
    """
    signatures = Signatures(percent, parts)
    texts = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    own = stored(sets_of(texts, words), "shingle-sets")
    # One node for each set, named by its smallest id.
    nodes = stored(
        own.filter(F.col("id").isNotNull() & (F.col("n_shingles") > 0))
        .groupBy("d1", "d2").agg(F.min("id").alias("node")),
        "shingle-nodes",
    )
    copies = stored(
        own.select("id").join(nodes.select(F.col("node").alias("id")), "id", "left_anti"),
        "set-copies",
    )
    singles = stored(
        texts.filter(F.col("id").isNotNull()).join(copies, "id", "left_anti"), "single-texts"
    )
    rounds = signatures.rounds
    shared = reduce(DataFrame.union, tables := [
        shared_signatures(keyed_by_signature(singles, words, signatures, rounds, number))
        for number in range(rounds)
    ])
    pairs = stored(
        shared.filter("first < node").select(F.col("first").alias("a"), F.col("node").alias("b"))
        .distinct(),
        "star-pairs",
    )
    wanted = stored(shared.select(F.col("node").alias("id")).distinct(), "shared-nodes")
    marks = stored(_marks(texts.join(wanted, "id", "left_semi"), words), "set-sketches")
    edges = _similar(pairs, marks, texts, words, percent)
    groups = components(edges)
    # What the stars did not bring together is compared directly: the closest pair
    # of each two groups at first, which joins nearly all that belong together, and
    # then every pair of what is left.
    tried, found = pairs, [edges]
    for nearest in (True, False):
        placed = stored(
            marks.join(groups, "node", "left").select(
                "node", F.coalesce("group", "node").alias("group"), "size", "sketch"
            ),
            "placed-nodes",
        )
        units = cross_units(shared, placed, BLOCK_NODES)
        if units is None:
            drop_stored(placed)
            break
        across = stored(_untried(units, placed, percent, nearest, tried), "cross-pairs")
        drop_stored(placed)
        more = _similar(across, marks, texts, words, percent)
        tried = tried.union(across)
        found.append(more)
        if not more.isEmpty():
            groups = components(reduce(DataFrame.union, found))
    named = stored(
        nodes.join(groups, "node", "left").select(
            "d1", "d2", F.coalesce("group", "node").alias("component")
        ),
        "set-components",
    )
    drop_stored(nodes, copies, singles, *tables, pairs, wanted, marks, *found)
    return own.join(named, ["d1", "d2"], "left").select(
        F.col("id").alias(id_col), "n_shingles",
        F.when(F.col("id").isNull(), F.lit(None).cast("long"))
        .otherwise(F.coalesce("component", "id")).alias("component_id"),
    )


def _elements(df: DataFrame, words: int) -> DataFrame:
    """node and its set."""
    fields = T.StructType(
        [
            T.StructField("node", T.LongType()),
            T.StructField("elements", T.ArrayType(T.LongType(), False)),
        ]
    )

    def start():
        def compute(rows):
            sets = each_set([text for _, text in rows], words)
            return [(node, np.sort(found.view(np.int64))) for (node, _), found in zip(rows, sets)]

        return compute

    return to_rows(df, ["id", "text"], fields, start)


def _marks(df: DataFrame, words: int) -> DataFrame:
    """node, the size of its set, and a sketch of it."""
    fields = T.StructType(
        [
            T.StructField("node", T.LongType()), T.StructField("size", T.LongType()),
            T.StructField("sketch", T.BinaryType()),
        ]
    )

    def start():
        def compute(rows):
            for (node, _), found in zip(rows, each_set([text for _, text in rows], words)):
                yield node, len(found), fitting_sketch(found).tobytes()

        return compute

    return to_rows(df, ["id", "text"], fields, start)


def keep_one(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    words: int = 5, percent: int = 80, parts: int | None = None,
) -> DataFrame:
    """One document of each group, the one with the smallest id; the rest goes.

    Rows without id or without words stay. Rows that share an id stay or go
    together.
    """
    linked = link(df, id_col, text_col, words, percent, parts)
    name = unused("gone", df.columns)
    gone = linked.filter(F.col("component_id") < F.col(id_col)).select(
        F.col(id_col).alias(name)
    ).distinct()
    return df.join(gone, F.col(f"`{id_col}`") == F.col(name), "left_anti")
