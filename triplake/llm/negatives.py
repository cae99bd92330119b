"""Hard negatives from lists that clusters of anchors share.

Anchors are clustered by direction. A row can score at most |a||r| cos(t - w)
with an anchor a, where t is the angle of the row r to the centre of a's cluster
and w the largest angle of the cluster's anchors to it. Rows are sorted by that
bound once for each cluster, |r| cos(t - w) falling, and all anchors of the
cluster walk the list together. An anchor stops when the bound certifies that no
later row can be among its best; its result is then exact, and when the whole
cluster has stopped, the rest of the list is passed over.

There are two walks: for the best rows of the same label, whose scores give the
range of negatives, and for the best of other labels within each range. A list is
cut into slabs and a large cluster into parts, so a walk holds ``PART_ANCHORS``
anchors and a batch of rows; the results of slabs, a few rows for each anchor, are
ranked in Spark. Only centres, at most ``CLUSTERS``, are sent to all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triplake.llm.common import python_ready, stored
from triplake.llm.vectors import on_grid, rows_of, with_values

SCALE = 256
#: Grid values lie below this size, so that whole inner products fit a long.
GRID_END = 1 << 24
#: Clusters of anchors, and how many anchors at most are read to place them.
CLUSTERS, SAMPLE_ANCHORS = 8, 4096
#: Rows of a slab about, and anchors of a part about.
SLAB_ROWS, PART_ANCHORS = 1 << 15, 1 << 12
#: Rows and goals that are scored at a time.
STEP_ROWS, STEP_GOALS = 512, 1024
_MOST = np.iinfo(np.int64).max
#: Added to a cluster's angle for the rounding of angles.
_SLACK = 1e-6


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; rows of zeros stay."""
    length = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(length > 0, length, 1)


def centres_of(sample: np.ndarray, clusters: int, rounds: int = 8) -> np.ndarray:
    """Centres of directions by spherical k-means, from rows spread evenly."""
    rows = _unit(sample.astype(float))
    centres = rows[np.linspace(0, len(rows) - 1, min(clusters, len(rows))).astype(int)]
    for _ in range(rounds):
        nearest = np.argmax(rows @ centres.T, axis=1)
        centres = _unit(np.array([rows[nearest == k].sum(axis=0) for k in range(len(centres))]))
    return centres


def angles(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Angle of each row to each centre."""
    return np.arccos(np.clip(_unit(x.astype(float)) @ centres.T, -1, 1))


def bounds(x: np.ndarray, centres: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """For each row and cluster, the most that the row can score with an anchor of
    the cluster, for each unit of the anchor's length."""
    beyond = np.maximum(angles(x, centres) - widths - _SLACK, 0)
    return np.linalg.norm(x.astype(float), axis=1, keepdims=True) * np.cos(beyond)


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Whole inner products: in floating point where that holds them exactly."""
    most = float(np.abs(anchors).max(initial=0)) * float(np.abs(rows).max(initial=0))
    if most * anchors.shape[1] < 2.0**53:
        return (anchors.astype(float) @ rows.astype(float).T).astype(np.int64)
    return anchors.astype(np.int64) @ rows.astype(np.int64).T


class Walk:
    """The best rows for the goals of some anchors, along a list by falling bound.

    A goal is an anchor's place in ``vectors`` with a lowest and a highest score.
    Its best ``count`` rows between them are kept, ties by smaller id: rows of the
    anchor's label other than itself (``same``), or else rows of other labels.
    """

    def __init__(self, vectors, ids, labels, goals, count: int, same: bool):
        self.vectors, self.ids, self.labels = vectors, ids, labels
        self.anchor, low, self.high = (np.array(g, np.int64) for g in zip(*goals))
        self.count, self.same = count, same
        self.lengths = np.linalg.norm(vectors.astype(float), axis=1)[self.anchor]
        #: goal, score and id of the rows kept
        self.best = np.zeros((0, 3), np.int64)
        #: the least score that can still matter to each goal
        self.least = low
        self.walking = np.arange(len(low))

    def stop(self, bound: float) -> bool:
        """Goals end that no row within the bound can change; whether all have."""
        reach = self.lengths[self.walking] * bound
        reach = np.floor(reach + 1e-9 * np.abs(reach) + 1e-6)
        self.walking = self.walking[reach >= self.least[self.walking]]
        return not len(self.walking)

    def see(self, vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        for begin in range(0, len(self.walking), STEP_GOALS):
            goals = self.walking[begin : begin + STEP_GOALS]
            used, place = np.unique(self.anchor[goals], return_inverse=True)
            alike = labels == self.labels[used, None]
            fits = alike & (ids != self.ids[used, None]) if self.same else ~alike
            got, fits = scores(self.vectors[used], vectors)[place], fits[place]
            fits &= (got >= self.least[goals, None]) & (got <= self.high[goals, None])
            goal, row = np.nonzero(fits)
            if len(goal):
                self._keep(np.stack([goals[goal], got[goal, row], ids[row]], axis=1))

    def _keep(self, found: np.ndarray) -> None:
        every = np.concatenate([self.best, found])
        every = every[np.lexsort((every[:, 2], -every[:, 1], every[:, 0]))]
        rank = np.arange(len(every)) - np.searchsorted(every[:, 0], every[:, 0])
        self.best = every[rank < self.count]
        last = every[rank == self.count - 1]
        self.least[last[:, 0]] = last[:, 1]


def _started(part: dict[str, list], count: int, shares: tuple[int, int] | None) -> Walk | None:
    """The walk for the anchors of a part: without shares, for the best rows of the
    same label, or else for those of other labels within shares of known scores."""
    goals = []
    for i, known in enumerate(part["known"]):
        if shares is None:
            goals.append((i, -_MOST, _MOST))
            continue
        for score in known:
            low, high = -(-shares[0] * score // 100), shares[1] * score // 100
            # A range without a score still counts as a goal, so that they stay in order.
            goals.append((i, low if low <= high else _MOST, high))
    if not goals:
        return None
    return Walk(
        np.array(part["x"]), np.array(part["id"]), np.array(part["label"]), goals, count,
        same=shares is None,
    )


_FOUND = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("anchor", "goal", "score", "id")]
)


def _walked(batches: Iterator[pa.RecordBatch], count: int, shares) -> Iterator[pa.RecordBatch]:
    """The best rows for each anchor and goal of each unit (cluster, part, slab).

    A unit's anchors come first, then its rows by falling bound; the anchors of one
    unit and a batch of rows are held.
    """

    def results():
        if walk is not None and len(walk.best):
            goal = walk.best[:, 0]
            anchor = walk.anchor[goal]
            # goals of an anchor are numbered from 1
            number = goal - np.searchsorted(walk.anchor, anchor) + 1
            columns = walk.ids[anchor], number, walk.best[:, 1], walk.best[:, 2]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=_FOUND.names
            )

    unit, walk, part, over = None, None, None, True
    for batch in batches:
        if not batch.num_rows:
            continue
        names = [batch.column(i).to_numpy() for i in range(4)]  # the unit, and the kind
        edges = np.flatnonzero(np.any([n[1:] != n[:-1] for n in names], axis=0)) + 1
        edges = [0, *edges.tolist(), batch.num_rows]
        for begin, end in zip(edges, edges[1:]):
            rows = batch.slice(begin, end - begin)
            name = tuple(n[begin] for n in names[:3])
            if name != unit:
                yield from results()
                unit, walk, over = name, None, False
                part = {c: [] for c in ("id", "label", "x", "known")}
            if names[3][begin] == 0:
                for c in ("id", "label", "known"):
                    part[c] += rows.column(c).to_pylist()
                part["x"] += list(rows_of(rows.column("x")))
                continue
            if over:
                continue
            if walk is None:
                walk = _started(part, count, shares) if part["id"] else None
                if walk is None:
                    over = True
                    continue
            bound = rows.column("bound").to_numpy()
            ids, labels = rows.column("id").to_numpy(), rows.column("label").to_numpy()
            vectors = rows_of(rows.column("x"))
            for i in range(0, len(ids), STEP_ROWS):
                if walk.stop(bound[i]):
                    over = True
                    break
                step = slice(i, i + STEP_ROWS)
                walk.see(vectors[step], ids[step], labels[step])
    yield from results()


def _best(found: DataFrame, count: int) -> DataFrame:
    """The best rows of all slabs for each anchor and goal, with their rank."""
    order = Window.partitionBy("anchor", "goal").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= count)


def mine(
    df: DataFrame,
    every: int = 100,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    positives: int = 5,
    negatives: int = 10,
    shares: tuple[int, int] = (30, 90),
    scale: int = SCALE,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id and both scores.

    Anchors are the rows whose id ``every`` divides; their positives are the best
    other rows of their label, and the negatives of a positive the best rows of
    other labels whose scores lie within ``shares`` per cent of the positive's.
    Scores are inner products of the vectors on the grid floor(scale * entry);
    ties go by smaller id. A positive with a score below zero has no negatives.

    Rows without id or label (whole numbers), and rows that ``on_grid`` drops, take
    no part. Rows that share an id are one row, the one smallest by label, then
    vector. A table without anchors, or an empty one, gives no rows. Other columns
    do not matter.
    """
    spark = df.sparkSession
    python_ready(spark)
    source = df.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.col(f"`{label_col}`").cast("long").alias("label"),
        F.col(f"`{vector_col}`").alias("vector"),
    ).filter(F.col("id").isNotNull() & F.col("label").isNotNull())
    rows = stored(
        on_grid(source, "vector", "x", scale, grid_end=GRID_END)
        .groupBy("id").agg(F.min(F.struct("label", "x")).alias("r")).select("id", "r.label", "r.x"),
        "grid-rows",
    )
    anchors = rows.filter(F.col("id") % every == 0)
    # A bounded sample places the centres; results do not depend on them.
    sample = anchors.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ANCHORS).select("x").collect()
    columns = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not sample:
        return spark.createDataFrame([], columns)
    centres = centres_of(np.array([r["x"] for r in sample]), CLUSTERS)

    def nearest(x):
        apart = angles(rows_of(x), centres)
        cluster = np.argmin(apart, axis=1)
        return cluster, apart[np.arange(len(cluster)), cluster]

    anchors = stored(
        with_values(
            anchors.withColumn("y", F.col("x")), ["y"],
            [T.StructField("cluster", T.IntegerType()), T.StructField("angle", T.DoubleType())],
            nearest,
        ),
        "clustered-anchors",
    )
    widths, parts = np.zeros(len(centres)), [0] * len(centres)
    for c, width, n in anchors.groupBy("cluster").agg(F.max("angle"), F.count(F.lit(1))).collect():
        widths[c], parts[c] = width, -(-n // PART_ANCHORS)
    slabs = -(-rows.count() // SLAB_ROWS)

    bounded = stored(
        with_values(
            rows.withColumn("y", F.col("x")), ["y"],
            [T.StructField("bounds", T.ArrayType(T.DoubleType()))],
            lambda x: [list(bounds(rows_of(x), centres, widths))],
        ),
        "bounded-rows",
    )

    def number_of_parts(cluster):
        return F.element_at(F.array(*map(F.lit, parts)), cluster + 1)

    unit = ["cluster", "part", "slab"]
    every_part = F.explode(F.sequence(F.lit(0), number_of_parts(F.col("cluster")) - 1))
    listed = (
        bounded.select("id", "label", "x", F.posexplode("bounds").alias("cluster", "bound"))
        .filter(number_of_parts(F.col("cluster")) > 0)
        .withColumn("part", every_part)
        .withColumn("slab", F.pmod(F.xxhash64("id"), F.lit(slabs)).cast("int"))
        .select(*unit, F.lit(1).alias("kind"), "bound", "id", "label", "x",
                F.lit(None).cast("array<bigint>").alias("known"))
    )
    part = F.pmod(F.xxhash64(F.lit(1), "id"), number_of_parts(F.col("cluster"))).cast("int")

    def walk(walkers: DataFrame, count: int, shares) -> DataFrame:
        walkers = (
            walkers.withColumn("part", part)
            .withColumn("slab", F.explode(F.sequence(F.lit(0), F.lit(slabs - 1))))
            .select(*unit, F.lit(0).alias("kind"), F.lit(None).cast("double").alias("bound"),
                    "id", "label", "x", "known")
        )
        found = (
            walkers.union(listed).repartition(*unit)
            .sortWithinPartitions(*unit, "kind", F.col("bound").desc(), "id")
            .mapInArrow(lambda batches: _walked(batches, count, shares), _FOUND)
        )
        return _best(found, count)

    none = F.array().cast("array<bigint>")
    alike = stored(walk(anchors.withColumn("known", none), positives, None), "positives")
    known = alike.groupBy("anchor").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda p: p["score"])
        .alias("known")
    )
    walkers = anchors.join(known, F.col("id") == F.col("anchor")).drop("anchor")
    unlike = walk(walkers, negatives, shares)
    positive = alike.select(
        "anchor", F.col("rank").cast("long").alias("goal"), F.col("id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    return unlike.join(positive, ["anchor", "goal"]).select(
        F.col("anchor").alias("anchor_id"), "positive_id", "rank",
        F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )
