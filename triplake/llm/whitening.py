"""Whitening of embeddings by spectral divide and conquer.

The covariance of the distinct grid vectors is summed in Spark. Its eigenvectors
come from polar decompositions: the polar factor of V - s I has the eigenvalues
+1 and -1, so half of its sum with I projects on the eigenvectors of eigenvalues
above s. Bases of the projector's range and of the rest split V into two smaller
blocks, and so on until a block is a number or a multiple of I. The polar factor
is found by dynamically weighted Halley iterations, each by a QR decomposition
(QDWH); six are enough for any matrix whose condition fits double precision.

Only matrices of dimension x dimension come together; the vectors stay spread.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triplake.llm.common import other_columns, python_ready, stored, unused
from triplake.llm.vectors import GRID_END, on_grid, rows_of, with_values

#: Grid steps of one unit, and what is added to each entry.
SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
_EPS = np.finfo(float).eps


def polar_factor(a: np.ndarray, rounds: int = 30) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, by QDWH."""
    size = len(a)
    scale = np.linalg.norm(a)
    x = a / scale
    # A lower bound of the smallest singular value, or what rounding leaves of it.
    try:
        low = 1 / np.linalg.norm(np.linalg.inv(x))
    except np.linalg.LinAlgError:
        low = _EPS
    low = min(max(low, _EPS), 1.0)
    for _ in range(rounds):
        square = low * low
        d = (4 * (1 - square) / (square * square)) ** (1 / 3)
        root = np.sqrt(1 + d)
        weight = root + np.sqrt(max(8 - 4 * d + 8 * (2 - square) / (square * root), 0)) / 2
        b = (weight - 1) ** 2 / 4
        c = weight + b - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(c) * x, np.eye(size)]))
        new = b / c * x + (weight - b / c) / np.sqrt(c) * (q[:size] @ q[size:].T)
        new = (new + new.T) / 2
        low = min(low * (weight + b * square) / (1 + c * square), 1.0)
        moved = np.linalg.norm(new - x)
        x = new
        if abs(1 - low) < 10 * _EPS and moved < (10 * _EPS) ** (1 / 3) * np.linalg.norm(new):
            break
    return x


def _split(a: np.ndarray) -> tuple[np.ndarray, int] | None:
    """An orthogonal basis whose first columns span an invariant subspace, and how
    many these are; None when all eigenvalues are alike."""
    size = len(a)
    centre = np.trace(a) / size
    spread = np.linalg.norm(a - centre * np.eye(size)) / np.sqrt(size)
    if spread <= _EPS * size * np.linalg.norm(a):
        return None
    best = None
    # Eigenvalues lie on both sides of their mean. It may be one of them, though,
    # where the polar factor is not defined; then a shift beside it is tried.
    for step in (0.0, 0.11, -0.13, 0.37, -0.41, 0.71, -0.73):
        factor = polar_factor(a - (centre + step * spread) * np.eye(size))
        projector = (factor + np.eye(size)) / 2
        rank = round(float(np.trace(projector)))
        if not 0 < rank < size:
            continue
        # The columns of a projector span its range; the longest come first.
        order = np.argsort(-np.linalg.norm(projector, axis=0), kind="stable")
        start = projector[:, order]
        basis = _range_basis(start, rank)
        rest = np.linalg.norm(basis[:, rank:].T @ a @ basis[:, :rank])
        if best is None or rest < best[0]:
            best = rest, basis, rank
        if rest <= 20 * _EPS * size * np.linalg.norm(a):
            break
    return None if best is None else best[1:]


def _range_basis(projector: np.ndarray, rank: int) -> np.ndarray:
    """A full orthogonal basis, the range of a projector of that rank first."""
    left, chosen = projector.copy(), []
    for _ in range(rank):  # pivoted: the longest remaining column each time
        lengths = np.linalg.norm(left, axis=0)
        at = int(np.argmax(lengths))
        unit = left[:, at] / lengths[at]
        chosen.append(at)
        left -= np.outer(unit, unit @ left)
    q, _ = np.linalg.qr(projector[:, chosen], mode="complete")
    return q


def spectrum(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix, falling, and unit eigenvectors as columns."""
    size = len(a)
    values, vectors = np.zeros(size), np.zeros((size, size))
    blocks, done = [(np.eye(size), a)], 0
    while blocks:
        basis, block = blocks.pop()
        found = _split(block) if len(block) > 1 else None
        if found is None:
            for k in range(len(block)):
                vectors[:, done] = basis[:, k]
                values[done] = block[k, k]
                done += 1
            continue
        q, rank = found
        for part in (q[:, :rank], q[:, rank:]):
            inner = part.T @ block @ part
            blocks.append((basis @ part, (inner + inner.T) / 2))
    # Rounding of the splits is taken out once more.
    vectors, _ = np.linalg.qr(vectors)
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


def _summed(df: DataFrame, width: int, products) -> np.ndarray:
    """The sum of products.T @ products over all rows, a matrix per task combined
    in Spark; ``products`` makes the rows of a matrix from those of the only column."""
    python_ready(df.sparkSession)

    def run(batches):
        total = np.zeros((width, width))
        for batch in batches:
            if batch.num_rows:
                rows = products(rows_of(batch.column(0)))
                total += rows.T @ rows
        for i in range(width):
            yield pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int32()), pa.array([total[i]], pa.list_(pa.float64()))],
                names=["i", "row"],
            )

    parts = df.mapInArrow(run, "i int, row array<double>")
    sums = parts.groupBy("i").agg(*[F.sum(F.get("row", F.lit(j))).alias(f"s{j}") for j in range(width)])
    out = np.zeros((width, width))
    for r in sums.collect():
        out[r["i"]] = r[1:]
    return out


def whiten(
    df: DataFrame,
    vector_col: str = "embedding",
    components: int = COMPONENTS,
    scale: int = SCALE,
    offset: int = OFFSET,
) -> DataFrame:
    """Rows with ``whitened``, an entry for each of the first components.

    Other added columns: ``n`` (distinct vectors), ``deviation`` (see below),
    ``explained`` (each component's share of the variance) and ``identity_error``
    (largest entry of the whitened covariance minus the identity). The deviation
    is the sum over dimensions of (n x - S)^2, with S the sums over the distinct
    vectors; NULL when it exceeds a long.

    Vectors are taken on the grid, see ``on_grid``; rows that cannot be go. Equal
    vectors count once in the fit, and each row is whitened. A component without
    variance (none that stands out of rounding) has whitened entries NULL and no
    part in the identity error; where nothing varies, as with a single vector, all
    shares are NULL too. An empty table gives no rows. Ids do not matter, NULL or
    repeated. The vector goes, and columns named like results are replaced.
    """
    names = ["whitened", "n", "deviation", "explained", "identity_error"]
    others = [c for c in other_columns(df, names) if c != vector_col]
    grid = unused("grid", others)
    source = df.select(*[F.col(f"`{c}`") for c in [*others, vector_col]])
    rows = stored(on_grid(source, vector_col, grid, scale, offset), "grid-vectors")
    distinct = stored(rows.select(grid).distinct(), "distinct-vectors")
    first = distinct.limit(1).collect()
    width = len(first[0][0]) if first else 0
    fit = distinct.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.get(grid, F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)],
    ).first()
    n, sums = fit["n"], np.array([int(s) for s in fit[1:]], object)

    def scaled_offsets(x: np.ndarray) -> np.ndarray:
        """n x - S, exact."""
        if 2 * n * GRID_END < 1 << 62:
            return x.astype(np.int64) * n - sums.astype(np.int64)
        return x.astype(object) * n - sums

    def centred(x: np.ndarray) -> np.ndarray:
        return scaled_offsets(x).astype(float) / n

    shown, count, total = min(components, width), 0, 0.0
    loads, shares, error = np.zeros((width, 0)), [None] * shown, 0.0
    if width:
        covariance = _summed(distinct, width, centred) / n
        values, vectors = spectrum(covariance)
        total = float(np.trace(covariance))
        count = int(np.sum(values[:shown] > 16 * _EPS * width * total))
    if count:
        loads = vectors[:, :count] / np.sqrt(values[:count])
        shares = [max(float(v / total), 0.0) for v in values[:shown]]
        white = _summed(distinct, count, lambda x: centred(x) @ loads) / n
        error = float(np.abs(white - np.eye(count)).max())

    def compute(column):
        offsets = scaled_offsets(rows_of(column))
        if offsets.dtype != object and np.abs(offsets).max() ** 2.0 * width < 2**62:
            deviation = (offsets * offsets).sum(axis=1).tolist()
        else:
            exact = (offsets.astype(object) ** 2).sum(axis=1)
            deviation = [v if v < 1 << 63 else None for v in exact]
        projected = ((offsets.astype(float) / n) @ loads).tolist()
        return [p + [None] * (shown - count) for p in projected], deviation

    fields = [
        T.StructField("whitened", T.ArrayType(T.DoubleType())),
        T.StructField("deviation", T.LongType()),
    ]
    return with_values(rows, [grid], fields, compute).withColumns(
        {
            "n": F.lit(n).cast("long"),
            "explained": F.array(*map(F.lit, shares)).cast("array<double>"),
            "identity_error": F.lit(error),
        }
    )
