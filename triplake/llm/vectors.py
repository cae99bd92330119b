"""Tables of vectors on an integer grid."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from triplake.llm.common import other_columns, python_ready

#: Grid values lie below this size at most, so that they fit an int.
GRID_END = 1 << 28


def rows_of(column: pa.Array) -> np.ndarray:
    """The lists of a column, all of one length, as rows of a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def on_grid(
    df: DataFrame, vector_col: str, grid_col: str, scale: int, offset: int = 0,
    grid_end: int = GRID_END,
) -> DataFrame:
    """The vector replaced by ``grid_col``: floor(scale * entry) + offset of each entry.

    Rows whose vector is NULL or empty, or has an entry that is NULL, not finite
    or off the grid (``grid_end``), go; so do vectors of another length than most
    rows that are left have (of equally frequent lengths the largest).
    """
    kept = other_columns(df, [vector_col])
    entries = F.col(f"`{vector_col}`")
    end = grid_end - abs(offset) - 1
    fits = F.forall(
        entries, lambda c: F.coalesce(F.abs(c.cast("double")) * scale < end, F.lit(False))
    )
    rows = df.filter(entries.isNotNull() & (F.size(entries) > 0) & fits)
    # One row for each length that occurs; the first one is fetched.
    most = (
        rows.groupBy(F.size(entries).alias("size")).count()
        .orderBy(F.col("count").desc(), F.col("size").desc()).first()
    )
    rows = rows.filter(F.size(entries) == (most["size"] if most else 0))
    x = F.transform(entries, lambda c: (F.floor(c.cast("double") * scale) + offset).cast("int"))
    return rows.select(*[F.col(f"`{c}`") for c in kept], x.alias(grid_col))


def with_values(df: DataFrame, inputs: list[str], fields: list[T.StructField], compute) -> DataFrame:
    """Add columns that ``compute`` makes of whole Arrow columns, a batch at a time."""
    python_ready(df.sparkSession)
    kept = other_columns(df, [f.name for f in fields] + inputs)
    schema = T.StructType([df.schema[k] for k in kept] + fields)
    arrow = to_arrow_schema(schema)
    source = df.select(*[F.col(f"`{c}`") for c in kept + inputs])

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = compute(*[batch.column(len(kept) + i) for i in range(len(inputs))])
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).cast(arrow.field(i).type) for i in range(len(kept))]
                + [pa.array(c, arrow.field(len(kept) + i).type) for i, c in enumerate(columns)],
                schema=arrow,
            )

    return source.mapInArrow(run, schema)
