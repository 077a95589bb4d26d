"""What the two vector operators share: rows that can take part, and columns of equal-length arrays as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(column: str) -> Column:
    """Not null, not zero, and no null or non-finite component."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(F.col(column).isNotNull() & finite & F.exists(column, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def sample(vectors: DataFrame, id_column: str, column: str, rows: int) -> np.ndarray:
    """At most `rows` vectors, those whose ids hash lowest; they alone reach the driver."""
    picked = vectors.orderBy(F.xxhash64(id_column), id_column).limit(rows).select(column)
    return matrix(picked.toArrow().column(0))


def main_length(vectors: DataFrame, column: str) -> int:
    """The most frequent vector length (ties: the larger); vectors of another length are of another space."""
    row = vectors.groupBy(F.size(column).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return row["d"] if row else 0
