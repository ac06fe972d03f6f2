"""What the two operators on embeddings share: usable vectors, classes of equal vectors, Arrow columns as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def usable(vec: Column) -> Column:
    """True for a vector without null or non-finite components and of a length above zero."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vec, lambda x: x != 0), F.lit(False))


def classes(vectors: DataFrame, keys: list[str], vec: str, id_col: str) -> DataFrame:
    """One row for each different vector within ``keys``: smallest id as ``class_id``, number of rows ``copies``."""
    return vectors.groupBy(*keys, vec).agg(
        F.min(id_col).alias("class_id"), F.count(F.lit(1)).alias("copies")
    )


def matrix(column: pa.ChunkedArray | pa.Array, dtype=np.float64) -> np.ndarray:
    """Equally long lists of numbers as rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):  # no chunk at all
        column = pa.array([], column.type)
    n = len(column)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    return values.reshape(n, -1) if n else np.zeros((0, 0), dtype)
