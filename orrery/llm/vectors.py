"""Columns of vectors as numpy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector is there and holds neither null nor non-finite components."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine, F.lit(False))


def matrix(vectors: pa.Array, dims: int) -> np.ndarray:
    """One row of doubles per vector; shorter vectors are padded with zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
    if (sizes == dims).all():
        return values.reshape(len(vectors), dims)
    out = np.zeros((len(vectors), dims))
    out[np.arange(dims) < sizes[:, None]] = values
    return out
