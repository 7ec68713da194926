"""Vector columns as numpy matrices: shared by the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(vector: str | Column) -> Column:
    """True where a vector is not null and holds neither null nor a value
    that is not finite; an empty vector is finite."""
    v = F.col(vector) if isinstance(vector, str) else vector
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return v.isNotNull() & ~F.coalesce(bad, F.lit(True))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list column as doubles; missing places are 0 and places
    from ``dims`` on are left out."""
    column = column.cast(pa.large_list(pa.float64()))
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    flat = column.values.to_numpy(zero_copy_only=False)
    size = at[1:] - at[:-1]
    if len(size) and (size == dims).all():
        return flat[at[0] : at[-1]].reshape(len(size), dims)
    out = np.zeros((len(size), dims))
    for r, (a, b) in enumerate(zip(at[:-1], np.minimum(at[1:], at[:-1] + dims), strict=True)):
        out[r, : b - a] = flat[a:b]
    return out


def lists(rows: np.ndarray) -> pa.Array:
    """A matrix as a list column."""
    n, d = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * d), pa.array(np.ascontiguousarray(rows).reshape(-1)))


def floors(x: np.ndarray) -> np.ndarray:
    """Floors as 64-bit integers; values beyond 2**61 stop there."""
    return np.clip(np.floor(x), -(2.0**61), 2.0**61).astype(np.int64)
