"""Vector columns as numpy matrices, shared by the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """Rows whose vector is there and holds finite numbers only."""
    inf = F.lit(float("inf"))
    known = F.forall(F.col(vector).cast("array<double>"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf))
    return F.coalesce(known, F.lit(False))


def matrix(column: pa.Array, width: int | None = None, dtype=np.float64) -> np.ndarray:
    """A list column as a matrix; shorter rows are filled with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    d = max(int(lengths.max(initial=0)), width or 0)
    if len(lengths) and (lengths == d).all():
        return flat.reshape(len(lengths), d)
    out = np.zeros((len(lengths), d), dtype)
    out[np.arange(d)[None, :] < lengths[:, None]] = flat
    return out


def lists(rows: np.ndarray, kind) -> pa.Array:
    """The rows of a matrix as a list column."""
    n, d = rows.shape
    return pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * np.int32(d), pa.array(rows.ravel(), kind))
