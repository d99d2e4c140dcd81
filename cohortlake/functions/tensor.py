"""Tensor scaling and flattening on array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the divisor applied to every voxel.
SCALE_DIVISOR = 255.0


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def scale_voxels(col) -> Column:
    """T1 on an ``array<float>``: each value / 255, kept as float32 (no clipping)."""
    return F.transform(_c(col), lambda x: (x.cast("double") / F.lit(SCALE_DIVISOR)).cast("float"))


def flatten_c_order(col) -> Column:
    """T2 on a nested array: row-major (last axis fastest) flattening."""
    return F.flatten(_c(col))


def nest(col, inner: int) -> Column:
    """Cut a flat array into consecutive slices of ``inner`` values."""
    c = _c(col)
    n_slices = F.ceil(F.size(c) / F.lit(inner)).cast("int")
    return F.transform(F.sequence(F.lit(0), n_slices - 1),
                       lambda i: F.slice(c, i * inner + 1, inner))
