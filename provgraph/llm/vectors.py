"""Vectors as whole numbers, for the operators on embeddings."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Rows that go to a Python worker at once.
VECTOR_ROWS = 4096
#: Components are held to -MOST..MOST, so that sums of products of up to 2^12 components fit in 64 bits.
MOST = 1 << 24
#: Whole numbers below this are exact in a floating-point product.
EXACT = {np.float32: 1 << 24, np.float64: 1 << 53}


def whole(vector: str) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    return F.col(vector).isNotNull() & ~F.exists(F.col(vector).cast("array<double>"), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == math.inf))


def floors(vector: str, scale: int) -> Column:
    """floor(scale * x) of every component."""
    limits = F.lit(float(-MOST)), F.lit(float(MOST))
    return F.transform(F.col(vector).cast("array<double>"), lambda x: F.floor(F.greatest(limits[0], F.least(limits[1], x * scale))).cast("int"))


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, filled up with zeros to `width`."""
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    found = np.zeros((len(sizes), width), np.int64)
    found[np.arange(width) < sizes[:, None]] = flat
    return found


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of `a` with all rows of `b` (whole numbers), exact, by the fastest numbers that hold them."""
    largest = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    for kind, limit in EXACT.items():
        if largest < limit:
            return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)
    return a @ b.T
