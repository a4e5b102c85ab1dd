"""What the vector operators share: which vectors take part, and their numpy form."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(col: str) -> Column:
    """Whether a vector takes part: not null, not zero, without null or non-finite components."""
    x = F.col(col)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(~bad & F.exists(x, lambda v: v != 0), F.lit(False))


def countable(col: str, scale: float) -> Column:
    """Whether a vector takes part where components are made integers, floor(scale * x): not null, not empty, without null or non-finite components, and small
    enough that sums of products and squared differences are below 2^60, so that they fit a long (64 components: up to 65,000 each at a scale of 256)."""
    x = F.col(col)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    largest = F.array_max(F.transform(x, lambda v: F.abs(v.cast("double")))) * scale + 1
    return F.coalesce(~bad & (F.size(x) > 0) & (4 * F.size(x) * largest * largest < float(1 << 60)), F.lit(False))


def integers(column: pa.Array, scale: float) -> np.ndarray:
    """Rows of equal length as floor(scale * x), x as double."""
    return np.floor(scale * matrix(column))


def exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """All inner products of the rows of two matrices of integers, exactly: whatever the order of summation, no partial sum is rounded."""
    if not len(x) or not len(y):
        return np.zeros((len(x), len(y)))
    most = np.sqrt(np.einsum("ij,ij->i", x, x).max() * np.einsum("ij,ij->i", y, y).max())
    if most < 1 << 23:
        return (x.astype(np.float32) @ y.astype(np.float32).T).astype(np.float64)
    if most < 1 << 52:
        return x @ y.T
    return x.astype(np.int64) @ y.astype(np.int64).T


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as doubles."""
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1) if n else np.zeros((0, 0))


def rotations(dim: int, bits: int, seed: int) -> np.ndarray:
    """At least so many rows of random orthogonal matrices (dim columns), stacked."""
    rng = np.random.default_rng(seed)
    made = []
    while sum(map(len, made)) < bits:
        q, r = np.linalg.qr(rng.standard_normal((dim, dim)))
        made.append((q * np.sign(np.diag(r))).T)
    return np.concatenate(made)
