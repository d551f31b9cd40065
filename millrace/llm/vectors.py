"""Helpers for tables of vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(embedding: Column) -> Column:
    """False for null vectors and for vectors that hold a null, NaN or infinite
    component; never null itself."""

    def odd(e: Column) -> Column:
        x = e.cast("double")
        return e.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    return F.coalesce(~F.exists(embedding, odd), F.lit(False))


def whole_steps(embedding: Column, scale: int, shift: int = 0) -> Column:
    """floor(scale * x) + shift of each component, computed in doubles; null for
    infinite ones, so that it may be evaluated before such rows are left out."""

    def step(e: Column) -> Column:
        x = e.cast("double") * scale
        return F.floor(F.when(F.abs(x) != float("inf"), x)).cast("long") + F.lit(shift).cast("long")

    return F.transform(embedding, step)


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of an array column of one length as a matrix of longs."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dim)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows: through doubles where these are exact."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    largest = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
    if largest < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    if any(abs(int(s)) >= 2**63 for s in exact.ravel()):
        raise OverflowError("a score does not fit a long")
    return exact.astype(np.int64)
