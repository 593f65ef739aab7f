"""Vectors as rows of bytes, and exact cosines."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def usable(vector: Column) -> Column:
    """Not null, not zero, and without null or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))


def element_type(vectors: DataFrame, column: str) -> str:
    """Numpy's name of the components: floats stay 4 bytes, all others become doubles."""
    return "<f4" if isinstance(vectors.schema[column].dataType.elementType, T.FloatType) else "<f8"


def to_matrix(lists: pa.Array, dtype: str) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(dtype).reshape(len(lists), -1) if len(lists) else np.zeros((0, 1), dtype)


def from_bytes(column: pa.Array, dtype: str) -> np.ndarray:
    """Doubles, a row for each value."""
    n = len(column)
    return np.frombuffer(b"".join(column.to_pylist()), dtype).astype(np.float64).reshape(n, -1)


def to_bytes(matrix: np.ndarray, dtype: str) -> pa.Array:
    flat = np.ascontiguousarray(matrix.astype(dtype))
    step = flat.shape[1] * flat.dtype.itemsize
    raw = flat.tobytes()
    return pa.array([raw[i : i + step] for i in range(0, len(raw), step)], pa.binary())


def norms(rows: np.ndarray) -> np.ndarray:
    return np.sqrt((rows * rows).sum(axis=1))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of a with the same row of b; equal rows give equal results wherever they stand."""
    return (a * b).sum(axis=1) / (norms(a) * norms(b))
