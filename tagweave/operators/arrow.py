"""Arrow columns as numpy matrices, for kernels that run inside Spark tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def plain(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A list column of equal lengths as an (n, d) float64 matrix; a null list is a zero row.

    Vectors of different widths and null elements are errors: reshaping would mix up the rows.
    """
    column = plain(column)
    present = len(column) - column.null_count
    if present == 0:
        return np.zeros((len(column), 0))
    widths = pc.min_max(pc.list_value_length(column)).as_py()
    if widths["min"] != widths["max"]:
        raise ValueError(f"vectors have {widths['min']} to {widths['max']} dimensions")
    flat = column.flatten()
    if flat.null_count:
        raise ValueError("a vector has a null element")
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    values = values.reshape(present, -1)
    if present == len(column):
        return values
    full = np.zeros((len(column), values.shape[1]))
    full[column.is_valid().to_numpy(zero_copy_only=False)] = values
    return full


def list_column(values: np.ndarray, offsets: np.ndarray | None = None) -> pa.Array:
    """An (n, d) matrix, or flat values with offsets, as a list column of doubles."""
    if offsets is None:
        offsets = np.arange(values.shape[0] + 1) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.ravel(), pa.float64()))


def unit_rows(m: np.ndarray) -> np.ndarray:
    """Vectors along the last axis scaled to unit length; a zero vector stays zero."""
    norms = np.linalg.norm(m, axis=-1, keepdims=True)
    return np.divide(m, norms, out=np.zeros_like(m), where=norms > 0)
