"""Vectors from Arrow list columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def valid_rows(column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By dimension: row numbers and their vectors, as doubles. Rows that are null, empty or hold
    null or non-finite components are left out.
    """
    offsets = np.asarray(column.offsets)
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    starts, sizes = offsets[:-1], np.diff(offsets)
    sizes = np.where(np.asarray(column.is_valid()), sizes, 0)
    found = {}
    for size in np.unique(sizes[sizes > 0]):
        rows = np.flatnonzero(sizes == size)
        matrix = values[starts[rows][:, None] + np.arange(size)]
        finite = np.isfinite(matrix).all(axis=1)
        if finite.any():
            found[int(size)] = (rows[finite], matrix[finite] + 0.0)  # -0.0 counts as 0.0
    return found
