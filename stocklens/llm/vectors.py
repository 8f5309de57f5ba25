"""Vectors from Arrow batches, shared by exact and approximate search."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def usable(ids: pa.Array, lists: pa.Array, drop_zero: bool = False):
    """Yield ``(ids, matrix)`` per dimension for the rows that take part in a search.

    Rows without an id, null or empty vectors, and vectors that hold null, NaN or infinite
    components are left out; with ``drop_zero`` also those of zero length.
    """
    if len(ids) == 0:
        return
    flat = lists.flatten().cast(pa.float64())
    known = flat.is_valid().to_numpy(zero_copy_only=False)
    values = flat.fill_null(0.0).to_numpy(zero_copy_only=False)
    width = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    start = np.concatenate([[0], np.cumsum(width)])[:-1]
    bad = np.concatenate([[0], np.cumsum(~(known & np.isfinite(values)))])
    keep = (width > 0) & ids.is_valid().to_numpy(zero_copy_only=False) & (bad[start + width] == bad[start])
    number = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    for dim in np.unique(width[keep]):
        rows = np.flatnonzero(keep & (width == dim))
        matrix = values[start[rows][:, None] + np.arange(dim)]
        if drop_zero:
            some = matrix.any(axis=1)
            rows, matrix = rows[some], matrix[some]
        if len(rows):
            yield number[rows], matrix
