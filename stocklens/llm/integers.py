"""Integer vectors: floors of scaled components, exact products by split limbs, exact means."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa

#: A double holds every integer up to this one.
EXACT = 2**53


def floored(ids: pa.Array, lists: pa.Array, scale: int):
    """Yield ``(rows, matrix)`` per dimension: int64 floors of ``scale`` times the components.

    ``rows`` are places in the batch. Null vectors and those that hold null, NaN or infinite
    components are left out; a row without an id and an empty vector are not. Components so
    large that a squared distance may pass a long raise an error: no result could hold it."""
    flat = lists.flatten().cast(pa.float64())
    known = flat.is_valid().to_numpy(zero_copy_only=False)
    values = flat.fill_null(0.0).to_numpy(zero_copy_only=False)
    width = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    start = np.cumsum(width) - width
    bad = np.concatenate([[0], np.cumsum(~(known & np.isfinite(values)))])
    keep = lists.is_valid().to_numpy(zero_copy_only=False) & (bad[start + width] == bad[start])
    for dim in np.unique(width[keep]):
        rows = np.flatnonzero(keep & (width == dim))
        matrix = np.floor(scale * values[start[rows][:, None] + np.arange(dim)])
        most = float(np.abs(matrix).max(initial=0.0))
        if dim * (2.0 * most + 1.0) ** 2 >= 2.0**63:
            raise ValueError(f"components up to {most:.6g} after scaling: squared distances of {dim} of them don't fit a long")
        yield rows, matrix.astype(np.int64)


def limbs(matrix: np.ndarray, bits: int) -> list[np.ndarray]:
    """Doubles whose sum, the i-th times 2 ** (i bits), is ``matrix``: all but the last lie in
    [0, 2 ** bits), the last carries the sign and lies in +-2 ** bits."""
    out, rest = [], matrix
    while rest.size and (rest.min() < -(1 << bits) or rest.max() >= 1 << bits):
        out.append((rest & ((1 << bits) - 1)).astype(np.float64))
        rest = rest >> bits
    return [*out, rest.astype(np.float64)]


def exact_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b.T`` of int64 matrices, whose true entries fit a long.

    The integers are cut into limbs so short that every sum of limb products stays within
    2 ** 53: each pair of limbs is one matrix product of doubles without rounding, and the
    products are shifted and added in int64 (a wrapped sum comes out right in the end)."""
    inner = a.shape[1]
    bits = (53 - math.ceil(math.log2(max(inner, 2)))) // 2
    total = np.zeros((len(a), len(b)), dtype=np.int64)
    right = limbs(b, bits)
    for i, x in enumerate(limbs(a, bits)):
        for j, y in enumerate(right):
            if (i + j) * bits < 64:  # beyond that a multiple of 2 ** 64
                total += (x @ y.T).astype(np.int64) << ((i + j) * bits)
    return total


def squared_distances(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Exact squared Euclidean distances of int64 rows to int64 centres."""
    own, theirs = (rows * rows).sum(axis=1), (centres * centres).sum(axis=1)
    return own[:, None] - 2 * exact_product(rows, centres) + theirs


def floor_mean(total: int, count: int) -> int:
    return int(total) // int(count)


def long_lists(matrix: np.ndarray) -> pa.Array:
    """The rows of an int64 matrix as an Arrow array of lists."""
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.ravel()))


def list_matrix(column: pa.Array, dim: int) -> np.ndarray:
    """An Arrow column of lists of ``dim`` longs as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)
