"""Embedding columns as numpy matrices, one Arrow batch at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def sound_vectors(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the rows whose vector is neither null nor holds a null or non-finite entry, and those vectors as float64 (rows, ``width``).

    Shorter vectors, empty ones included, are filled up with zeros.
    """
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    wrong = np.concatenate(([0], np.cumsum(~np.isfinite(flat))))
    sound = column.is_valid().to_numpy(zero_copy_only=False) & (wrong[ends] == wrong[ends - sizes])
    rows = np.flatnonzero(sound)
    if len(flat) == len(sizes) * width and (sizes == width).all():
        return rows, flat.reshape(len(sizes), width)[rows]
    out = np.zeros((len(rows), width))
    inside = np.arange(width) < sizes[rows, None]
    out[inside] = flat[np.repeat(sound, sizes)]
    return rows, out


def packed(matrix: np.ndarray) -> pa.Array:
    """Each row's bytes as one binary value."""
    raw = np.ascontiguousarray(matrix).tobytes()
    step = matrix.shape[1] * matrix.dtype.itemsize
    return pa.array([raw[i : i + step] for i in range(0, len(raw), step)] if step else [b""] * len(matrix), pa.binary())


def unpacked(column: pa.Array, dtype: type, width: int) -> np.ndarray:
    """The inverse of ``packed``: (rows, ``width``)."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=dtype).reshape(len(column), width)
