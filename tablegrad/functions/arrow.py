"""Arrow <-> numpy conversions used inside ``mapInArrow`` tasks (vectorised, one batch at a time)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def list_to_matrix(arr: pa.Array, width: int | None = None) -> np.ndarray:
    """A list<double> Arrow column with equal-length rows as an ``[rows, width]`` float64 matrix."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    n = len(arr)
    if n == 0:
        return np.zeros((0, width or 0), dtype=np.float64)
    offsets = arr.offsets.to_numpy()
    lengths = np.diff(offsets)
    w = int(lengths[0]) if width is None else width
    if (lengths != w).any():
        raise ValueError(f"ragged tensor rows: expected width {w}")
    vals = arr.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return vals.reshape(n, w)


def matrix_to_list(m: np.ndarray) -> pa.Array:
    m = np.ascontiguousarray(m, dtype=np.float64)
    rows, width = m.shape
    offsets = pa.array(np.arange(0, (rows + 1) * width, width, dtype=np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(m.ravel()))


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
