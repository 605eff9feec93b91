"""Tensor blob codec over BINARY columns, vectorised per Arrow batch.

Fixed values (byte layouts that must match existing data):

* little-endian blob: int32 rank, int32 x rank dims, 1 byte requires-grad flag, float64 x prod(dims)
* big-endian blob:    int32 rank, int32 x rank dims, int32 element count, float64 x prod(dims); no flag byte

Decoding rejects rank 0, negative dims and any length that disagrees with the header (trailing bytes too).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tablegrad.functions.arrow import column, list_to_matrix, matrix_to_list

DECODED_FIELDS = [T.StructField("shape", T.ArrayType(T.IntegerType())),
                  T.StructField("requires_grad", T.BooleanType()),
                  T.StructField("data", T.ArrayType(T.DoubleType()))]


def _header(shape, requires_grad: bool, byte_order: str) -> bytes:
    e = "<" if byte_order == "little" else ">"
    h = np.array([len(shape), *shape], dtype=e + "i4").tobytes()
    if byte_order == "little":
        return h + bytes([1 if requires_grad else 0])
    return h + np.array([int(np.prod(shape))], dtype=">i4").tobytes()


def encode_matrix(x: np.ndarray, shape, requires_grad: bool = True, byte_order: str = "little") -> pa.Array:
    """Encode every row of ``x`` (rows x prod(shape)) as one blob."""
    rows = x.shape[0]
    head = np.frombuffer(_header(shape, requires_grad, byte_order), dtype=np.uint8)
    body = np.ascontiguousarray(x, dtype="<f8" if byte_order == "little" else ">f8").view(np.uint8).reshape(rows, -1)
    full = np.concatenate([np.broadcast_to(head, (rows, head.size)), body], axis=1)
    width = full.shape[1]
    offsets = np.arange(0, (rows + 1) * width, width, dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(offsets), pa.py_buffer(full.tobytes())])


def decode_one(b: bytes, byte_order: str = "little"):
    e = "<" if byte_order == "little" else ">"
    if len(b) < 4:
        raise ValueError("blob: truncated header")
    rank = int(np.frombuffer(b[:4], dtype=e + "i4")[0])
    if rank <= 0:
        raise ValueError("blob: rank must be positive")
    dims = np.frombuffer(b[4:4 + 4 * rank], dtype=e + "i4").astype(np.int64)
    if len(dims) != rank or (dims < 0).any():
        raise ValueError("blob: bad dims")
    off = 4 + 4 * rank
    if byte_order == "little":
        flag = bool(b[off])
        off += 1
    else:
        count = int(np.frombuffer(b[off:off + 4], dtype=">i4")[0])
        if count != int(np.prod(dims)):
            raise ValueError("blob: element count disagrees with dims")
        flag = False
        off += 4
    n = int(np.prod(dims))
    if len(b) != off + 8 * n:
        raise ValueError(f"blob: expected {off + 8 * n} bytes, got {len(b)}")
    data = np.frombuffer(b[off:], dtype=e + "f8").astype(np.float64)
    return [int(d) for d in dims], flag, data


def encode(df: DataFrame, vec_col: str, shape, blob_col: str = "blob", requires_grad: bool = True,
           byte_order: str = "little") -> DataFrame:
    """Replace ``vec_col`` (ARRAY<DOUBLE>, prod(shape) values per row) by a BINARY blob column."""
    keep = [f for f in df.schema.fields if f.name != vec_col]
    schema = T.StructType(keep + [T.StructField(blob_col, T.BinaryType())])
    width = int(np.prod(shape))

    def kernel(batches):
        for batch in batches:
            x = list_to_matrix(column(batch, vec_col), width)
            cols = [column(batch, f.name) for f in keep] + [encode_matrix(x, shape, requires_grad, byte_order)]
            yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in keep] + [blob_col])

    return df.mapInArrow(kernel, schema)


def decode(df: DataFrame, blob_col: str = "blob", byte_order: str = "little") -> DataFrame:
    """BINARY blob -> (shape, requires_grad, data). Equal-length blobs with one header decode as a matrix."""
    keep = [f for f in df.schema.fields if f.name != blob_col]
    schema = T.StructType(keep + DECODED_FIELDS)

    def kernel(batches):
        for batch in batches:
            blobs = column(batch, blob_col)
            n = len(blobs)
            if n == 0:
                continue
            if blobs.null_count:
                raise ValueError("blob: null value")
            offs = np.frombuffer(blobs.buffers()[1], dtype=np.int32)[blobs.offset:blobs.offset + n + 1]
            lens = np.diff(offs)
            raw = np.frombuffer(blobs.buffers()[2], dtype=np.uint8)[offs[0]:offs[-1]]
            first = raw[:lens[0]].tobytes()
            shape, flag, data0 = decode_one(first, byte_order)
            head_len = lens[0] - 8 * data0.size
            if (lens == lens[0]).all() and (raw.reshape(n, -1)[:, :head_len] == raw[:head_len]).all():
                m = raw.reshape(n, -1)[:, head_len:].copy().view("<f8" if byte_order == "little" else ">f8")
                data = matrix_to_list(m.astype(np.float64))
                shapes = pa.array([shape] * n, pa.list_(pa.int32()))
                flags = pa.array([flag] * n, pa.bool_())
            else:
                dec = [decode_one(raw[offs[i] - offs[0]:offs[i + 1] - offs[0]].tobytes(), byte_order)
                       for i in range(n)]
                shapes = pa.array([s for s, _, _ in dec], pa.list_(pa.int32()))
                flags = pa.array([f for _, f, _ in dec], pa.bool_())
                data = pa.array([d.tolist() for _, _, d in dec], pa.list_(pa.float64()))
            cols = [column(batch, f.name) for f in keep] + [shapes, flags, data]
            yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in keep] + ["shape", "requires_grad", "data"])

    return df.mapInArrow(kernel, schema)
