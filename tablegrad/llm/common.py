"""Shared plumbing: table readers, reliable checkpoints, Arrow batches cut into pieces of bounded size."""

from __future__ import annotations

import contextlib
import ctypes
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegrad.session import scratch_path, ship_package

#: Bytes of text that one numpy step handles; a longer single text is one step of its own.
PIECE_BYTES = 1 << 20

# Arrow takes its memory from the C heap, so that what a task frees can go back to the system (``give_back``): its own pools
# keep what they had at most, for as long as the worker lives.
pa.set_memory_pool(pa.system_memory_pool())


def prepare(spark: SparkSession) -> None:
    """Ship the package; keep Arrow batches of long texts small unless the session says otherwise."""
    ship_package(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "67108864b":  # the default: held by the JVM and by Python
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":  # the default
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written as a table to the shared folder named by spark.checkpoint.dir, and read again.

    It survives the loss of executors, and unlike a checkpoint it is planned with its true size: loops of joins over
    checkpoints multiply their estimated sizes without end.
    """
    return written(df)[0]


def written(df: DataFrame) -> tuple[DataFrame, str]:
    """``checkpointed``, and the folder of the table."""
    path = scratch_path(df.sparkSession, f"llm-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def hash_share(key: Column, rows: int, most: int) -> Column:
    """True for a fixed share of the keys, chosen by hash, that holds about twice ``most`` of ``rows`` rows (all, if they
    are no more): what is sorted for an exact bound then doesn't grow with the table."""
    return F.pmod(F.xxhash64(key, F.lit(7)), F.lit(1 << 31)) < F.lit(int(min(1.0, 2 * most / max(rows, 1)) * (1 << 31)))


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty. ``offsets`` has one entry more than the rows."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("" if not pa.types.is_binary(col.type) else b"")
    col = col.cast(pa.large_string()) if not pa.types.is_large_string(col.type) else col
    off = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def give_back() -> None:
    """Return freed memory to the system: a Python worker outlives its task and stands beside the executor's heap."""
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def pieces(batches: Iterator[pa.RecordBatch], text_col: str, limit: int = PIECE_BYTES) -> Iterator[tuple]:
    """(rows of the batch, bytes, offsets) with at most ``limit`` bytes of text, or one row if that has more."""
    for batch in batches:
        if not batch.num_rows:
            continue
        raw, off = text_buffers(batch.column(batch.schema.get_field_index(text_col)))
        at, n = 0, batch.num_rows
        while at < n:
            to = max(at + 1, int(np.searchsorted(off, off[at] + limit, "right")) - 1)
            yield batch.slice(at, to - at), raw[off[at]:off[to]], off[at:to + 1] - off[at]
            at = to
    give_back()


def deflated(col: pa.Array) -> pa.Array:
    """Texts deflated to ``binary`` for shuffles: block compression hardly shrinks short texts."""
    raw, off = text_buffers(col)
    data, at = raw.tobytes(), off.tolist()
    return pa.array([zlib.compress(data[x:y], 1) for x, y in zip(at, at[1:])], pa.binary())


def inflated(batches: Iterator[pa.RecordBatch], text_col: str = "_text", rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Batches of ``deflated`` rows with their texts again, a bounded number of rows at a time."""
    for whole in batches:
        for i in range(0, whole.num_rows, rows):
            b = whole.slice(i, rows)
            text = pa.array([zlib.decompress(x) for x in column(b, text_col).to_pylist()], pa.large_binary()).cast(pa.large_string())
            yield pa.RecordBatch.from_arrays([text if c == text_col else column(b, c) for c in b.schema.names], b.schema.names)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def ints(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return column(batch, name).to_numpy(zero_copy_only=False)


def list_array(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """A list column from flat values and the length of each row."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
