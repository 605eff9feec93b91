"""IDX datasets (gzip; big-endian header) as a sharded Spark source and sink.

Fixed values: magic 2051 = images ``(n, rows, cols)`` of uint8, magic 2049 = labels ``(n)`` of uint8; any other
magic is an error. gzip does not split, so one file is one task; files are parsed with numpy, and records are
emitted in chunks of ``chunk_rows`` so a task never holds a whole shard as Python objects.
"""

from __future__ import annotations

import gzip
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegrad.operators.layout import checked

IMAGE_MAGIC = 2051
LABEL_MAGIC = 2049

RECORD_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("kind", T.StringType()),
    T.StructField("shard", T.StringType()), T.StructField("idx", T.LongType()),
    T.StructField("pixels", T.BinaryType()), T.StructField("label", T.IntegerType())])


def parse_idx(raw: bytes):
    """-> (kind, array). Images: (n, rows, cols) uint8; labels: (n,) uint8."""
    data = gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw
    magic = int.from_bytes(data[:4], "big")
    if magic == IMAGE_MAGIC:
        n, r, c = (int.from_bytes(data[4 + 4 * k:8 + 4 * k], "big") for k in range(3))
        arr = np.frombuffer(data, dtype=np.uint8, offset=16)
        if arr.size != n * r * c:
            raise ValueError("idx: image payload size mismatch")
        return "images", arr.reshape(n, r * c)
    if magic == LABEL_MAGIC:
        n = int.from_bytes(data[4:8], "big")
        arr = np.frombuffer(data, dtype=np.uint8, offset=8)
        if arr.size != n:
            raise ValueError("idx: label payload size mismatch")
        return "labels", arr
    raise ValueError(f"idx: unknown magic {magic}")


def encode_idx(kind: str, arr: np.ndarray, rows: int = 0, cols: int = 0) -> bytes:
    if kind == "images":
        head = b"".join(int(v).to_bytes(4, "big") for v in (IMAGE_MAGIC, arr.shape[0], rows, cols))
    else:
        head = b"".join(int(v).to_bytes(4, "big") for v in (LABEL_MAGIC, arr.shape[0]))
    return gzip.compress(head + np.ascontiguousarray(arr, dtype=np.uint8).tobytes(), mtime=0)


def shard_name(path: str) -> str:
    """Both files of a pair have one shard name: ``x-images.idx.gz``, ``train-images-idx3-ubyte.gz`` and the like."""
    base = os.path.basename(path)
    for suffix in (".gz", ".idx", "-idx3-ubyte", "-idx1-ubyte", ".idx3-ubyte", ".idx1-ubyte", "-images", "-labels"):
        base = base.replace(suffix, "")
    return base


def read_idx(spark: SparkSession, path: str, chunk_rows: int = 4096, name_filter: str = "*{idx,ubyte}*") -> DataFrame:
    """A directory of IDX files, gzip or plain, in their standard names or as shards -> one record per item."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", name_filter).load(path)
    return parse_files(files.select("path", "content"), chunk_rows)


def parse_files(files: DataFrame, chunk_rows: int = 4096) -> DataFrame:
    """``(path, content)`` rows holding IDX files -> ``(path, kind, shard, idx, pixels, label)`` records."""

    def kernel(batches):
        for batch in batches:
            paths = batch.column(0).to_pylist()
            contents = batch.column(1)
            for i, p in enumerate(paths):
                kind, arr = parse_idx(contents[i].as_py())
                sh = shard_name(p)
                for s in range(0, arr.shape[0], chunk_rows):
                    part = arr[s:s + chunk_rows]
                    n = part.shape[0]
                    if kind == "images":
                        width = part.shape[1]
                        offsets = np.arange(0, (n + 1) * width, width, dtype=np.int32)
                        pix = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets),
                                                                     pa.py_buffer(part.tobytes())])
                        lab = pa.nulls(n, pa.int32())
                    else:
                        pix = pa.nulls(n, pa.binary())
                        lab = pa.array(part.astype(np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([p] * n, pa.string()), pa.array([kind] * n, pa.string()),
                         pa.array([sh] * n, pa.string()), pa.array(np.arange(s, s + n, dtype=np.int64)), pix, lab],
                        names=[f.name for f in RECORD_SCHEMA.fields])

    return files.mapInArrow(kernel, RECORD_SCHEMA)


def pair_images_labels(records: DataFrame) -> DataFrame:
    """Positional zip of images and labels per shard: one pass, one shuffle.

    An image without a label at its position, or the reverse, fails the job (the counts differ).
    """
    r = records.groupBy("shard", "idx").agg(F.max("pixels").alias("pixels"), F.max("label").alias("label"), F.count("*").alias("_n"))
    both = F.col("pixels").isNotNull() & F.col("label").isNotNull() & (F.col("_n") == 2)
    return r.select("shard", "idx", "pixels", checked(F.col("label"), both, "idx: image / label counts differ").alias("label"))


def idx_shard_files(df: DataFrame, shard_col: str, idx_col: str, pixels_col: str, label_col: str,
                    rows: int, cols: int) -> DataFrame:
    """Encode one gzip IDX image file and one label file per shard -> ``(path, content)`` rows.

    One task per shard (shards must be bounded, e.g. ``id div shard_size``). The result is data, not a side
    effect: keep it as a Parquet table of files or copy it out with any file writer.
    """
    import pandas as pd

    def encoder(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(idx_col)
        sh = str(pdf[shard_col].iloc[0])
        img = np.stack([np.frombuffer(b, dtype=np.uint8) for b in pdf[pixels_col]])
        lab = pdf[label_col].to_numpy().astype(np.uint8)
        return pd.DataFrame({"path": [f"{sh}-images.idx.gz", f"{sh}-labels.idx.gz"],
                             "content": [encode_idx("images", img, rows, cols), encode_idx("labels", lab)]})

    return (df.select(F.col(shard_col).cast("string").alias(shard_col), idx_col, pixels_col, label_col)
            .groupBy(shard_col).applyInPandas(encoder, "path string, content binary"))
