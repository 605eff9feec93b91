"""Key-value sample tables: ``(row_key STRING, image BINARY, label BINARY)`` in Parquet.

The scan decodes the image blob and the big-endian int32 label, checks required columns, and one-hot encodes the
label into a sample ``(row_key, features, target)``. Writes are plain Parquet; an upsert keeps the newest version
per key (union + ``max`` of the row by version), partly summed before one shuffle by key.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegrad.functions.columns import col, one_hot
from tablegrad.sources import blobs

KEY_FORMAT = "train_%05d"  # fixed value: zero-padded to at least five digits


def row_key(i, fmt: str = KEY_FORMAT) -> Column:
    """``format_string`` keeps every digit past five (``lpad`` would truncate)."""
    return F.format_string(fmt, col(i))


def encode_be_int32(x) -> Column:
    """int -> 4-byte big-endian BINARY (two's complement)."""
    v = col(x).cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF))
    return F.unhex(F.lpad(F.hex(v), 8, "0"))


def decode_be_int32(b) -> Column:
    """4-byte big-endian BINARY -> int, handling values >= 2^31 as negatives."""
    u = F.conv(F.hex(col(b)), 16, 10).cast("bigint")
    checked = F.when(F.assert_true(F.length(col(b)) == 4, F.lit("label: expected 4 bytes")).isNull(), u)
    return F.when(checked >= F.lit(1 << 31), checked - F.lit(1 << 32)).otherwise(checked).cast("int")


def require_columns(df: DataFrame, cols=("image", "label")) -> DataFrame:
    """Fail the job on a row missing any required column (the scan's null check).

    The assertion is threaded through the required columns themselves; a separate, unused check column would be
    pruned by the optimizer and never evaluated.
    """
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    ok = F.assert_true(cond, F.lit("kv: row without image or label")).isNull()
    return df.select(*[F.when(ok, F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns])


def missing_report(df: DataFrame, cols=("image", "label")) -> DataFrame:
    """Counts of rows missing each required column, rows missing any, and total rows (mode='report')."""
    aggs = [F.sum(F.col(c).isNull().cast("long")).alias(f"missing_{c}") for c in cols]
    any_null = None
    for c in cols:
        any_null = F.col(c).isNull() if any_null is None else any_null | F.col(c).isNull()
    aggs += [F.sum(any_null.cast("long")).alias("missing_any"), F.count("*").alias("rows")]
    return df.agg(*aggs)


def scan_samples(kv: DataFrame, num_classes: int = 10, mode: str = "fail", byte_order: str = "little") -> DataFrame:
    """kv table -> ``(row_key, shape, features, target)``. ``mode``: 'fail' (null check) or 'drop'."""
    kv = kv.select("row_key", "image", "label")
    kv = require_columns(kv) if mode == "fail" else kv.dropna(subset=["image", "label"])
    dec = blobs.decode(kv.withColumnRenamed("image", "blob"), "blob", byte_order)
    return dec.select("row_key", "shape", F.col("data").alias("features"),
                      one_hot(decode_be_int32("label"), num_classes).alias("target"))


def upsert(existing: DataFrame, updates: DataFrame, key: str = "row_key", version: str = "version") -> DataFrame:
    """Newest version per key wins; keys only in ``existing`` are kept.

    ``max_by`` is an ordinary aggregate, so it is partially applied map-side: a key repeated across many rows
    collapses before the shuffle instead of landing whole in one window partition.
    """
    u = existing.unionByName(updates)
    others = [c for c in u.columns if c != key]
    # equal versions: the largest row wins, so the result doesn't depend on the order of rows
    rest = [c for c in others if c != version]
    best = u.groupBy(key).agg(F.max(F.struct(version, *rest)).alias("_b"))
    return best.select(key, *[F.col("_b")[c].alias(c) for c in others])


def write(df: DataFrame, path: str, mode: str = "append") -> None:
    """Write rows to a table folder; it is made if it isn't there."""
    df.select("row_key", "image", "label").write.mode(mode).parquet(path)


def write_batch(df: DataFrame, path: str, batch: int) -> bool:
    """Write one numbered batch so that a job that runs again leaves it once. False: it was there already.

    Rows go to a folder of this attempt; the manifest, one row a batch, names that folder and is written last. What an attempt
    that died left behind is in no manifest, and readers never see it.
    """
    spark = df.sparkSession
    if manifest(spark, path).where(F.col("batch") == batch).count():
        return False
    attempt = f"batch-{int(batch)}-{uuid.uuid4().hex}"
    df.select("row_key", "image", "label").write.parquet(f"{path}/data/{attempt}")
    row = spark.createDataFrame([(int(batch), attempt)], MANIFEST)
    # One folder a batch: of two attempts that end together the later one's name replaces the earlier one's.
    row.coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/{int(batch)}")
    return True


MANIFEST = "batch bigint, folder string"


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(batch, folder) of every batch that was written whole."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/manifest")
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    done = [str(x.getPath()) for x in fs.listStatus(where) if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(x.getPath(), "_SUCCESS"))] if fs.exists(where) else []
    return spark.read.schema(MANIFEST).parquet(*done) if done else spark.createDataFrame([], MANIFEST)


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all batches in the manifest (as many folder names come to the driver as there are batches)."""
    folders = [f"{path}/data/{r['folder']}" for r in manifest(spark, path).collect()]
    schema = "row_key string, image binary, label binary"
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("row_key string, image binary, label binary").parquet(path)
