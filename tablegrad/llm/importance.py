"""Importance resampling towards a target distribution over hashed word n-grams.

Features are all runs of 1 to 3 words, hashed by CRC-32 into a fixed number of buckets. A document's weight is the sum
of its features' log ratios between the target texts and all documents; Gumbel noise that depends on the id alone turns
the largest scores into a sample without replacement.

CRC-32 is linear over XOR: the checksum of a span is a constant of its length XOR one contribution for each byte, which
depends on the byte and its distance from the end of the span. Contributions come from one position table and are folded
over all spans of a piece by ``bitwise_xor.reduceat``; spans longer than the table are folded block by block.

Spark counts the buckets (one vector of at most ``buckets`` numbers a task, summed before and after one shuffle), scores
every document in a second map, and ranks by one range exchange of the scores: a row's rank is its place in its slice
plus the rows of the slices before. Slices are cut by score, id and a number of the row, so ties and repeated rows are
dealt out as well as all others.

Defined results: a null or empty text has no features and weight 0; a null id counts as empty text in the noise and comes
after other ids in ties; repeated rows count, score and rank each on their own; an empty table gives no rows; an empty
target has no counts; other columns are never read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .common import checkpointed, column, pieces

BUCKETS = 10_000
MAX_N = 3
#: Distances from the end that the position table holds; longer spans are folded in blocks of this size.
DEPTH = 256
#: Bytes of text of one step; its spans have six times as many.
STEP = 1 << 18
_POLY = 0xEDB88320
_U32 = np.uint32


def _after_zero(reg: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Registers after one more zero byte."""
    return base[reg & _U32(255)] ^ (reg >> _U32(8))


@lru_cache(maxsize=1)
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(contribution of [distance from the end, byte], register after n zero bytes for n up to DEPTH, the four byte
    tables that put a register DEPTH bytes further)."""
    base = np.arange(256, dtype=_U32)
    for _ in range(8):
        base = np.where(base & _U32(1), (base >> _U32(1)) ^ _U32(_POLY), base >> _U32(1)).astype(_U32)
    position = np.empty((DEPTH, 256), _U32)
    position[0] = base
    for d in range(1, DEPTH):
        position[d] = _after_zero(position[d - 1], base)
    zeros = np.empty(DEPTH + 1, _U32)
    zeros[0] = 0xFFFFFFFF
    for n in range(1, DEPTH + 1):
        zeros[n] = _after_zero(zeros[n - 1:n], base)[0]
    far = (np.arange(256, dtype=_U32)[None, :] << (_U32(8) * np.arange(4, dtype=_U32))[:, None]).ravel()
    for _ in range(DEPTH):
        far = _after_zero(far, base)
    return position, zeros, far.reshape(4, 256)


def _contributions(buf: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """XOR of the byte contributions of each span of at most DEPTH bytes (no span is empty)."""
    first = np.cumsum(size) - size
    at = np.arange(int(size.sum()), dtype=np.int32)
    at += np.repeat((begin - first).astype(np.int32), size)
    index = np.repeat((begin + size - 1).astype(np.int32), size)
    index -= at
    index <<= 8
    index |= buf[at]
    return np.bitwise_xor.reduceat(tables()[0].ravel()[index], first)


def _long_crc(buf: np.ndarray, begin: int, end: int) -> int:
    """CRC-32 of one span longer than DEPTH: the blocks' contributions, then one step of DEPTH bytes a block."""
    _, zeros, far = tables()
    front = (end - begin) % DEPTH or DEPTH
    starts = np.r_[begin, np.arange(begin + front, end, DEPTH)]
    folded = np.concatenate([_contributions(buf, starts[i:i + 1024], np.diff(np.r_[starts[i:i + 1024], min(end, begin + front + (i + 1023) * DEPTH)]))
                             for i in range(0, len(starts), 1024)]).tolist()
    a, b, c, d = far.tolist()
    reg = int(zeros[front]) ^ folded[0]
    for x in folded[1:]:
        reg = a[reg & 255] ^ b[reg >> 8 & 255] ^ c[reg >> 16 & 255] ^ d[reg >> 24] ^ x
    return reg ^ 0xFFFFFFFF


def span_crc32(buf: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of the bytes in each [begin, end); spans may overlap and none is empty."""
    size = end - begin
    out = np.empty(len(begin), _U32)
    near = np.flatnonzero(size <= DEPTH)
    done = np.cumsum(size[near])
    at = 0
    while at < len(near):
        to = max(at + 1, int(np.searchsorted(done, (done[at - 1] if at else 0) + 4 * STEP, "right")))
        k = near[at:to]
        out[k] = tables()[1][size[k]] ^ _contributions(buf, begin[k], size[k]) ^ _U32(0xFFFFFFFF)
        at = to
    for i in np.flatnonzero(size > DEPTH):
        out[i] = _long_crc(buf, int(begin[i]), int(end[i]))
    return out


def joined_words(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(the words with A-Z lowered, each followed by one space; start and end of each word there; its row)."""
    raw = T.LOWER[raw]
    start, end, row = T.words(raw, off, T.NOT_ALNUM)
    if not len(start):
        return raw[:0], start, end, row
    size = end - start
    begin = np.cumsum(size + 1) - size - 1
    at = np.arange(int(begin[-1] + size[-1] + 1)) + np.repeat(start - begin, size + 1)
    buf = raw[np.minimum(at, len(raw) - 1)]
    buf[begin + size] = 32
    return buf, begin, begin + size, row


def features(raw: np.ndarray, off: np.ndarray, buckets: int, max_n: int = MAX_N) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For n = 1 to ``max_n``: (row, bucket) of every run of n words."""
    buf, begin, end, row = joined_words(raw, off)
    for n in range(1, max_n + 1):
        last = len(begin) - n + 1
        if last <= 0:
            return
        at = np.flatnonzero(row[:last] == row[n - 1:])
        yield row[at], (span_crc32(buf, begin[at], end[at + n - 1]) % _U32(buckets)).astype(np.int64)


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, text_col: str = "text") -> np.ndarray:
    """How often each bucket occurs over all texts. At most ``buckets`` rows a task, and as many to the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for _, raw, off in pieces(batches, "_text", STEP):
            for _, b in features(raw, off, buckets):
                n += np.bincount(b, minlength=buckets)
        has = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(has), pa.array(n[has])], ["bucket", "n"])

    counted = texts.select(F.col(text_col).alias("_text")).mapInArrow(run, "bucket bigint, n bigint")
    out = np.zeros(buckets, np.int64)
    for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))) of each bucket, B buckets, in doubles."""
    many, of_source, of_target = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000.0 * math.log((t + 1.0) * (of_source + many) / ((s + 1.0) * (of_target + many))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words, n_features, weight of every document."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, raw, off in pieces(batches, "_text", STEP):
            rows = part.num_rows
            n_words, n_features, weight = (np.zeros(rows, np.int64) for _ in range(3))
            for n, (row, bucket) in enumerate(features(raw, off, len(gain))):
                found = np.bincount(row, minlength=rows)
                n_words = found if n == 0 else n_words
                n_features += found
                # Sums of a piece's integers are exact in doubles.
                weight += np.bincount(row, weights=gain[bucket], minlength=rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays([column(part, "_id"), pa.array(n_words), pa.array(n_features), pa.array(weight)],
                                             ["_id", "n_words", "n_features", "weight"])

    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(
        run, f"_id {kind}, n_words bigint, n_features bigint, weight bigint").withColumnRenamed("_id", id_col)


def ranked(rows: DataFrame, wanted: str, by: list, percent: int) -> DataFrame:
    """``rows`` with ``rank``: 1, 2, 3... in the order ``by`` for the first floor(percent * N / 100) of the N rows where
    the column ``wanted`` is true, null for all others.

    One range exchange; the sorted slices are written to the shared folder with each row's slice and place, and the driver
    sees one count a slice.
    """
    spark = rows.sparkSession
    order = [F.col(wanted).desc(), *by, F.col("_row").asc()]
    numbered = checkpointed(rows.withColumn("_row", F.monotonically_increasing_id()))
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = checkpointed(numbered.repartitionByRange(slices, *order).sortWithinPartitions(*order)
                          .withColumn("_row", F.monotonically_increasing_id()))
    slice_of, place = F.shiftright("_row", 33), F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    found = placed.groupBy(slice_of.alias("_slice")).agg(F.count("*").alias("n"), F.count_if(wanted).alias("w")).orderBy("_slice").collect()
    before, total = [], 0
    for r in found:
        before.append((r["_slice"], total))
        total += r["n"]
    draw = percent * sum(r["w"] for r in found) // 100
    offsets = spark.createDataFrame(before, "_slice int, _before bigint")
    rank = F.col("_before") + place + 1
    return (placed.withColumn("_slice", slice_of.cast("int")).join(offsets, "_slice", "left")
            .withColumn("rank", F.when(F.col(wanted) & (rank <= draw), rank)).drop("_slice", "_before", "_row"))


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42, buckets: int = BUCKETS,
             id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text") -> DataFrame:
    """Every document with n_words, n_features, weight, score and rank (null if it isn't drawn)."""
    weighed = weigh(docs, gains(bucket_counts(docs, buckets, text_col), bucket_counts(target, buckets, target_text_col)), id_col, text_col)
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = weighed.withColumn("score", F.col("weight") + noise).withColumn("_drawable", F.col("n_words") >= least_words)
    return ranked(scored, "_drawable", [F.col("score").desc(), F.col(id_col).asc_nulls_last()], percent).drop("_drawable")
