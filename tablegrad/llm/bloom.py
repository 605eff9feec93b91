"""A Bloom filter of fixed size, built by Spark and tested in scans.

It decides which rows may take part in a join before any text is shuffled. It never loses a member; when a corpus is so
large that the filter fills up, more rows go through the exact join behind it, and the result stays the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .common import column, deflated, ints

#: log2 of the bits: 4 MB at any size of the input, also the most that the driver ever gathers and broadcasts.
LOG_BITS = 25


def _places(h: np.ndarray, log_bits: int) -> np.ndarray:
    x = T.mix(h.view(np.uint64) ^ T.U64(0x5851F42D4C957F2D))
    m = T.U64((1 << log_bits) - 1)
    return np.concatenate([x & m, (x >> T.U64(19)) & m, T.mix(x) & m])


class Bloom:
    def __init__(self, words: np.ndarray, log_bits: int):
        self.words, self.log_bits = words, log_bits

    def test(self, h: np.ndarray) -> np.ndarray:
        if not len(h):
            return np.zeros(0, bool)
        p = _places(h, self.log_bits)
        hit = (self.words[(p >> T.U64(6)).astype(np.int64)] >> (p & T.U64(63))) & T.U64(1)
        return hit.reshape(3, -1).all(0)


def build(hashes: DataFrame, col: str, log_bits: int = LOG_BITS) -> Bloom:
    """The filter of a bigint column; words are or-ed in tasks, then by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(1 << (log_bits - 6), np.uint64)
        for b in batches:
            p = _places(np.ascontiguousarray(ints(b, "_h")), log_bits)
            np.bitwise_or.at(words, (p >> T.U64(6)).astype(np.int64), T.U64(1) << (p & T.U64(63)))
        at = np.flatnonzero(words)
        for i in range(0, len(at), 1 << 16):
            part = at[i:i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(T.signed(words[part]))], ["word", "bits"])

    each = hashes.select(F.col(col).cast("bigint").alias("_h")).where("_h IS NOT NULL").mapInArrow(run, "word bigint, bits bigint")
    got = each.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(1 << (log_bits - 6), np.uint64)
    words[got["word"].to_numpy()] = got["bits"].to_numpy().view(np.uint64)
    return Bloom(words, log_bits)


def of_ids(ids: DataFrame, id_col: str, log_bits: int = LOG_BITS) -> Bloom:
    return build(ids.select(F.xxhash64(id_col).alias("_h")), "_h", log_bits)


def hashed(df: DataFrame, key: Column) -> tuple[DataFrame, str]:
    """``df`` with the hash of its key that ``kept`` tests, and that column's name."""
    name = "_hash"
    while name in df.columns:
        name += "_"
    return df.select("*", F.xxhash64(key).alias(name)), name


def kept(batches: Iterator[pa.RecordBatch], name: str, bloom: Bloom, member: bool) -> Iterator[pa.RecordBatch]:
    """The rows that may be members, or those that surely aren't, without the hash. For use inside a scan's function,
    so that a task needs no Python worker of its own for the test."""
    for b in batches:
        hit = bloom.test(np.ascontiguousarray(ints(b, name)))
        if not member:
            hit = ~hit
        if hit.any():
            yield b.filter(pa.array(hit)).select([c for c in b.schema.names if c != name])


def possible(df: DataFrame, key: Column, bloom: Bloom, member: bool = True) -> DataFrame:
    """The rows of ``df`` whose key (hashed by Spark) may be a member, or those that surely aren't one."""
    shared = df.sparkSession.sparkContext.broadcast(bloom)
    x, name = hashed(df, key)
    return x.mapInArrow(lambda batches: kept(batches, name, shared.value, member), df.schema)


def without_ids(df: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``df`` without the rows whose id is in ``ids``; only rows that the filter can't clear are shuffled."""
    ids = ids.select(id_col).distinct()
    bloom = of_ids(ids, id_col)
    return possible(df, F.col(id_col), bloom, False).unionByName(
        possible(df, F.col(id_col), bloom).join(ids, id_col, "left_anti").select(df.columns))


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows (_id, _text) of ``docs`` that may have an id of ``ids``, the text deflated, to be joined with them."""
    shared = docs.sparkSession.sparkContext.broadcast(of_ids(ids, "_id"))
    x, name = hashed(docs.select("_id", "_text"), F.col("_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in kept(batches, name, shared.value, True):
            yield pa.RecordBatch.from_arrays([column(b, "_id"), deflated(column(b, "_text"))], ["_id", "_text"])

    return x.mapInArrow(run, "_id bigint, _text binary")


def map_without_ids(docs: DataFrame, ids: DataFrame, run, schema: str) -> DataFrame:
    """``mapInArrow(run)`` over the rows (_id, _text) of ``docs`` whose id isn't in ``ids``; the test runs in the same scan."""
    ids = ids.select("_id").distinct()
    bloom = of_ids(ids, "_id")
    shared = docs.sparkSession.sparkContext.broadcast(bloom)
    x, name = hashed(docs.select("_id", "_text"), F.col("_id"))
    sure = x.mapInArrow(lambda batches: run(kept(batches, name, shared.value, False)), schema)
    rest = possible(docs.select("_id", "_text"), F.col("_id"), bloom).join(ids, "_id", "left_anti").select("_id", "_text")
    return sure.unionByName(rest.mapInArrow(run, schema))
