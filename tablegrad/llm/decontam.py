"""Benchmark decontamination by spaced-seed hashing.

Words are runs of ASCII letters, digits and non-ASCII bytes, with A-Z as a-z, so punctuation and layout don't matter. A
seed is a window of words hashed through a fixed mask that ignores some positions. The masks are chosen by enumeration:
every stretch of ``LEAST`` words or more (or whole item of ``SPAN`` to ``LEAST``) with a share of ``SHARE`` equal words
holds a seed of one of them, wherever the other words lie (a longer stretch has a block of 13 to 25 words with that share).
Items of fewer than ``SPAN`` words must be there whole and unchanged: their seed is the whole item. The benchmark's seeds fill a Bloom filter of fixed size that goes to
the scan of the training text; text around seeds that may match is kept as word hashes, and Spark joins the seeds
exactly, by hash. Every hit names an alignment (item, document, shift), which is verified once, word by word: the
longest stretch in which at least ``share`` of the words agree must have ``least`` words (or the whole item, if it is
shorter).

Defined results: null or empty texts and items match nothing; equal items are reported each; repeated rows give a row each only if their
ids differ; rows without an id are told apart by their texts, reported with a null id, and dropped by ``clean`` like any others; empty
tables give no rows; other columns are never read. Words are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bloom
from . import textops as T
from .common import checkpointed, column, ints, list_array, pieces

#: Fixed masks: 1 compares a word, 0 ignores it.
MASKS = ("1111011", "1110100011", "10011111", "1101000111", "11101101", "111111")
#: Items of fewer words are matched exactly.
SPAN = 10
LEAST = 13
SHARE = 0.8


def seeds(h: np.ndarray, row: np.ndarray, short: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first word, hash) of every masked window that lies in one text, and of all windows of ``short`` words."""
    places, out = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for i, m in [*enumerate(MASKS), *((len(MASKS) + n, "1" * n) for n in short)]:
        n = len(h) - len(m) + 1
        if n < 1:
            continue
        at = np.flatnonzero(row[:n] == row[len(m) - 1:])
        acc = np.full(n, T.U64(i + 1))
        for j, c in enumerate(m):
            if c == "1":
                acc *= T.U64(0x9E3779B97F4A7C15)
                acc += h[j:n + j]
        places.append(at)
        out.append(T.mix(acc[at]))
    return np.concatenate(places), np.concatenate(out)


def _words(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    _, _, row, h = T.word_hashes(raw, off, T.NOT_ALNUM, T.LOWER)
    return row, h


def benchmark_words(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, words): the word hashes of each item that has words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, off in pieces(batches, "_text"):
            row, h = _words(raw, off)
            n = np.bincount(row, minlength=rows.num_rows)
            out = pa.RecordBatch.from_arrays([column(rows, "_id"), list_array(T.signed(h), n)], ["item", "words"])
            yield out.filter(pa.array(n > 0))

    kind = items.schema[id_col].dataType.simpleString()
    return items.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(run, f"item {kind}, words array<bigint>")


def _lists(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(flat values, row of each value, offsets) of a list column."""
    off = col.offsets.to_numpy()
    flat = col.values.to_numpy(zero_copy_only=False)[off[0]:off[-1]]
    off = off - off[0]
    return flat, np.repeat(np.arange(len(col)), np.diff(off)), off


def list_seeds(df: DataFrame, keys: list[str], short: tuple[int, ...], items: bool = False, words_col: str = "words") -> DataFrame:
    """(keys, pos, seed) of the seeds of word lists; ``pos`` is relative to the list. Of ``items``, those of fewer than
    SPAN words have the seed of the whole item alone, and the others have none of ``short`` words."""
    schema = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                flat, row, off = _lists(column(part, words_col))
                h, n = flat.view(np.uint64), np.diff(off)
                if items:
                    at, s = seeds(h, row)
                    long = n[row[at]] >= SPAN
                    found = [(at[long], s[long])]
                    for k in short:
                        one = n[row] == k
                        a, s = seeds(h[one], row[one], (k,))
                        whole = len(a) - int((n == k).sum())  # the windows of k words come last, one an item
                        found.append((np.flatnonzero(one)[a[whole:]], s[whole:]))
                    at, s = (np.concatenate(x) for x in zip(*found))
                else:
                    at, s = seeds(h, row, short)
                take = pa.array(row[at])
                yield pa.RecordBatch.from_arrays([*(column(part, c).take(take) for c in keys), pa.array((at - off[row[at]]).astype(np.int64)),
                                                  pa.array(T.signed(s))], [*keys, "pos", "seed"])

    return df.select(*keys, words_col).mapInArrow(run, f"{schema}, pos bigint, seed bigint")


def _segments(docs: DataFrame, filter_: bloom.Bloom, reach: int, short: tuple[int, ...]) -> DataFrame:
    """(doc, first, words): stretches of word hashes ``reach`` words around seeds that the filter lets through."""
    kind = docs.schema["_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(filter_)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, off in pieces(batches, "_text"):
            row, h = _words(raw, off)
            at, s = seeds(h, row, short)
            hit = np.unique(at[shared.value.test(T.signed(s))])
            if not len(hit):
                continue
            begin = np.searchsorted(row, row[hit], "left")
            lo = np.maximum(hit - reach, begin)
            hi = np.minimum(hit + SPAN + reach, np.searchsorted(row, row[hit], "right"))
            new = np.r_[True, (row[hit][1:] != row[hit][:-1]) | (lo[1:] > np.maximum.accumulate(hi)[:-1])]
            s_at = np.flatnonzero(new)
            s_lo, s_hi = lo[s_at], np.maximum.reduceat(hi, s_at)
            size = s_hi - s_lo
            flat = h[np.repeat(s_lo - (np.cumsum(size) - size), size) + np.arange(size.sum())]
            yield pa.RecordBatch.from_arrays(
                [column(rows, "_id").take(pa.array(row[hit[s_at]])), pa.array((s_lo - begin[s_at]).astype(np.int64)),
                 list_array(T.signed(flat), size)], ["doc", "first", "words"])

    return docs.mapInArrow(run, f"doc {kind}, first bigint, words array<bigint>")


def longest_stretch(same: np.ndarray, share: float) -> tuple[int, int]:
    """[start, end) of the longest stretch in which at least ``share`` of the flags are true and the ends are true."""
    at = np.flatnonzero(same)
    if not len(at):
        return 0, 0
    p = np.r_[0.0, np.cumsum(np.where(same, 1 - share, -share))]
    low = np.minimum.accumulate(p)
    start = np.flatnonzero(np.r_[True, p[1:] < low[:-1]])  # only new minima can begin a longest stretch
    best, begin = 0, 0
    high = np.maximum.accumulate(p[::-1])[::-1]
    j = 0
    for i in start.tolist():
        j = max(j, i)
        while j < len(same) and high[j + 1] >= p[i] - 1e-9:
            j += 1
        if j - i > best:
            best, begin = j - i, i
    inside = at[(at >= begin) & (at < begin + best)]
    return (int(inside[0]), int(inside[-1]) + 1) if len(inside) else (0, 0)


def _named(id_col: str, text_col: str) -> Column:
    """An id that is never null: the id as text, or the text's hash where there is none."""
    return F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.concat(F.lit("?"), F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)))


def _has_null(df: DataFrame, col: str) -> bool:
    return not df.where(F.col(col).isNull()).isEmpty()


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", least: int = LEAST, share: float = SHARE) -> DataFrame:
    """One row per (document, item) with a verified overlap: its longest stretch.

    Columns: the ids, doc_start, doc_end, item_start, item_end (words, ends exclusive) and n_equal. Rows without an id are told
    apart by their texts and reported with a null id.
    """
    if not _has_null(docs, id_col) and not _has_null(items, item_col):
        return _contamination(docs, items, id_col, text_col, item_col, item_text_col, least, share)
    found = _contamination(docs.select(_named(id_col, text_col).alias(id_col), text_col), items.select(_named(item_col, item_text_col).alias(item_col), item_text_col),
                           id_col, text_col, item_col, item_text_col, least, share)
    kinds = {id_col: docs.schema[id_col].dataType, item_col: items.schema[item_col].dataType}
    back = {c: F.when(F.col(c).startswith("="), F.expr(f"substring(`{c}`, 2)")).cast(t) for c, t in kinds.items()}
    return found.withColumns(back)


def _contamination(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str, least: int, share: float) -> DataFrame:
    bench = checkpointed(benchmark_words(items, item_col, item_text_col))
    short = tuple(sorted(r[0] for r in bench.select(F.size("words")).where(F.size("words") < SPAN).distinct().collect()))
    bench_seeds = checkpointed(list_seeds(bench, ["item"], short, items=True).withColumnRenamed("pos", "item_pos"))
    reach = bench.agg(F.max(F.size("words"))).first()[0] or 0
    x = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    segments = checkpointed(_segments(x, bloom.build(bench_seeds, "seed"), int(reach), short).distinct())
    hits = list_seeds(segments, ["doc", "first"], short).join(bench_seeds, "seed")
    shifts = hits.select("doc", "first", "item", (F.col("pos") - F.col("item_pos")).alias("shift")).distinct()
    both = shifts.join(segments, ["doc", "first"]).join(bench.withColumnRenamed("words", "item_words"), "item")
    kinds = {c: both.schema[c].dataType.simpleString() for c in ("doc", "item")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dw, _, d_off = _lists(column(b, "words"))
            iw, _, i_off = _lists(column(b, "item_words"))
            rows = []
            for r, (s, first) in enumerate(zip(ints(b, "shift").tolist(), ints(b, "first").tolist())):
                d, i = dw[d_off[r]:d_off[r + 1]], iw[i_off[r]:i_off[r + 1]]
                a, z = max(0, -s), min(len(i), len(d) - s)
                if z <= a:
                    continue
                same = d[a + s:z + s] == i[a:z]
                lo, hi = longest_stretch(same, share if len(i) >= SPAN else 1.0)
                if hi - lo >= min(least, len(i)):
                    rows.append((r, first + a + s + lo, first + a + s + hi, a + lo, a + hi, int(same[lo:hi].sum())))
            cols = np.array(rows, np.int64).reshape(-1, 6).T
            take = pa.array(cols[0])
            yield pa.RecordBatch.from_arrays([column(b, "doc").take(take), column(b, "item").take(take), *map(pa.array, cols[1:])],
                                             ["doc", "item", "doc_start", "doc_end", "item_start", "item_end", "n_equal"])

    spans = both.select("doc", "first", "item", "shift", "words", "item_words").mapInArrow(
        run, f"doc {kinds['doc']}, item {kinds['item']}, doc_start bigint, doc_end bigint, item_start bigint, item_end bigint, n_equal bigint")
    best = F.max(F.struct("n_equal", (-F.col("doc_start")).alias("m"), "doc_start", "doc_end", "item_start", "item_end")).alias("x")
    return spans.groupBy("doc", "item").agg(best).select(
        F.col("doc").alias(id_col), F.col("item").alias(item_col), "x.doc_start", "x.doc_end", "x.item_start", "x.item_end", "x.n_equal")


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without those that hold a verified overlap with the benchmark; all columns as they are."""
    if not _has_null(docs, id_col):
        found = checkpointed(contamination(docs, items, id_col, text_col).select(id_col).distinct())
        return bloom.without_ids(docs, found, id_col)
    name = "_name"
    while name in docs.columns:
        name += "_"
    named = docs.withColumn(name, _named(id_col, text_col))
    found = checkpointed(contamination(named.select(name, text_col), items, name, text_col).select(name).distinct())
    return bloom.without_ids(named, found, name).drop(name)
