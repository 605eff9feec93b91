"""Sum-of-squares online packing of tokenised documents into windows of at most ``capacity`` tokens.

Each task packs the documents of its own input split in one pass, with no shuffle and no state that grows: a document's
full windows become sequences of their own, and its rest goes to the fill level that minimises the sum of squared
counts of partially filled windows, tracked in one array of levels (a new window is the level 0). Documents may be cut,
so at the end of a task (or when very many windows are open) the open windows are merged: the emptiest are cut up to
fill the fullest. What is left at the end, less than one window a task, is cut into powers of two, which need no padding.

A task numbers its sequences from its partition, so a task that runs again after the loss of an executor gives the
same rows. Tokens of a whitespace-parted word don't depend on its neighbours (the vocabulary's pieces never cross white
space), so tasks keep a bounded cache from words to ids.

Defined results: a null or empty text is the end token alone; repeated rows are packed each; an empty table gives no
rows; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .common import column, give_back, pieces

CAPACITY = 4096
END_ID = 2
#: Units that a Python worker's cache may hold (about 40 bytes each).
CACHE = 1_000_000
#: Open windows a task holds before it merges them (their ids are held too: 16 kB each at most).
MAX_OPEN = 1024
OUT_BYTES = 4 << 20


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


# Byte classes of the vocabulary's cutting rule: white space, letters, single digits, other characters.
_CLASS = np.full(256, 3, np.uint8)
_CLASS[T.SPACE] = 0
_CLASS[~T.NOT_LETTER] = 1
_CLASS[48:58] = 2
#: Bytes that make the tokenizer see a word as a whole: apostrophes (contractions), controls, and characters beyond
#: U+00FF or of no letter case; bytes of U+00C0 to U+00FF are cleared again below.
_ODD = np.zeros(256, bool)
_ODD[[39, 127, *range(9), *range(14, 32), *range(128, 256)]] = True


class WordTokens:
    """Ids of texts as little-endian uint32, equal to the tokenizer's own ids of the whole text.

    Words of plain characters are cut by the vocabulary's rule, all others are kept whole; each distinct unit is
    encoded once and found again by a 64-bit hash of its bytes, for all units of a piece at once.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers
        self.path, self.whole = path, None  # the tokenizer as it is, loaded when a word needs it
        self.single = Tokenizer.from_file(path)
        self.single.normalizer = None
        self.single.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.single.get_vocab()
        self.last = np.zeros(max(vocab.values()) + 1, bool)
        self.last[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.key, self.begin, self.size, self.flat = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    @staticmethod
    def units(raw: np.ndarray, off: np.ndarray) -> tuple:
        """(bytes as they are hashed, start, end, row, whole) of each unit; ``whole``: a word the tokenizer cuts."""
        ws, we, wrow = T.words(raw, off)
        if not len(ws):
            return raw, ws, we, wrow, np.zeros(0, bool)
        after = np.zeros(len(raw), bool)  # second byte of U+00C0 to U+00FF
        after[1:] = raw[:-1] == 0xC3
        odd = _ODD[raw]
        odd &= ~(after & (raw != 0x97) & (raw != 0xB7))
        odd[raw == 0xC3] = False
        odd[:-1] |= (raw[:-1] == 60) & (raw[1:] == 124)
        whole = np.logical_or.reduceat(odd, ws) if len(ws) else np.zeros(0, bool)
        cls = _CLASS[raw]
        cut = np.zeros(len(raw), bool)
        cut[1:] = (cls[1:] != cls[:-1]) | (cls[1:] == 2)
        cut &= cls != 0
        if whole.any():
            for i in np.flatnonzero(whole):
                cut[ws[i]:we[i]] = False
        cut[ws] = True
        start = np.flatnonzero(cut)
        opens = np.zeros(len(raw), bool)
        opens[ws] = True
        of = np.cumsum(opens[start]) - 1
        low = T.LOWER[raw]
        low[after & (raw < 0x9F) & (raw >= 0x80)] += 32
        for i in np.flatnonzero(whole):
            low[ws[i]:we[i]] = raw[ws[i]:we[i]]
        end = np.r_[start[1:], 0]
        final = np.r_[of[1:] != of[:-1], True]
        end[final] = we[of[final]]
        return low, start, end, wrow[of], whole[of]

    def _encode(self, data: bytes, start: list[int], end: list[int], which: np.ndarray) -> np.ndarray:
        text = b" ".join([data[start[i]:end[i]] for i in which]).decode()
        return np.array(self.single.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _learn(self, data: bytes, start: list[int], end: list[int], whole: np.ndarray, key: np.ndarray) -> None:
        size = np.zeros(len(key), np.int64)
        found: list[np.ndarray] = []
        plain, odd = np.flatnonzero(~whole), np.flatnonzero(whole)
        if len(plain):
            ids = np.concatenate([self._encode(data, start, end, plain[i:i + 8192]) for i in range(0, len(plain), 8192)])
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) != len(plain):
                raise ValueError("the tokenizer doesn't end words as expected")
            size[plain] = np.diff(np.r_[0, ends])
            found.append(ids)
        if len(odd):
            if self.whole is None:
                from tokenizers import Tokenizer
                self.whole = Tokenizer.from_file(self.path)
            got = self.whole.encode_batch_fast([data[start[i]:end[i]].decode() for i in odd], add_special_tokens=False)
            size[odd] = [len(e.ids) for e in got]
            found.append(np.array([x for e in got for x in e.ids], np.uint32))
        order = np.r_[plain, odd].astype(np.int64)
        begin = np.zeros(len(key), np.int64)
        begin[order] = len(self.flat) + np.r_[0, np.cumsum(size[order])[:-1]]
        self.flat = np.concatenate([self.flat, *found])
        at = np.searchsorted(self.key, key)
        self.key, self.begin, self.size = np.insert(self.key, at, key), np.insert(self.begin, at, begin), np.insert(self.size, at, size)

    def _find(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, key)
        has = at < len(self.key)
        has[has] = self.key[at[has]] == key[has]
        return at, has

    def encode(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, number of ids of each text)."""
        n = len(off) - 1
        low, start, end, row, whole = self.units(raw, off)
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(n, np.int64)
        key, first, inverse = np.unique(T.span_hashes(low, start, end), return_index=True, return_inverse=True)
        at, has = self._find(key)
        if not has.all():
            if len(self.key) + np.count_nonzero(~has) > CACHE:  # keep what this piece uses: frequent units are everywhere
                keep = at[has]
                size = self.size[keep]
                self.flat = self.flat[_ranges(self.begin[keep], size)]
                self.key, self.begin, self.size = self.key[keep], np.r_[0, np.cumsum(size)[:-1]].astype(np.int64)[:len(keep)], size
            new = first[~has]
            self._learn(low.tobytes(), start[new].tolist(), end[new].tolist(), whole[new], key[~has])
            at, _ = self._find(key)
        size = self.size[at][inverse]
        lengths = np.bincount(row, weights=size, minlength=n).astype(np.int64)
        return self.flat[_ranges(self.begin[at][inverse], size)], lengths


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... size[0] of them, then the same for the next."""
    total = int(size.sum())
    return np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(total)


@lru_cache(maxsize=2)
def tokens_of(path: str) -> WordTokens:
    return WordTokens(path)


class Packer:
    """The windows of one task. ``emit`` gets (sequence, [piece, ...]) for each finished window.

    A piece is (key, start, length, total, ids); ids are bytes of 4 per token.
    """

    def __init__(self, emit, capacity: int = CAPACITY, max_open: int = MAX_OPEN):
        self.emit, self.capacity, self.max_open = emit, capacity, max_open
        self.levels = np.zeros(capacity + 1, np.int64)  # open windows at each fill
        self.at: dict[int, list[list[tuple]]] = {}  # fill -> windows
        self.open = 0

    def _best(self, size: int) -> int:
        """The fill level (0: a new window) whose use minimises the sum of squared counts; fuller first on ties."""
        n, top = self.levels, self.capacity - size
        here, there = n[1:top + 1], n[1 + size:]
        change = 2 * (there - here) + 2
        if top >= 1:
            change[-1] -= 1  # a full window leaves the count
        change[here == 0] = np.iinfo(np.int64).max
        best = len(change) - int(np.argmin(change[::-1])) if len(change) else 0
        return best if best and change[best - 1] <= 2 * n[size] + 1 else 0

    def _put(self, fill: int, window: list[tuple]) -> None:
        if fill == self.capacity:
            self.emit(window)
            return
        self.levels[fill] += 1
        self.at.setdefault(fill, []).append(window)
        self.open += 1

    def add(self, key: int, ids: bytes) -> None:
        total, at, cap = len(ids) // 4, 0, self.capacity
        while total - at >= cap:
            self.emit([(key, at, cap, total, ids[4 * at:4 * (at + cap)])])
            at += cap
        if at == total:
            return
        size = total - at
        fill = self._best(size)
        window = []
        if fill:
            window = self.at[fill].pop()
            self.levels[fill] -= 1
            self.open -= 1
        window.append((key, at, size, total, ids[4 * at:]))
        self._put(fill + size, window)
        if self.open > self.max_open:
            self.merge()

    def merge(self) -> None:
        """Fill the fullest open windows by cutting up the emptiest; at most one stays open."""
        windows = [(f, w) for f in sorted(self.at, reverse=True) for w in self.at[f]]
        self.levels[:] = 0
        self.at, self.open = {}, 0
        lo, hi, spare = 0, len(windows) - 1, []
        while lo < hi or (lo == hi and spare):
            fill, w = windows[lo]
            lo += 1
            while fill < self.capacity and (spare or lo <= hi):
                if not spare:
                    spare = windows[hi][1][::-1]
                    hi -= 1
                key, start, length, total, ids = spare.pop()
                take = min(length, self.capacity - fill)
                w.append((key, start, take, total, ids[:4 * take]))
                fill += take
                if take < length:
                    spare.append((key, start + take, length - take, total, ids[4 * take:]))
            self._put(fill, w)
        if lo == hi:
            self._put(*windows[lo])
        elif spare:
            self._put(sum(p[2] for p in spare), spare[::-1])

    def close(self) -> None:
        """Merge, then cut what is left into powers of two."""
        self.merge()
        for ws in self.at.values():
            for w in ws:
                rest = w[::-1]
                left = sum(p[2] for p in w)
                while left:
                    size = 1 << (left.bit_length() - 1)
                    left -= size
                    out = []
                    while size:
                        key, start, length, total, ids = rest.pop()
                        take = min(length, size)
                        out.append((key, start, take, total, ids[:4 * take]))
                        size -= take
                        if take < length:
                            rest.append((key, start + take, length - take, total, ids[4 * take:]))
                    self.emit(out)
        self.levels[:] = 0
        self.at, self.open = {}, 0


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per piece: id, start, length, doc_tokens, sequence_id, offset and ids (little-endian uint32 bytes)."""
    kind = docs.schema[id_col].dataType.simpleString()
    path = tokenizer or default_tokenizer()
    end = np.array([END_ID], "<u4").tobytes()
    names = ["_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokens_of(path)
        sequence = TaskContext.get().partitionId() << 40
        rows, held = [], 0

        def emit(window: list[tuple]) -> None:
            nonlocal sequence, held
            at = 0
            for key, start, length, total, ids in window:
                rows.append((key, start, length, total, sequence, at, ids))
                at += length
                held += len(ids)
            sequence += 1

        def out() -> pa.RecordBatch:
            nonlocal held
            cols = list(zip(*rows))
            rows.clear()
            held = 0
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], id_type), *(pa.array(c, pa.int64()) for c in cols[1:6]), pa.array(cols[6], pa.binary())], names)

        packer, id_type = Packer(emit, capacity), None
        for part, raw, off in pieces(batches, "_text"):
            id_type = column(part, "_id").type
            ids, lengths = tok.encode(raw, off)
            data, at = ids.astype("<u4").tobytes(), 0
            for key, n in zip(column(part, "_id").to_pylist(), (4 * lengths).tolist()):
                packer.add(key, data[at:at + n] + end)
                at += n
                if held >= OUT_BYTES:
                    yield out()
        packer.close()
        if rows:
            yield out()
        # A worker lives on for other stages: what it knows of the vocabulary takes more memory than all else here.
        tok = packer = None
        tokens_of.cache_clear()
        give_back()

    out = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(
        run, f"_id {kind}, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary")
    return out.withColumnRenamed("_id", id_col)
