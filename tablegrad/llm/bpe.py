"""Byte-level BPE over a whole corpus: each distinct pre-token of the corpus is encoded once.

A scan cuts the texts into pre-tokens and packs chunks of some megabytes: a chunk has the list of its distinct words,
numbered, and each of its documents is the numbers of its words by position. The lists are cut into classes by a hash of the
word and meet the lists of all other chunks in one shuffle (a word that is everywhere is once in the list of each chunk),
where each distinct word is encoded once; the ids are joined back to their chunks by a second shuffle, and the documents are
reassembled by position. What is shuffled is compressed by its distribution: frequent words are small numbers, and a word
that occurs once in a chunk takes one byte. Decoding joins ids with the token-byte table, which has the vocabulary's size.

Pre-tokens are found with numpy over code points: the pattern's runs of letters, numbers, other characters and white space
are cut where the class changes, a single space goes to the run after it, and contractions are cut at their apostrophe. The
classes of code points are asked of the tokenizer library itself, so its version of Unicode decides.

Defined results: a null or empty text has no ids; repeated rows are encoded each; null and repeated document ids are carried
along; an empty table gives no rows; other columns are never read. Bytes that aren't UTF-8 count as U+FFFD, as any reader
of strings sees them. A single text longer than a chunk is a chunk of its own.
"""

from __future__ import annotations

import base64
import itertools
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .common import checkpointed, column, pieces

#: Bytes of text of one chunk: its distinct words are shuffled once, its documents by position.
CHUNK = 16 << 20
#: Bytes of text of one numpy step.
STEP = 1 << 19
#: Bytes of ids or texts of one Arrow batch that goes back to Spark.
OUT = 4 << 20
#: Distinct words that one task keeps with their ids.
CACHE = 1_000_000
LETTER, NUMBER, OTHER, BLANK = range(4)


def default_ranks() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


@lru_cache(maxsize=2)
def encoding_of(path: str):
    import tiktoken
    return tiktoken.Encoding(path, pat_str=r"[\s\S]+", mergeable_ranks=ranks_of(path), special_tokens={})


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Class of every code point, by the tokenizer library's own regular expressions."""
    import tiktoken
    plain = {bytes([i]): i for i in range(256)}
    points = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    out = np.full(0x110000, OTHER, np.uint8)
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", BLANK)):
        found = bytes(tiktoken.Encoding(pattern, pat_str=pattern, mergeable_ranks=plain, special_tokens={}).encode_ordinary(points))
        out[np.frombuffer(found.decode().encode("utf-32-le"), "<u4")] = kind
    return out


# The pattern's contractions: an apostrophe before one of these.
_ONE = np.frombuffer(b"stmd", np.uint8)
_TWO = (b"re", b"ve", b"ll")


def pre_tokens(points: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Where each pre-token begins, in code points; texts never run into each other (``off``: where they begin, then the end)."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = classes()[points]
    opens = np.zeros(n + 1, bool)
    opens[off] = True
    cut = opens[:n].copy()
    cut[1:] |= kind[1:] != kind[:-1]
    run = np.flatnonzero(cut)  # maximal runs of one class in one text
    end = np.r_[run[1:], n]
    what = kind[run]
    begins = np.zeros(n + 1, bool)
    begins[run] = True
    # White space before something else: all but its last character, then that one; a last space joins what follows.
    blank = (what == BLANK) & ~opens[end]
    last = end[blank] - 1
    joins = points[last] == 32
    begins[last] = True
    begins[end[blank][joins]] = False
    # A run of one apostrophe that begins a token and has a contraction's letters after it takes them; the rest goes on.
    quote = run[(what == OTHER) & (end - run == 1) & (points[run] == 39) & begins[run]]
    if len(quote):
        text = np.r_[points, 0, 0].astype(np.int64)
        stops = np.r_[opens[1:n + 1], True, True]  # a text ends after this code point
        a, b = text[quote + 1], text[quote + 2]
        follows = ~stops[quote]
        one = follows & np.isin(a, _ONE)
        two = np.zeros(len(quote), bool)
        for x, y in _TWO:
            two |= (a == x) & (b == y)
        two &= follows & ~stops[quote + 1]
        for at, size in ((quote[one], 1), (quote[two], 2)):
            begins[at + 1] = False
            after = at + size + 1
            # What follows begins a token: more letters do so now, anything else did before.
            begins[after] = True
            # A single space after a contraction joins the next run as before; it already begins its token.
    return np.flatnonzero(begins[:n])


def spans(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start and end of each pre-token in bytes, number of pre-tokens of each text) of many texts."""
    points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), "<u4")
    lead = np.flatnonzero((raw & 0xC0) != 0x80)  # the byte where each code point begins
    start = lead[pre_tokens(points, np.searchsorted(lead, off))]
    return start, np.r_[start, len(raw)][1:], np.diff(np.searchsorted(start, off))


def _valid(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with U+FFFD in place of bytes that aren't UTF-8 (hardly ever any)."""
    data = raw.tobytes()
    try:
        data.decode("utf-8")
        if not len(raw) or not ((raw[off[:-1][off[:-1] < len(raw)]] & 0xC0) == 0x80).any():
            return raw, off
    except UnicodeDecodeError:
        pass
    texts = [data[a:b].decode("utf-8", "replace").encode() for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    first = np.cumsum(size) - size
    return np.arange(int(size.sum())) + np.repeat(begin - first, size)


def varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, where each value's begin and the end): seven bits a byte, low ones first, the high bit set before the last."""
    v = values.astype(np.uint64)
    size = 1 + sum((v >= np.uint64(1 << 7 * k)).astype(np.int64) for k in range(1, 6))
    off = np.r_[0, np.cumsum(size)]
    out = np.empty(int(off[-1]), np.uint8)
    for k in range(int(size.max()) if len(v) else 0):
        has = np.flatnonzero(size > k)
        out[off[has] + k] = ((v[has] >> np.uint64(7 * k)) & np.uint64(127)) | (size[has] > k + 1).astype(np.uint64) << np.uint64(7)
    return out, off


def unvarints(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        return np.zeros(0, np.int64)
    last = np.flatnonzero(raw < 128)
    first = np.r_[0, last[:-1] + 1]
    place = np.arange(len(raw)) - np.repeat(first, last + 1 - first)
    return np.add.reduceat((raw & 127).astype(np.int64) << (7 * place), first)


def deflate(data: bytes, level: int = 6) -> bytes:
    """Zstandard of ``data`` after its length in eight bytes."""
    return len(data).to_bytes(8, "little") + pa.Codec("zstd", compression_level=level).compress(data, asbytes=True)


def inflate(data: bytes) -> bytes:
    return pa.Codec("zstd").decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True)


def _binaries(data: np.ndarray, off: np.ndarray) -> pa.Array:
    """A binary column from all bytes and the offsets of its rows."""
    off = off.astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(off) - 1, [None, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(data))]).cast(pa.binary())


class Chunk:
    """The pre-tokens of some megabytes of documents as numbers of distinct words.

    Words that occur twice or more are numbered by falling frequency from 0, all others by first occurrence after them. The
    stream has number + 1 of a repeated word and 0 for the next of the others, in seven-bit bytes.
    """

    def __init__(self):
        self.bytes, self.keys, self.codes, self.many, self.words, self.sizes = 0, [], [], [], [], []
        self.ids, self.counts = [], []

    def add(self, ids: pa.Array, raw: np.ndarray, off: np.ndarray) -> None:
        start, end, counts = spans(raw, off)
        key, first, code, many = np.unique(T.span_hashes(raw, start, end), return_index=True, return_inverse=True, return_counts=True)
        size = end[first] - start[first]
        self.bytes += len(raw)
        self.words.append(raw[_ranges(start[first], size)])
        for out, x in ((self.keys, key), (self.codes, code.astype(np.uint32)), (self.many, many), (self.sizes, size), (self.ids, ids), (self.counts, counts)):
            out.append(x)

    def rows(self, chunk: int, classes_of: int) -> Iterator[tuple]:
        """A row (chunk, 0, class, numbers, sizes, words, None) for each class of words, then one of all documents: (chunk, 1, -1,
        how many words are repeated and the counts of the documents, None, stream, ids)."""
        size, words = np.concatenate(self.sizes), np.concatenate(self.words)
        begin = np.cumsum(size) - size
        key, first, back = np.unique(np.concatenate(self.keys), return_index=True, return_inverse=True)
        many = np.bincount(back, weights=np.concatenate(self.many), minlength=len(key)).astype(np.int64)
        again = np.flatnonzero(many > 1)
        number = np.full(len(key), -1)
        number[again[np.argsort(-many[again], kind="stable")]] = np.arange(len(again))
        stream, pieces_at, singles = [], np.cumsum([0, *map(len, self.keys)]), 0
        for code, at in zip(self.codes, pieces_at):
            word = back[at + code.astype(np.int64)]
            new = word[many[word] == 1]
            number[new] = len(again) + singles + np.arange(len(new))
            singles += len(new)
            stream.append(varints(np.where(many[word] == 1, 0, number[word] + 1))[0].tobytes())
        # Distinct words by class and number.
        kind = (key >> np.uint64(20)).astype(np.int64) % classes_of
        order = np.lexsort((number, kind))
        kind, num, at = kind[order], number[order], first[order]
        edge = np.flatnonzero(np.r_[True, kind[1:] != kind[:-1]]) if len(kind) else np.zeros(0, np.int64)
        step = np.diff(np.r_[0, num])
        step[edge] = num[edge]
        ends = np.r_[edge, len(kind)]
        steps, step_at = varints(step)
        lens, len_at = varints(size[at])
        text = words[_ranges(begin[at], size[at])].tobytes()
        text_at = np.r_[0, np.cumsum(size[at])]
        steps, lens = steps.tobytes(), lens.tobytes()
        for i, j in zip(ends[:-1].tolist(), ends[1:].tolist()):
            yield (chunk, 0, int(kind[i]), deflate(steps[step_at[i]:step_at[j]]), deflate(lens[len_at[i]:len_at[j]]),
                   deflate(text[text_at[i]:text_at[j]]), None)
        head = varints(np.r_[len(again), np.concatenate(self.counts)])[0].tobytes()
        yield chunk, 1, -1, deflate(head), None, deflate(b"".join(stream), 9), pa.chunked_array(self.ids).to_pylist()


def _chunks(kind: str, limit: int, classes_of: int):
    """A map from (_id, _text) to the rows of chunks of about ``limit`` bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, chunk, id_type = TaskContext.get().partitionId() << 24, Chunk(), None

        def out() -> Iterator[pa.RecordBatch]:
            rows = chunk.rows(number, classes_of)
            while part := list(itertools.islice(rows, 64)):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), types)], names)

        types: list[pa.DataType] = []
        for part, raw, off in pieces(batches, "_text", STEP):
            id_type = column(part, "_id").type
            types = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(id_type)]
            raw, off = _valid(raw, off)
            if chunk.bytes and chunk.bytes + len(raw) > limit:
                yield from out()
                number, chunk = number + 1, Chunk()
            chunk.add(column(part, "_id"), raw, off)
        if chunk.ids:
            yield from out()

    names = ["chunk", "kind", "class", "numbers", "sizes", "data", "ids"]
    return run, f"chunk bigint, kind int, class int, numbers binary, sizes binary, data binary, ids array<{kind}>"


def encode_words(words: DataFrame, path: str) -> DataFrame:
    """Rows of distinct words of chunks with ``sizes`` and ``data`` of their ids instead.

    One shuffle brings all lists of a class of words together, where each distinct word is encoded once and found again by
    its bytes (a class of more than CACHE words begins anew, so memory is bounded).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, now, known = encoding_of(path), None, {}
        dtype = _id_type(path)
        for b in batches:
            sizes, data = [], []
            for kind, lens, text in zip(column(b, "class").to_pylist(), column(b, "sizes").to_pylist(), column(b, "data").to_pylist()):
                if kind != now or len(known) > CACHE:
                    now, known = kind, {}
                at = np.r_[0, np.cumsum(unvarints(inflate(lens)))].tolist()
                text = inflate(text)
                out = []
                for i, j in zip(at, at[1:]):
                    word = text[i:j]
                    ids = known.get(word)
                    if ids is None:
                        ids = known[word] = np.array(bpe._encode_single_piece(word), dtype).tobytes()
                    out.append(ids)
                sizes.append(deflate(varints(np.array([len(x) // dtype.itemsize for x in out], np.int64))[0].tobytes()))
                data.append(deflate(b"".join(out)))
            yield pa.RecordBatch.from_arrays([column(b, "chunk"), column(b, "numbers"), pa.array(sizes, pa.binary()), pa.array(data, pa.binary())],
                                             ["chunk", "numbers", "sizes", "data"])

    return words.repartition("class").sortWithinPartitions("class").mapInArrow(run, "chunk bigint, numbers binary, sizes binary, data binary")


def _id_type(path: str) -> np.dtype:
    """Two bytes an id where the vocabulary allows it."""
    return np.dtype("<u2" if max(ranks_of(path).values()) < 1 << 16 else "<u4")


def _binary_parts(col: pa.Array) -> tuple[bytes, np.ndarray]:
    """(all bytes, offsets) of a binary column without nulls."""
    col = col.cast(pa.large_binary())
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    return (memoryview(data)[off[0]:off[-1]] if data is not None else b""), off - off[0]


def _gathered(flat: np.ndarray, begin: np.ndarray, size: np.ndarray, code: np.ndarray, each: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """The values of all codes by document: (from, to, values, offsets), some megabytes at a time. ``each``: where each
    document's codes begin, then the end."""
    done = np.r_[0, np.cumsum(size[code])][each]
    at = 0
    while at < len(each) - 1:
        to = max(at + 1, int(np.searchsorted(done, done[at] + OUT // 4, "right")) - 1)
        part = code[each[at]:each[to]]
        yield at, to, flat[_ranges(begin[part], size[part])], done[at:to + 1] - done[at]
        at = to


def _reassemble(kind: str, dtype: np.dtype):
    """A map from rows in the order (chunk, kind), words' ids before documents, to (_id, ids)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held, table = None, [], None
        for b in batches:
            cols = [column(b, c).to_pylist() for c in ("chunk", "kind", "numbers", "sizes", "data")]
            ids = column(b, "ids")
            for i, (ch, what, numbers, sizes, data) in enumerate(zip(*cols)):
                if ch != chunk:
                    chunk, held, table = ch, [], None
                if what == 0:
                    held.append((np.cumsum(unvarints(inflate(numbers))), unvarints(inflate(sizes)), np.frombuffer(inflate(data), dtype)))
                    continue
                if table is None:
                    number, size, flat = (np.concatenate(x) for x in zip((np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, dtype)), *held))
                    begin, of = np.zeros(len(number), np.int64), np.zeros(len(number), np.int64)
                    begin[number], of[number] = np.cumsum(size) - size, size
                    table, held = (flat.astype("<u4"), begin, of), []
                repeated, *counts = unvarints(inflate(numbers)).tolist()
                code = unvarints(inflate(data))
                new = code == 0
                code = np.where(new, repeated - 1 + np.cumsum(new), code - 1)
                names = ids.slice(i, 1).flatten()
                for x, y, values, off in _gathered(*table, code, np.cumsum([0, *counts])):
                    yield pa.RecordBatch.from_arrays([names.slice(x, y - x), _binaries(values.view(np.uint8), 4 * off)], ["_id", "ids"])

    return run, f"_id {kind}, ids binary"


def encode(docs: DataFrame, ranks: str | None = None, id_col: str = "doc_id", text_col: str = "text",
           chunk: int = CHUNK) -> DataFrame:
    """id and ``ids`` (little-endian uint32 bytes) of every document, equal to the tokenizer's own ids of the whole text."""
    path = ranks or default_ranks()
    kind = docs.schema[id_col].dataType.simpleString()
    run, schema = _chunks(kind, chunk, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = checkpointed(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(run, schema))
    ids = encode_words(rows.where("kind = 0").select("chunk", "class", "numbers", "sizes", "data"), path)
    both = ids.withColumns({"kind": F.lit(0), "ids": F.lit(None).cast(f"array<{kind}>")}).unionByName(rows.where("kind = 1").drop("class"))
    run, schema = _reassemble(kind, _id_type(path))
    return both.repartition("chunk").sortWithinPartitions("chunk", "kind").select(
        "chunk", "kind", "numbers", "sizes", "data", "ids").mapInArrow(run, schema).withColumnRenamed("_id", id_col)


@lru_cache(maxsize=2)
def token_bytes(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The token-byte table: all bytes, and where each id's begin and how many they are (-1: no such id)."""
    ranks = ranks_of(path)
    size = np.full(max(ranks.values()) + 1, -1, np.int64)
    of = {i: t for t, i in ranks.items()}
    order = sorted(of)
    size[order] = [len(of[i]) for i in order]
    begin = np.zeros(len(size), np.int64)
    begin[order] = np.cumsum(size[order]) - size[order]
    return np.frombuffer(b"".join(of[i] for i in order), np.uint8), begin, size


def decode(encoded: DataFrame, ranks: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``encoded`` rows as id, ids and ``decoded`` (bytes). An id outside the vocabulary fails the job; null ids are none."""
    path = ranks or default_ranks()
    kind = encoded.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, begin, size = token_bytes(path)
        for b in batches:
            ids = column(b, "ids").fill_null(b"")
            data, off = _binary_parts(ids)
            code = np.frombuffer(data, "<u4")
            if len(code) and (int(code.max()) >= len(size) or (size[code] < 0).any()):
                raise ValueError("an id is outside the vocabulary")
            for x, y, values, offsets in _gathered(flat, begin, size, code, off // 4):
                yield pa.RecordBatch.from_arrays([column(b, "_id").slice(x, y - x), ids.slice(x, y - x), _binaries(values, offsets)],
                                                 ["_id", "ids", "decoded"])

    return encoded.select(F.col(id_col).alias("_id"), F.col(ids_col).alias("ids")).mapInArrow(
        run, f"_id {kind}, ids binary, decoded binary").withColumnRenamed("_id", id_col)
