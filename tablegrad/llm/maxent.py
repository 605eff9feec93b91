"""Language-model scoring with a hashed maximum-entropy model.

A token is predicted in two factors: the class of the next token, by a softmax over hashed n-gram and skip features of
the words before it, and the token within its class, by smoothed counts. Both factors sum to one over the training
vocabulary and one unknown event a class, so the scores are log-probabilities like those of the unigram base.

1. Every task counts the tokens of all its training texts; Spark sums them by 64-bit hash (partly summed before the
   shuffle, which grows with the vocabulary). The ``HEAD`` most frequent tokens, a fixed number, go to all tasks.
2. Units (the most frequent words; all other words by their last bytes) are counted with their frequent neighbours, and
   k-means over these fixed-size tables puts units that occur in like surroundings into one class.
3. Training: the texts are written once as sequences of units. From the same broadcast weights every task runs stochastic
   gradient steps over all its sequences; Spark averages the weights by block, weighted by tokens (``ROUNDS`` times).
4. Scoring: one scan gives the class factor of every text in sparse numpy batches. Counts of frequent tokens are at
   hand; those of rarer tokens meet their documents by a join on the hash, and sums by document finish both scores.

All tables that the driver holds have fixed sizes: HEAD rows, UNITS x NEAR counts and BUCKETS x CLASSES weights.

Defined results: null and empty texts are the end token alone; repeated rows are scored each; a null id counts as an
empty one when rows are dealt to training; an empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .common import checkpointed, column, give_back, pieces

HEAD = 1 << 17
#: Units: the most frequent tokens, then buckets of word ends for the rest.
FREQUENT, ENDS = 7168, 1024
UNITS = FREQUENT + ENDS
START = UNITS  # what stands before a text
#: The most frequent words that count as neighbours.
NEAR = 256
CLASSES = 64
BUCKETS = 1 << 14
#: Words back of each feature: bigram, trigram, and one that skips a word.
FEATURES = ((1,), (1, 2), (2,))
BATCH = 16384
ROUNDS = 1
RATE = 0.5
_FLUSH = 1 << 20
_BLOCK = 1 << 14
END = T.mix(np.array([0x656E64], np.uint64))[0]


def held_out(id_col: str, parts: int = 7, part: int = 2):
    """Rows that no model learns from."""
    return (F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % parts) == part


def _tokens(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, bucket of the last three bytes, first index of each text) of the tokens; each text ends with END."""
    start, end, row, h = T.word_hashes(raw, off, T.SPACE, T.LOWER)
    n = len(off) - 1
    at = np.arange(len(row)) + row
    out = np.full(len(row) + n, END)
    out[at] = h
    tail = np.zeros(len(out), np.uint64)
    for k in (1, 2, 3):
        has = end - k >= start
        tail[at[has]] = tail[at[has]] * T.U64(257) + T.LOWER[raw[end[has] - k]] + T.U64(1)
    words = np.bincount(row, minlength=n)
    first = np.r_[0, np.cumsum(words + 1)[:-1]]
    return out, (T.mix(tail) % T.U64(ENDS)).astype(np.int64), first


def _sum_blocks(df: DataFrame, run, size: int, parts: int = 16) -> np.ndarray:
    """Sums of float32 tables of ``size`` numbers that tasks emit in blocks; the driver gets the sums alone."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for i, v in zip(column(b, "block").to_pylist(), column(b, "v")):
                got = np.frombuffer(v.as_buffer(), "<f4").astype(np.float64)
                total[i] = total[i] + got if i in total else got
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.astype("<f8").tobytes() for v in total.values()], pa.binary())],
                                         ["block", "v"])

    out = np.zeros(size)
    for i, v in df.mapInArrow(run, "block int, v binary").repartition(parts, "block").mapInArrow(add, "block int, v binary").collect():
        got = np.frombuffer(v, "<f8")
        out[i * _BLOCK:i * _BLOCK + len(got)] = got
    return out


def _blocks(a: np.ndarray) -> Iterator[pa.RecordBatch]:
    flat = a.astype("<f4").ravel()
    found = [(i // _BLOCK, flat[i:i + _BLOCK]) for i in range(0, len(flat), _BLOCK)]
    for i in range(0, len(found), 32):
        part = [(k, v.tobytes()) for k, v in found[i:i + 32] if v.any()]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in part], pa.int32()), pa.array([v for _, v in part], pa.binary())], ["block", "v"])


def token_counts(docs: DataFrame) -> DataFrame:
    """(h, ending, c) of every distinct token of ``docs`` (_text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def out() -> pa.RecordBatch:
            h, e, c = (np.concatenate([x[i] for x in held]) for i in range(3))
            order = np.argsort(h, kind="stable")
            h, e, c = h[order], e[order], c[order]
            at = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(T.signed(h[at])), pa.array(e[at].astype(np.int32)), pa.array(np.add.reduceat(c, at))],
                                              ["h", "ending", "c"])

        for _, raw, off in pieces(batches, "_text"):
            h, e, _ = _tokens(raw, off)
            u, at, c = np.unique(h, return_index=True, return_counts=True)
            held.append((u, e[at], c))
            size += len(u)
            if size > _FLUSH:
                yield out()
                size = 0
        if held:
            yield out()

    each = docs.select("_text").mapInArrow(run, "h bigint, ending int, c bigint")
    return each.groupBy("h").agg(F.min("ending").alias("ending"), F.sum("c").alias("c"))


class Vocabulary:
    """The head: hashes in order, with counts and units. ``units`` and ``classes`` look tokens up."""

    def __init__(self, h: np.ndarray, c: np.ndarray):
        rank = np.lexsort((h, -c))
        unit = np.full(len(h), -1, np.int32)
        unit[rank[:FREQUENT]] = np.arange(min(FREQUENT, len(h)))
        order = np.argsort(h)
        self.h, self.c, self.unit = h[order], c[order], unit[order]
        self.classes = np.zeros(UNITS + 1, np.int64)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.h):
            return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
        at = np.searchsorted(self.h, h)
        at[at == len(self.h)] = 0
        return at, self.h[at] == h

    def units(self, h: np.ndarray, ending: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(unit, place in the head, whether it is there) of each token."""
        at, known = self.find(h)
        unit = FREQUENT + ending
        if len(self.h):
            own = known & (self.unit[at] >= 0)
            unit[own] = self.unit[at[own]]
        return unit, at, known


def _unit_table(docs: DataFrame, vocab) -> DataFrame:
    """(units, first): the units of some texts as uint16, and where each text begins as uint32. Written once, so that what is learned
    from sequences of units doesn't cut the texts into words again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, raw, off in pieces(batches, "_text"):
            h, e, first = _tokens(raw, off)
            u, _, _ = vocab.value.units(h, e)
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (u.astype("<u2"), first.astype("<u4"))], ["units", "first"])

    return checkpointed(docs.select("_text").mapInArrow(run, "units binary, first binary"))


def _sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(units, first index of each text) of the rows of a unit table."""
    for b in batches:
        for u, f in zip(column(b, "units"), column(b, "first")):
            yield np.frombuffer(u.as_buffer(), "<u2").astype(np.int64), np.frombuffer(f.as_buffer(), "<u4").astype(np.int64)
    give_back()


def _neighbours(units: DataFrame) -> np.ndarray:
    """UNITS x NEAR: how often a frequent word stands right before or right after a unit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(UNITS * NEAR, np.float32)
        held: list[np.ndarray] = []
        for u, first in _sequences(batches):
            inside = np.ones(max(0, len(u) - 1), bool)
            inside[first[1:] - 1] = False
            a, b = u[:-1][inside], u[1:][inside]
            for x, y in ((a, b), (b, a)):
                m = y < NEAR
                held.append((x[m] * NEAR + y[m]).astype(np.int32))
            if sum(map(len, held)) > UNITS * NEAR:
                total += np.bincount(np.concatenate(held), minlength=UNITS * NEAR)
                held.clear()
        if held:
            total += np.bincount(np.concatenate(held), minlength=UNITS * NEAR)
        yield from _blocks(total)

    return _sum_blocks(units, run, UNITS * NEAR).reshape(UNITS, NEAR)


def cluster(counts: np.ndarray, weight: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Class of each unit: weighted k-means over square roots of neighbour shares; the start is the k heaviest units."""
    x = np.sqrt((counts + 0.01) / (counts + 0.01).sum(1, keepdims=True)).astype(np.float32)
    centre = x[np.argsort(-weight, kind="stable")[:k]].copy()
    of = np.zeros(len(x), np.int64)
    for _ in range(rounds):
        of = (x @ centre.T).argmax(1)
        for j in range(k):
            m = of == j
            if m.any() and weight[m].sum() > 0:
                c = (x[m] * weight[m, None]).sum(0)
                centre[j] = c / max(np.linalg.norm(c), 1e-9)
    return of


def _contexts(unit: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Feature buckets, one column per feature and one for the bias (bucket 0)."""
    n = len(unit)
    place = np.arange(n) - np.repeat(first, np.diff(np.r_[first, n]))
    back = {0: unit}
    for k in sorted({k for f in FEATURES for k in f}):
        b = np.full(n, START, np.int64)
        b[k:] = unit[:n - k]
        b[place < k] = START
        back[k] = b
    out = np.zeros((n, len(FEATURES) + 1), np.uint16)
    for i, f in enumerate(FEATURES):
        acc = np.full(n, T.U64(i + 11))
        for k in f:
            acc = acc * T.U64(0x9E3779B97F4A7C15) + back[k].astype(np.uint64) + T.U64(1)
        out[:, i + 1] = 1 + T.mix(acc) % T.U64(BUCKETS - 1)
    return out


def _softmax(w: np.ndarray, feats: np.ndarray) -> np.ndarray:
    z = w[feats[:, 0]]
    for i in range(1, feats.shape[1]):
        z += w[feats[:, i]]
    z -= z.max(1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(1, keepdims=True)
    return z


def _log_softmax(w: np.ndarray, feats: np.ndarray) -> np.ndarray:
    z = w[feats[:, 0]]
    for i in range(1, feats.shape[1]):
        z += w[feats[:, i]]
    z -= z.max(1, keepdims=True)
    z -= np.log(np.exp(z).sum(1, keepdims=True))
    return z


def _batches(vocab: Vocabulary, raw: np.ndarray, off: np.ndarray):
    h, e, first = _tokens(raw, off)
    unit, at, known = vocab.units(h, e)
    return h, at, known, first, _contexts(unit, first), vocab.classes[unit]


def _segment_sums(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of the rows of each segment (``at``: where they begin), by adding neighbours until one row is left."""
    size = np.diff(np.r_[at, len(x)])
    while len(size) and size.max() > 1:
        begin = np.cumsum(size) - size
        place = np.arange(len(x)) - np.repeat(begin, size)
        even = (place & 1) == 0
        first = np.flatnonzero(even & (place + 1 < np.repeat(size, size)))
        x[first] += x[first + 1]
        x = x[even]
        size = (size + 1) >> 1
    return x


def _round(units: DataFrame, classes: np.ndarray, weights: np.ndarray, rate: float) -> np.ndarray:
    """One round: every task's gradient steps over its texts, averaged over tasks by tokens."""
    sent = units.sparkSession.sparkContext.broadcast(weights)
    size = BUCKETS * CLASSES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, seen = sent.value.copy(), 0
        power = np.full(BUCKETS, 1.0, np.float32)
        for unit, first in _sequences(batches):
            feats, target = _contexts(unit, first), classes[unit]
            for i in range(0, len(target), BATCH):
                f, t = feats[i:i + BATCH], target[i:i + BATCH]
                g = _softmax(w, f)
                g[np.arange(len(t)), t] -= 1
                flat = f[:, 1:].ravel()  # the bias, bucket 0 of every row, is summed by itself
                order = np.argsort(flat, kind="stable")
                key = flat[order]
                at = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
                step = np.concatenate([g.sum(0, keepdims=True), _segment_sums(g[order // (f.shape[1] - 1)], at)])
                u = np.r_[np.uint16(0), key[at]]
                power[u] += (step * step).mean(1)
                w[u] -= rate * step / np.sqrt(power[u])[:, None]
                seen += len(t)
        if seen:
            yield from _blocks(np.concatenate([w.ravel() * seen, np.full(1, seen, np.float32)]))

    total = _sum_blocks(units, run, size + 1)
    sent.unpersist()
    return (total[:size] / total[size]).reshape(BUCKETS, CLASSES).astype(np.float32) if total[size] else weights


class Model:
    """What scoring needs: the vocabulary with classes, the weights, the class totals, and the counts as a table."""

    def __init__(self, vocab: Vocabulary, weights: np.ndarray, class_log: np.ndarray, counts: DataFrame, n: int, v: int):
        self.vocab, self.weights, self.class_log, self.counts, self.n, self.v = vocab, weights, class_log, counts, n, v


def train(docs: DataFrame, text_col: str = "text", rounds: int = ROUNDS) -> Model:
    spark = docs.sparkSession
    x = docs.select(F.col(text_col).alias("_text"))
    counts = checkpointed(token_counts(x))
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    # The head holds all tokens from some count on, at most HEAD of them: a histogram of the counts (a few thousand rows
    # at most) shows from which, so nothing is sorted and no task gathers candidates.
    level = F.floor(F.log2("c") * 64).cast("int")
    room, cut = HEAD, None
    for r in sorted(counts.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect(), reverse=True):
        if r["n"] > room:
            break
        room, cut = room - r["n"], r["level"]
    head = counts.where(level >= cut if cut is not None else F.lit(False)).toArrow()
    vocab = Vocabulary(np.ascontiguousarray(head["h"].to_numpy()).view(np.uint64), head["c"].to_numpy())
    sent = spark.sparkContext.broadcast(vocab)

    # Tokens and distinct tokens of each unit: buckets of endings less the frequent words that are units of their own.
    tokens, kinds = np.zeros(UNITS), np.zeros(UNITS)
    for e, c, k in counts.groupBy("ending").agg(F.sum("c"), F.count("*")).collect():
        tokens[FREQUENT + e], kinds[FREQUENT + e] = c, k
    rank = np.lexsort((np.ascontiguousarray(head["h"].to_numpy()).view(np.uint64), -head["c"].to_numpy()))[:FREQUENT]
    for i, r in enumerate(rank.tolist()):
        e, c = head["ending"][r].as_py(), head["c"][r].as_py()
        tokens[i], kinds[i] = c, 1
        tokens[FREQUENT + e] -= c
        kinds[FREQUENT + e] -= 1

    units = _unit_table(x, sent)
    vocab.classes[:UNITS] = cluster(_neighbours(units), tokens, CLASSES - 1)
    at, known = vocab.find(np.array([END]))
    if known[0]:
        vocab.classes[vocab.unit[at[0]]] = CLASSES - 1  # the end of a text is a class of its own
    total = np.bincount(vocab.classes[:UNITS], weights=tokens + kinds, minlength=CLASSES) + 1
    sent.unpersist()
    share = np.bincount(vocab.classes[:UNITS], weights=tokens, minlength=CLASSES) + 1
    weights = np.zeros((BUCKETS, CLASSES), np.float32)
    weights[0] = np.log(share / share.sum())
    for i in range(rounds):
        weights = _round(units, vocab.classes, weights, RATE / (i + 1))
    return Model(vocab, weights, np.log10(total), counts, int(n), int(v))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, n_known, base_score and score of every document."""
    kind = docs.schema[id_col].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast((model.vocab, model.weights, model.class_log))
    names = ["row", "_id", "h", "tf", "n_tokens", "n_known", "logs", "class_score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, w, class_log = sent.value
        base = TaskContext.get().partitionId() << 36
        for rows, raw, off in pieces(batches, "_text"):
            n = rows.num_rows
            h, at, known, first, feats, target = _batches(vocab, raw, off)
            log = np.empty(len(h))
            for i in range(0, len(h), BATCH):
                t = target[i:i + BATCH]
                log[i:i + BATCH] = _log_softmax(w, feats[i:i + BATCH])[np.arange(len(t)), t]
            log = log / np.log(10) - class_log[target]
            counted = np.where(known, np.log10(vocab.c[at] + 1.0), 0.0) if len(vocab.h) else np.zeros(len(h))
            sizes = np.diff(np.r_[first, len(h)])
            of = np.repeat(np.arange(n), sizes)
            # A document's own row joins under a hash of its number with tf 0, so it adds nothing whatever it meets.
            own = T.signed(T.mix(np.arange(base, base + n).astype(np.uint64)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(base, base + n)), column(rows, "_id"), pa.array(own), pa.array(np.zeros(n, np.int64)), pa.array(sizes.astype(np.int64)),
                 pa.array(np.add.reduceat(known.astype(np.int64), first)), pa.array(np.add.reduceat(counted, first)),
                 pa.array(np.add.reduceat(log, first))], names)
            rare_row, rare = of[~known], h[~known]
            order = np.lexsort((rare, rare_row))
            rare_row, rare = rare_row[order], rare[order]
            if len(rare):
                u = np.flatnonzero(np.r_[True, (rare[1:] != rare[:-1]) | (rare_row[1:] != rare_row[:-1])])
                m = len(u)
                tf = np.diff(np.r_[u, len(rare)])
                none = pa.nulls(m, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(base + rare_row[u]), pa.nulls(m, column(rows, "_id").type), pa.array(T.signed(rare[u])), pa.array(tf.astype(np.int64)),
                     none, none, pa.nulls(m, pa.float64()), pa.nulls(m, pa.float64())], names)
            base += n

    each = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(
        run, f"row bigint, _id {kind}, h bigint, tf bigint, n_tokens bigint, n_known bigint, logs double, class_score double")
    c = F.coalesce("c", F.lit(0))
    joined = each.join(model.counts.select("h", "c"), "h", "left")
    summed = joined.groupBy("row").agg(
        F.max("_id").alias("_id"), F.sum("n_tokens").alias("n_tokens"),
        (F.sum("n_known") + F.sum(F.when(c > 0, F.col("tf")).otherwise(0))).alias("n_known"),
        (F.sum("logs") + F.sum(F.col("tf") * F.log10(c + 1.0))).alias("logs"), F.sum("class_score").alias("class_score"))
    return summed.select(F.col("_id").alias(id_col), "n_tokens", "n_known",
                         (F.col("logs") - F.col("n_tokens") * float(np.log10(model.n + model.v + 1))).alias("base_score"),
                         (F.col("logs") + F.col("class_score")).alias("score"))
