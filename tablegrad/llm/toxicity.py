"""Toxicity scores: gradient-boosted trees over dense text features, with isotonic calibration.

Labelled rows outside the held-out fold have three roles by the fold of their id. Folds 1 to 3 give words that tell toxic
documents from others by their smoothed log-odds, however few documents a language has (they join the fixed word list). Folds 2
and 3 fit the trees, each by words learned without it; fold 4 calibrates. Each role uses at most ``MAX_ROWS`` rows, those with the smallest id hashes, so the driver holds a bounded sample however many labels there
are. Scoring is one map over the scan: no shuffle, whole texts, memory bounded by one piece.

Labels, language, source and id are never inputs of a score. Defined results: a null or empty text has the features of
an empty text and gets their score; repeated rows get equal scores; without labels the score is that of the prior; an
empty table gives no rows; other columns are never read. Several labels of one id count as toxic if any is 1.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import gbt
from . import textops as T
from .common import column, hash_share, ints, pieces

#: Bound on the labelled rows of each role.
MAX_ROWS = 12_000
#: Fold of an id: crc32 of its text modulo 5; 0 is held out.
FOLDS = {"words": (1, 2, 3), "trees": (2, 3), "calibration": (4,)}
#: Folds whose words a row's features use: a text that fits trees is never one that its words were learned from.
WORDS_FROM = {2: (1, 3), 3: (1, 2)}

# Fixed word lists: common insults and vulgarities, and words that address the reader.
INSULTS = ("idiot idiots moron morons stupid scum trash clown loser losers disgusting worthless pathetic dumb garbage filth filthy "
           "bastard bitch cunt asshole fuck fucking shit crap retard retarded imbecile fool vermin parasite liar coward freak pig "
           "ugly hate kill die idiota imbécil estúpido estúpida basura mierda connard idiote imbécile ordure merde débile "
           "dummkopf abschaum müll arschloch scheiße wertlos").split()
YOU = "you your yours yourself youre u ur tu tú te ti usted vous toi votre vos du dich dir dein deine ihr euch".split()
NEAR = 5
#: A learned word occurs in at least so many toxic texts, its odds there are so many times those elsewhere, and the logarithm of
#: that ratio is so many standard errors above 0.
LEAST, RATIO, ERRORS = 3, 6.0, 2.5

_LEET_DELIM = T.NOT_LETTER.copy()
_LEET = T.LOWER.copy()
for _a, _b in zip("013457@$!", "oieastasi"):
    _LEET_DELIM[ord(_a)] = False
    _LEET[ord(_a)] = ord(_b)
_FLAGS = {name: np.isin(np.arange(256), [ord(c) for c in chars]) for name, chars in
          (("upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), ("exclaim", "!"), ("question", "?"), ("symbol", "#*$%&|<>@^~"), ("digit", "0123456789"),
           ("quote", "\"'"), ("stop", ".,;:"))}
_LETTER = ~T.NOT_LETTER
FEATURES = ("insults", "insult_density", "distinct_insults", "learned", "learned_density", "masked", "masked_density", "near_you", "near_you_share",
            "you_density", "starred_density", "upper_rate", "upper_words", "loud_insults", "exclaim_rate", "question_rate", "symbol_rate",
            "digit_rate", "quote_rate", "stop_rate", "long_runs", "word_length", "log_words", "foreign_rate", "repeat_rate")


def _hash(words: list[str]) -> np.ndarray:
    data = [w.encode() for w in words]
    off = np.cumsum([0] + [len(w) + 1 for w in data])
    raw = np.frombuffer(b"".join(w + b" " for w in data), np.uint8)
    return np.sort(T.word_hashes(raw, off, T.NOT_LETTER, T.LOWER)[3])


def _in(h: np.ndarray, sorted_: np.ndarray) -> np.ndarray:
    if not len(sorted_):
        return np.zeros(len(h), bool)
    at = np.searchsorted(sorted_, h)
    at[at == len(sorted_)] = 0
    return sorted_[at] == h


def _rate(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    c = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=c[1:])
    return (c[off[1:]] - c[off[:-1]]).astype(float)


_INSULT_HASHES, _YOU_HASHES = _hash(INSULTS), _hash(YOU)


def features(raw: np.ndarray, off: np.ndarray, learned: np.ndarray) -> np.ndarray:
    """One row of FEATURES for each text."""
    n = len(off) - 1
    start, end, row, h = T.word_hashes(raw, off, T.NOT_LETTER, T.LOWER)
    count = lambda m: np.bincount(row[m], minlength=n).astype(float)
    words = np.bincount(row, minlength=n).astype(float)
    per = 1 / np.maximum(words, 1)
    insult, new = _in(h, _INSULT_HASHES), _in(h, learned)
    bad = insult | new
    you = _in(h, _YOU_HASHES)
    seen = np.zeros(len(h) + 1, np.int64)
    np.cumsum(you, out=seen[1:])
    i = np.flatnonzero(bad)
    first = np.searchsorted(row, row[i], "left")
    last = np.searchsorted(row, row[i], "right")
    near = np.zeros(len(h), bool)
    near[i] = seen[np.minimum(i + NEAR + 1, last)] > seen[np.maximum(i - NEAR, first)]
    up = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(_FLAGS["upper"][raw], out=up[1:])
    loud = (up[end] - up[start] == end - start) & (end - start > 1)
    ls, le, lrow = T.words(raw, off, _LEET_DELIM)
    odd = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(~_LETTER[raw], out=odd[1:])
    mixed = (odd[le] > odd[ls]) & (odd[le] - odd[ls] < le - ls) & _LETTER[raw[ls]] if len(ls) else np.zeros(0, bool)
    ls, le, lrow = ls[mixed], le[mixed], lrow[mixed]
    masked = _in(T.span_hashes(raw, ls, le, _LEET), np.sort(np.r_[_INSULT_HASHES, learned]))
    letter = _LETTER[raw]
    starred = np.zeros(len(raw), bool)
    starred[1:-1] = (raw[1:-1] == 42) & letter[:-2] & (letter[2:] | (raw[2:] == 42))
    runs = np.zeros(len(raw), bool)
    runs[2:] = (raw[2:] == raw[1:-1]) & (raw[1:-1] == raw[:-2]) & letter[2:] & (raw[2:] < 128)
    for b in off[1:-1]:
        runs[b:b + 2] = False
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    drow, _ = T.distinct(row[bad], h[bad])
    chars = 1 / np.maximum(np.diff(off), 1)
    letters = np.maximum(_rate(letter, off), 1)
    hits, learnt, hidden, close = count(insult), count(new), np.bincount(lrow[masked], minlength=n).astype(float), count(near)
    cols = [hits, hits * per, np.bincount(drow, minlength=n), learnt, learnt * per, hidden, hidden * per, close, close / np.maximum(count(bad), 1),
            count(you) * per, _rate(starred, off) * per, _rate(_FLAGS["upper"][raw], off) / letters, count(loud) * per, count(loud & bad),
            *(_rate(_FLAGS[f][raw], off) * per for f in ("exclaim", "question", "symbol")), _rate(_FLAGS["digit"][raw], off) * chars,
            *(_rate(_FLAGS[f][raw], off) * per for f in ("quote", "stop")), _rate(runs, off) * per, letters * per, np.log1p(words),
            _rate(raw >= 128, off) * chars, count(same) * per]
    return np.stack([np.asarray(c, float) for c in cols], 1)


def held_out(id_col: str):
    return fold(id_col) == 0


def fold(id_col: str):
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 5


class Model:
    def __init__(self, learned: np.ndarray, trees: gbt.Trees, calibrate: gbt.Isotonic):
        self.learned, self.trees, self.calibrate = learned, trees, calibrate

    def score(self, raw: np.ndarray, off: np.ndarray) -> np.ndarray:
        return np.clip(self.calibrate(self.trees.margin(features(raw, off, self.learned))), 0, 1)


def _sample(docs: DataFrame, labels: DataFrame, folds: tuple[int, ...], id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(y, _fold, _text) of at most MAX_ROWS labelled documents; the ids are bounded, so they go to the scan."""
    own = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & fold(id_col).isin(*folds))
    ids = own.where(hash_share(F.col(id_col), own.count(), MAX_ROWS)) \
        .groupBy(id_col).agg(F.max(F.col(label_col).cast("int")).alias("y")).orderBy(F.xxhash64(id_col), id_col).limit(MAX_ROWS)
    return docs.select(id_col, F.col(text_col).alias("_text")).join(F.broadcast(ids), id_col).select("y", fold(id_col).cast("int").alias("_fold"), "_text")


def _learn_words(rows: DataFrame, subsets: list[tuple[int, ...]]) -> list[np.ndarray]:
    """For each set of folds, hashes of the words that tell its toxic texts from its others (LEAST, RATIO, ERRORS)."""
    folds = sorted({f for s in subsets for f in s})
    names = [f"{c}{f}" for f in folds for c in ("pos", "neg")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, raw, off in pieces(batches, "_text"):
            kind = 2 * np.searchsorted(folds, ints(part, "_fold")) + 1 - ints(part, "y")  # a column of ``names``
            _, _, row, h = T.word_hashes(raw, off, T.NOT_LETTER, T.LOWER)
            row, h = T.distinct(row, h)
            u, at = np.unique(h, return_inverse=True)
            counts = np.bincount(at * len(names) + kind[row], minlength=len(u) * len(names)).reshape(-1, len(names))
            texts = np.bincount(kind, minlength=len(names))[None, :]  # one more row: all texts
            yield pa.RecordBatch.from_arrays([pa.array(np.r_[T.signed(u), 0]), pa.array(np.r_[np.zeros(len(u), np.int64), 1]), *map(pa.array, np.r_[counts, texts].T)],
                                             ["h", "n", *names])

    each = rows.mapInArrow(run, "h bigint, n bigint, " + ", ".join(f"{c} bigint" for c in names))
    found = each.groupBy("h", "n").agg(*(F.sum(c).alias(c) for c in names))
    size = found.where("n = 1").first()
    tells = []
    for s in subsets:
        total = {c: sum(size[f"{c}{f}"] for f in s) if size else 0 for c in ("pos", "neg")}
        # Smoothed log-odds: no share of all toxic rows, and no cap on the words (the sample is bounded).
        a, b = (sum(F.col(f"{c}{f}") for f in s) + 0.5 for c in ("pos", "neg"))
        odds = F.log(a / (total["pos"] + 1.0 - a)) - F.log(b / (total["neg"] + 1.0 - b))
        enough = F.lit(min(total.values()) >= 10)
        tells.append(enough & (a >= LEAST + 0.5) & (odds >= float(np.log(RATIO))) & (odds >= ERRORS * F.sqrt(1 / a + 1 / b)))
    any_, flags = tells[0], [f"s{i}" for i in range(len(subsets))]
    for t in tells[1:]:
        any_ = any_ | t
    got = found.where((F.col("n") == 0) & any_).select("h", *(t.alias(c) for t, c in zip(tells, flags))).toArrow()
    h = np.ascontiguousarray(got["h"].to_numpy()).view(np.uint64)
    return [np.sort(h[got[c].to_numpy().astype(bool)]) for c in flags]


def _rows(sample: DataFrame, learned: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Features (by the words for a row's fold) and labels of a bounded sample, in an order that doesn't depend on partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, raw, off in pieces(batches, "_text"):
            own = ints(part, "_fold")
            x = np.zeros((part.num_rows, len(FEATURES)))
            for f, words in learned.items():
                if (own == f).any():
                    x[own == f] = features(raw, off, words)[own == f]
            yield pa.RecordBatch.from_arrays([column(part, "y").cast(pa.int64()), *map(pa.array, x.T)], ["y", *FEATURES])

    got = sample.mapInArrow(run, "y bigint, " + ", ".join(f"{f} double" for f in FEATURES)).toArrow()
    x = np.stack([got[f].to_numpy() for f in FEATURES], 1) if len(got) else np.zeros((0, len(FEATURES)))
    y = got["y"].to_numpy().astype(float)
    order = np.lexsort((*x.T, y))
    return x[order], y[order]


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    take = lambda role: _sample(docs, labels, FOLDS[role], id_col, text_col, label_col)
    *own, learned = _learn_words(take("words"), [*WORDS_FROM.values(), FOLDS["words"]])
    trees = gbt.fit(*_rows(take("trees"), dict(zip(WORDS_FROM, own))))
    x, y = _rows(take("calibration"), dict.fromkeys(FOLDS["calibration"], learned))
    return Model(learned, trees, gbt.isotonic(trees.margin(x), y))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every document."""
    kind = docs.schema[id_col].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, raw, off in pieces(batches, "_text"):
            yield pa.RecordBatch.from_arrays([column(part, "_id"), pa.array(sent.value.score(raw, off))], ["_id", "score"])

    out = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(run, f"_id {kind}, score double")
    return out.withColumnRenamed("_id", id_col)
