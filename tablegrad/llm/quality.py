"""Quality rules as a bitmask ledger.

``ledger`` reads every text once, measures it and evaluates every rule once; the row keeps the measurements and one
bit per failed rule. Policies (a version and a mask of the rules that count) are applied to the ledger afterwards, and
an ablation needs only the counts of distinct bit patterns, so neither ever reads a text again. One map over the
scan: no shuffle, memory bounded by one piece of text.

Defined results: a null or empty text measures 0 everywhere and fails ``few_words``; repeated rows and repeated ids
give a row each; an empty table gives an empty ledger; other columns are never read, so their names can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .common import column, pieces

SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
NEWLINE = np.zeros(256, bool)
NEWLINE[10] = True
_LETTER = ~T.NOT_LETTER

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters")

#: (name, test on the measurements); the position is the bit. New rules go to the end, so old ledgers stay readable.
RULES = (
    ("few_words", lambda m: m["n_words"] < 50),
    ("repeated_words", lambda m: 100 * m["n_repeat_words"] > 50 * m["n_words"]),
    ("symbols", lambda m: 10 * m["n_symbols"] > m["n_words"]),
    ("repeated_lines", lambda m: 5 * m["n_dup_lines"] > 2 * m["n_lines"]),
    ("short_words", lambda m: m["word_chars"] < 2 * m["n_words"]),
    ("long_words", lambda m: m["word_chars"] > 12 * m["n_words"]),
    ("few_letters", lambda m: 2 * m["n_letters"] < m["word_chars"]),
)
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}
BASE_MASK = BIT["few_words"] | BIT["repeated_words"]


@dataclass(frozen=True)
class Policy:
    """A versioned choice of rules: a document is rejected if one of them failed."""
    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BIT[r] for r in self.rules)


POLICIES = {p.version: p for p in (
    Policy("base", ("few_words", "repeated_words")),
    Policy("v1", tuple(BIT)),
)}
DEFAULT = "v1"


def _sums(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    c = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=c[1:])
    return c[off[1:]] - c[off[:-1]]


def _repeated(rows: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which (row, hash) occur twice or more."""
    key = T.mix(h + (rows.astype(np.uint64) + T.U64(1)) * T.U64(0x9FB21C651E98DF25))
    order = np.argsort(key, kind="stable")
    k = key[order]
    same = np.zeros(len(k), bool)
    same[1:] = k[1:] == k[:-1]
    same[:-1] |= same[1:]
    out = np.zeros(len(k), bool)
    out[order] = same
    return out


def measure(raw: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """The measurements of each text."""
    n = len(off) - 1
    _, _, row, h = T.word_hashes(raw, off)
    nonspace = ~T.SPACE[raw]
    at, tri = T.ngrams(h, row, 3)
    again = at[_repeated(row[at], tri)]
    covered = np.zeros(len(h), bool)
    for i in range(3):
        covered[again + i] = True
    ls, le, lrow = T.words(raw, off, NEWLINE)
    chars = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(nonspace, out=chars[1:])
    full = chars[le] > chars[ls]
    ls, le, lrow = ls[full], le[full], lrow[full]
    urow, _ = T.distinct(lrow, T.span_hashes(raw, ls, le))
    lines = np.bincount(lrow, minlength=n)
    return {
        "n_words": np.bincount(row, minlength=n),
        "word_chars": _sums(nonspace & ((raw & 0xC0) != 0x80), off),
        "n_symbols": _sums(SYMBOLS[raw], off),
        "n_dup_lines": lines - np.bincount(urow, minlength=n),
        "n_repeat_words": np.bincount(row[covered], minlength=n),
        "n_lines": lines,
        "n_letters": _sums(_LETTER[raw] & ((raw & 0xC0) != 0x80), off),
    }


def fail_mask(m: dict[str, np.ndarray]) -> np.ndarray:
    out = np.zeros(len(m["n_words"]), np.int64)
    for name, test in RULES:
        out |= np.where(test(m), BIT[name], 0)
    return out


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the id, every measurement and ``fail_mask`` (bit i set: rule i failed)."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, off in pieces(batches, "_text"):
            m = measure(raw, off)
            yield pa.RecordBatch.from_arrays(
                [column(rows, "_id"), *(pa.array(m[c].astype(np.int64)) for c in MEASURES), pa.array(fail_mask(m))],
                ["_id", *MEASURES, "fail_mask"])

    cols = ", ".join(f"{c} bigint" for c in (*MEASURES, "fail_mask"))
    out = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(run, f"_id {kind}, {cols}")
    return out.withColumnRenamed("_id", id_col)


def apply_policy(led: DataFrame, policy: Policy) -> DataFrame:
    """The ledger with ``kept``: no rule of the policy failed."""
    return led.withColumn("kept", F.col("fail_mask").bitwiseAND(F.lit(policy.mask)) == 0)


def ablation(led: DataFrame, policy: Policy) -> DataFrame:
    """For each rule of the policy: documents that fail it, and those that only it rejects.

    Documents are first counted by bit pattern (at most 2**rules rows, partly summed before the shuffle).
    """
    seen = led.groupBy(F.col("fail_mask").bitwiseAND(F.lit(policy.mask)).alias("mask")).agg(F.count("*").alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).cast("long").alias("bit"))
                                for r in policy.rules])).alias("r")
    x = seen.select("mask", "n", rules)
    has = F.col("mask").bitwiseAND(F.col("r.bit")) != 0
    return x.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(has, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("mask") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only"))


def keep_documents(docs: DataFrame, policy: Policy = POLICIES[DEFAULT], text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, that the policy keeps; filtered inside the one scan."""
    mask = policy.mask

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, off in pieces(batches, text_col):
            yield rows.filter(pa.array((fail_mask(measure(raw, off)) & mask) == 0))

    return docs.mapInArrow(run, docs.schema)
