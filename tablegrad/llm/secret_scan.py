"""Secret scan: fixed patterns, and character Markov models compared by log-likelihood ratio.

Two first-order models over ``[A-Za-z0-9+/_=-]`` tell random strings from ordinary identifiers. Their labelled samples
are the values that the fixed patterns find (label 1) and the other tokens of the corpus (label 0; long ones with digits and
letters, which the model is to judge, are neither): every task counts
character transitions of all its texts in two small matrices, Spark sums the matrices, and the driver sees at most
2 x 66 x 66 sums whatever the size of the corpus. A second scan finds the patterns again and scores every token of
``MIN_TOKEN`` characters or more, letters alone included, against a threshold that falls with its length; its span is added as kind ``markov`` where no fixed pattern covers it.

Defined results: a null or empty text has no spans; repeated rows are scanned each; an empty table trains on the
prior alone (random: uniform; ordinary: letters follow letters) and gives no rows; other columns are never read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .common import column, pieces

# Fixed values of the base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "markov")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 12, 18, 16

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
K = len(ALPHABET) + 1  # 0 is the edge of a token
CODE = np.zeros(256, np.uint16)
for _i, _c in enumerate(ALPHABET):
    CODE[ord(_c)] = _i + 1
MIN_TOKEN = 12
IN_TOKEN = CODE > 0
IN_HEX = np.zeros(256, bool)
IN_HEX[[ord(c) for c in "0123456789abcdef"]] = True
#: Mean log-likelihood ratio a character (natural logarithm) from which a token of FULL characters or more counts as
#: random; a shorter one needs STEP more for each character that it lacks.
THRESHOLD, FULL, STEP = 0.75, 16, 0.05
#: Rules and fillers ("-----") have fewer different characters; random strings of MIN_TOKEN hardly ever do.
DISTINCT = 5


def _order(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda x: (x[1], KINDS.index(x[0])))


def _patterns(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[int, int]]]:
    """The spans that need a regular expression, and the places of their random parts."""
    out, values = [], []
    for m in ASSIGN.finditer(text) if ":" in text or "=" in text else ():
        if m.end(2) - m.start(2) >= MIN_ASSIGN:
            out.append(("assign", *m.span()))
            values.append(m.span(2))
    for m in ACCESS.finditer(text) if "AKIA" in text else ():
        if m.end() - m.start() >= MIN_ACCESS:
            out.append(("access", *m.span()))
            values.append(m.span())
    return out, values


def found(texts: list[str | None], raw: np.ndarray, off: np.ndarray) -> tuple[dict, dict, tuple]:
    """(base spans by row, places of random parts by row, the piece with its texts parted).

    Runs of hexadecimal digits are found for all texts at once; only rows that hold ``:``, ``=`` or ``AKIA`` meet the
    other patterns. Both dictionaries hold rows with at least one entry, in code points.
    """
    sep, begin = T.separated(raw, off)
    cp = T.code_points_before(sep)
    spans, values = {}, {}
    marked = np.flatnonzero((sep == 58) | (sep == 61))
    rows = set((np.searchsorted(begin, marked, "right") - 1).tolist())
    data, at = sep.tobytes(), -1
    while (at := data.find(b"AKIA", at + 1)) >= 0:
        rows.add(int(np.searchsorted(begin, at, "right")) - 1)
    for r in rows:
        s, v = _patterns(texts[r] or "")
        if s:
            spans[r], values[r] = s, v
    start, end = T.long_runs(IN_HEX[sep], MIN_HEX)
    for a, b, r in zip(start.tolist(), end.tolist(), (np.searchsorted(begin, start, "right") - 1).tolist()):
        zero = int(cp[begin[r]])
        span = (int(cp[a]) - zero, int(cp[b]) - zero)
        spans.setdefault(r, []).append(("hex", *span))
        if not any(x < span[1] and span[0] < y for x, y in values.get(r, ())):
            values.setdefault(r, []).append(span)
    return {r: _order(s) for r, s in spans.items()}, values, (sep, begin, cp)


def _mixed(token: str) -> bool:
    """A long token that is a sample of neither kind: one with a digit and a letter."""
    return any(c.isdigit() for c in token) and any(c.isalpha() for c in token)


def _count(raw: np.ndarray) -> np.ndarray:
    """Transitions of the tokens in ``raw`` (texts end with a byte outside the alphabet)."""
    c = CODE[raw]
    return np.bincount(c[:-1] * np.uint16(K) + c[1:], minlength=K * K)[:K * K].astype(np.int64)


def transitions(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(label, pair, n) over all texts; at most 2 * K * K rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ordinary, random = np.zeros(K * K, np.int64), np.zeros(K * K, np.int64)
        for rows, raw, off in pieces(batches, "_text"):
            texts = column(rows, "_text").to_pylist()
            _, values, (sep, begin, cp) = found(texts, raw, off)
            plain = sep.copy()
            for a, b in zip(*(x.tolist() for x in T.long_runs(IN_TOKEN[sep], MIN_TOKEN))):
                if _mixed(sep[a:b].tobytes().decode()):
                    plain[a:b] = 10  # what the scan has to judge is a sample of neither kind
            for r, places in values.items():
                for a, b in places:
                    plain[np.searchsorted(cp, cp[begin[r]] + a):np.searchsorted(cp, cp[begin[r]] + b)] = 10
            ordinary += _count(np.r_[np.uint8(10), plain])
            for r, places in values.items():
                random += _count(np.frombuffer(("\n" + "\n".join(texts[r][a:b] for a, b in places) + "\n").encode(), np.uint8))
        for label, counts in ((1, random), (0, ordinary)):
            pair = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pair), label, np.int32)), pa.array(pair.astype(np.int32)),
                                              pa.array(counts[pair])], ["label", "pair", "n"])

    each = docs.select(F.col(text_col).alias("_text")).mapInArrow(run, "label int, pair int, n bigint")
    return each.groupBy("label", "pair").agg(F.sum("n").alias("n"))


def ratios(counts: list[tuple[int, int, int]], prior: float = 64.0) -> np.ndarray:
    """K x K log-likelihood ratios (random over ordinary) from the summed transitions and a prior."""
    c = np.zeros((2, K, K))
    for label, pair, n in counts:
        c[label, pair // K, pair % K] = n
    c[:, :, 0] = 0  # the length of a token says nothing here
    plain = np.full((K, K), 0.02)
    letters = np.array([ch.isalpha() for ch in "\n" + ALPHABET])
    plain[np.ix_(letters | (np.arange(K) == 0), letters)] = 1.0
    flat = np.ones((K, K))
    flat[:, 0] = plain[:, 0] = 0
    logs = []
    for counted, base in ((c[0], plain), (c[1], flat)):
        base = base / base.sum(1, keepdims=True)
        smooth = counted + prior * base
        logs.append(np.log(np.maximum(smooth / smooth.sum(1, keepdims=True), 1e-300)))
    # Random strings come in more alphabets than the samples show: the uniform string is an alternative hypothesis.
    uniform = np.log(np.maximum(flat / (K - 1), 1e-300))
    out = np.logaddexp(logs[1], uniform) - np.log(2) - logs[0]
    out[:, 0] = 0
    return out


def train(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    return ratios([(r[0], r[1], r[2]) for r in transitions(docs, text_col).collect()])


def score(token: str, table: np.ndarray) -> float:
    """Mean log-likelihood ratio a character."""
    c = CODE[np.frombuffer(token.encode(), np.uint8)].astype(np.int64)
    return float(table[np.r_[0, c[:-1]], c].mean()) if len(c) else 0.0


def is_random(token: str, table: np.ndarray, threshold: float = THRESHOLD) -> bool:
    """What the models say of a token of MIN_TOKEN characters or more; one in capitals is as ordinary as its small letters."""
    seen = score(token.lower(), table) if token.isupper() and token.isalpha() else score(token, table)
    return seen >= threshold + STEP * max(0, FULL - len(token)) and len(set(token)) >= DISTINCT


def piece_spans(texts: list[str | None], raw: np.ndarray, off: np.ndarray, table: np.ndarray,
                threshold: float = THRESHOLD) -> dict[int, list[tuple[str, int, int]]]:
    """All spans, base ones and the model's, of the rows that have any."""
    spans, _, (sep, begin, cp) = found(texts, raw, off)
    start, end = T.long_runs(IN_TOKEN[sep], MIN_TOKEN)
    for a, b in zip(start.tolist(), end.tolist()):
        if is_random(sep[a:b].tobytes().decode(), table, threshold):
            r = int(np.searchsorted(begin, a, "right")) - 1
            x, y = int(cp[a] - cp[begin[r]]), int(cp[b] - cp[begin[r]])
            if not any(s < y and x < e for _, s, e in spans.get(r, ())):
                spans[r] = _order([*spans.get(r, ()), ("markov", x, y)])
    return spans


def scan(docs: DataFrame, table: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the id and ``spans``, an array of (kind, start, end) in code points."""
    kind = docs.schema[id_col].dataType.simpleString()
    item = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, off in pieces(batches, "_text"):
            spans = piece_spans(column(rows, "_text").to_pylist(), raw, off, table)
            out = [[{"kind": k, "start": a, "end": b} for k, a, b in spans.get(r, ())] for r in range(rows.num_rows)]
            yield pa.RecordBatch.from_arrays([column(rows, "_id"), pa.array(out, item)], ["_id", "spans"])

    out = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(
        run, f"_id {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>")
    return out.withColumnRenamed("_id", id_col)


def masked(text: str, spans: list[tuple[str, int, int]], mark: str = "[SECRET]") -> str:
    """``text`` with each run of overlapping spans replaced by ``mark``."""
    out, at = [], 0
    begin, end = spans[0][1:]
    for _, a, b in [*spans[1:], ("", len(text) + 1, len(text) + 1)]:
        if a < end:
            end = max(end, b)
        else:
            out += [text[at:begin], mark]
            at, begin, end = end, a, b
    return "".join(out) + text[at:]


def redact(docs: DataFrame, table: np.ndarray, text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with every secret masked, all rows and columns kept; ``chars_col`` follows where it is there."""
    schema = docs.schema
    has = chars_col in docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, off in pieces(batches, text_col):
            old = column(rows, text_col).to_pylist()
            new = list(old)
            for r, s in piece_spans(old, raw, off, table).items():
                new[r] = masked(old[r], s)
            arrays = dict(zip(rows.schema.names, rows.columns))
            arrays[text_col] = pa.array(new, rows.schema.field(text_col).type)
            if has:
                kept = column(rows, chars_col).to_pylist()
                arrays[chars_col] = pa.array([c if a == b else len(b) for a, b, c in zip(old, new, kept)],
                                             rows.schema.field(chars_col).type)
            yield pa.RecordBatch.from_arrays(list(arrays.values()), list(arrays))

    return docs.mapInArrow(run, schema)
