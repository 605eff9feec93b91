"""Vectorised text primitives over Arrow string buffers: words, 64-bit hashes, n-grams.

Everything works on the UTF-8 bytes of many texts at once, so the cost per word is some tens of nanoseconds and the
memory is bounded by the piece size. Hashes are polynomial sums modulo 2**64 that end in a bit mixer; they depend on
the bytes alone and are the same on every executor.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
_R = 0x9E3779B97F4A7C15 | 1
_R_INV = pow(_R, -1, 1 << 64)
_POW = np.zeros(0, U64)
_INV = np.zeros(0, U64)
_BLOCK = 1 << 18

#: Space and 0x09-0x0D part words; everything else belongs to a word.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
IDENTITY = np.arange(256, dtype=np.uint8)
LOWER = IDENTITY.copy()
LOWER[65:91] += 32
#: For comparisons that ignore punctuation: ASCII letters, digits and all bytes of longer characters make words.
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
NOT_LETTER = NOT_ALNUM.copy()
NOT_LETTER[48:58] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64 (in place where possible)."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POW, _INV
    if len(_POW) < n:
        size = max(n, _BLOCK + 4096)
        for name, base in (("_POW", _R), ("_INV", _R_INV)):
            out = np.full(size, base, U64)
            out[0] = 1
            globals()[name] = np.multiply.accumulate(out)
    return _POW, _INV


def words(raw: np.ndarray, off: np.ndarray, delim: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every word; texts never run into each other."""
    if not len(raw):
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~delim[raw]
    first = np.zeros(len(raw) + 1, bool)
    first[off] = True
    begin = inside.copy()
    begin[1:] &= delim[raw[:-1]] | first[1:-1]
    ends = inside
    ends[:-1] &= delim[raw[1:]] | first[1:-1]
    start, end = np.flatnonzero(begin), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(off, start, "right") - 1


def span_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray, translate: np.ndarray = IDENTITY) -> np.ndarray:
    """Hash of the bytes in each [start, end); spans are ordered and don't overlap."""
    out = np.zeros(len(start), U64)
    lut = translate.astype(U64) + U64(1)
    at, n = 0, len(start)
    while at < n:
        base = int(start[at])
        to = max(at + 1, int(np.searchsorted(end, base + _BLOCK, "right")))
        pw, inv = _powers(int(end[to - 1]) - base + 1)
        seg = lut[raw[base:int(end[to - 1])]]
        seg *= pw[:len(seg)]
        cum = np.zeros(len(seg) + 1, U64)
        np.cumsum(seg, out=cum[1:])
        s = start[at:to] - base
        out[at:to] = (cum[end[at:to] - base] - cum[s]) * inv[s]
        at = to
    return mix(out + (end - start).astype(U64) * U64(0xD6E8FEB86659FD93))


def word_hashes(raw, off, delim=SPACE, translate=IDENTITY):
    """(start, end, row, hash) of every word."""
    start, end, row = words(raw, off, delim)
    return start, end, row, span_hashes(raw, start, end, translate)


def _factors(n: int) -> list[np.uint64]:
    return [U64((0xA0761D6478BD642F * (2 * i + 1) ** 3 + 0x1000193 * i) % (1 << 64) | 1) for i in range(n)]


def ngrams(h: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first word, hash) of each n-gram that lies in one text."""
    if len(h) < n:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    at = np.flatnonzero(row[:len(row) - n + 1] == row[n - 1:])
    acc = np.zeros(len(h) - n + 1, U64)
    for i, f in enumerate(_factors(n)):
        acc += h[i:len(h) - n + 1 + i] * f
    return at, mix(acc[at] + U64(n))


def shingles(h: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of n-word shingles; a text of 1 to n-1 words has its whole word sequence as one shingle."""
    at, out = ngrams(h, row, n)
    rows = row[at]
    if len(h):
        firsts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        counts = np.diff(np.r_[firsts, len(row)])
        short = counts < n
        if short.any():
            f, c = firsts[short], counts[short]
            acc = np.zeros(len(f), U64)
            for i, k in enumerate(_factors(n)[:n - 1]):
                has = c > i
                acc[has] += h[f[has] + i] * k
            rows = np.r_[rows, row[f]]
            out = np.r_[out, mix(acc + c.astype(U64))]
    return rows, out


def distinct(rows: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, hash), ordered by row, then hash."""
    order = np.lexsort((h, rows))
    rows, h = rows[order], h[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (rows[1:] != rows[:-1]) | (h[1:] != h[:-1])
    return rows[keep], h[keep]


def code_points_before(raw: np.ndarray) -> np.ndarray:
    """Number of code points that begin before each byte (one entry more than bytes)."""
    out = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=out[1:])
    return out


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def separated(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with one line feed after each, and where each begins; no run of other bytes spans two texts."""
    n = len(off) - 1
    return np.insert(raw, off[1:], 10), off[:-1] + np.arange(n)


def long_runs(mask: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the maximal runs of true values that have ``least`` or more."""
    m, width = mask, 1
    while width < least and len(m):
        step = min(width, least - width)
        m = m[:-step] & m[step:] if len(m) > step else m[:0]
        width += step
    at = np.flatnonzero(m)
    if not len(at):
        return at, at
    gap = np.flatnonzero(np.diff(at) > 1)
    return at[np.r_[0, gap + 1]], at[np.r_[gap, len(at) - 1]] + least
