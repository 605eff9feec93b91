"""Gradient-boosted trees for the logistic loss, and isotonic calibration.

They are fitted on the driver from a bounded sample of feature rows (the bound is a parameter of the callers) and are
themselves small tables of fixed size, which tasks apply to numpy batches.
"""

from __future__ import annotations

import numpy as np

BINS = 64


class Trees:
    """Complete binary trees of one depth: ``feature`` and ``cut`` per inner node, ``leaf`` values."""

    def __init__(self, base: float, feature: np.ndarray, cut: np.ndarray, leaf: np.ndarray, depth: int):
        self.base, self.feature, self.cut, self.leaf, self.depth = base, feature, cut, leaf, depth

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row."""
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, c, v in zip(self.feature, self.cut, self.leaf):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, f[at]] > c[at])
            out += v[at - (len(f))]
        return out


def _cuts(x: np.ndarray) -> np.ndarray:
    """Candidate thresholds of a feature: midpoints between distinct values at even quantiles."""
    v = np.unique(x)
    if len(v) > BINS:
        v = np.unique(np.quantile(x, np.linspace(0, 1, BINS), method="lower"))
    return (v[1:] + v[:-1]) / 2


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.15, least: float = 5.0,
        ridge: float = 1.0) -> Trees:
    """Second-order boosting on histograms. Deterministic: ties go to the first feature and the lowest cut."""
    n, d = x.shape
    inner = (1 << depth) - 1
    p = np.clip(y.mean() if n else 0.5, 1e-3, 1 - 1e-3)
    base = float(np.log(p / (1 - p)))
    cuts = [_cuts(x[:, j]) for j in range(d)]
    binned = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], 1) if d and n else np.zeros((n, d), np.int64)
    feature, cut, leaf = (np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1)))
    margin = np.full(n, base)
    for t in range(trees):
        prob = 1 / (1 + np.exp(-margin))
        g, h = y - prob, np.maximum(prob * (1 - prob), 1e-6)
        at = np.zeros(n, np.int64)
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            local = at - first
            best = np.full(width, 1e-6)
            for j in range(d):
                k = len(cuts[j]) + 1
                if k == 1:
                    continue
                cell = local * k + binned[:, j]
                gs = np.bincount(cell, g, width * k).reshape(width, k)
                hs = np.bincount(cell, h, width * k).reshape(width, k)
                gl, hl = gs.cumsum(1)[:, :-1], hs.cumsum(1)[:, :-1]
                ga, ha = gs.sum(1, keepdims=True), hs.sum(1, keepdims=True)
                gr, hr = ga - gl, ha - hl
                gain = gl ** 2 / (hl + ridge) + gr ** 2 / (hr + ridge) - ga ** 2 / (ha + ridge)
                gain[(hl < least * 0.1) | (hr < least * 0.1)] = 0
                i = gain.argmax(1)
                found = gain[np.arange(width), i]
                better = found > best * (1 + 1e-9)
                best[better] = found[better]
                feature[t, first:first + width][better] = j
                cut[t, first:first + width][better] = cuts[j][i[better]]
            at = 2 * at + 1 + (x[np.arange(n), feature[t][at]] > cut[t][at])
        local = at - inner
        value = rate * np.bincount(local, g, inner + 1) / (np.bincount(local, h, inner + 1) + ridge)
        leaf[t] = value
        margin += value[local]
    return Trees(base, feature, cut, leaf, depth)


class Isotonic:
    """A non-decreasing map from margins to probabilities, linear between its knots."""

    def __init__(self, at: np.ndarray, value: np.ndarray):
        self.at, self.value = at, value

    def __call__(self, margin: np.ndarray) -> np.ndarray:
        return np.interp(margin, self.at, self.value) if len(self.at) else 1 / (1 + np.exp(-margin))


def isotonic(margin: np.ndarray, y: np.ndarray) -> Isotonic:
    """Pool adjacent violators; each pooled level is smoothed by half a case of either label."""
    if len(y) < 20 or y.min() == y.max():
        return Isotonic(np.zeros(0), np.zeros(0))
    order = np.argsort(margin, kind="stable")
    m, v = margin[order], y[order].astype(float)
    pools: list[list[float]] = []  # sum, count, first margin, last margin
    for a, b in zip(m.tolist(), v.tolist()):
        if pools and pools[-1][3] == a:
            pools[-1][0] += b
            pools[-1][1] += 1
        else:
            pools.append([b, 1, a, a])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            s, c, _, last = pools.pop()
            pools[-1][0] += s
            pools[-1][1] += c
            pools[-1][3] = last
    at = np.array([p for s, c, a, b in pools for p in (a, b)])
    value = np.maximum.accumulate(np.array([(s + 0.5) / (c + 1) for s, c, a, b in pools for _ in range(2)]))
    return Isotonic(at, value)
