"""Boosted trees on histograms, in numpy: fitted on a bounded sample, applied to any number of rows in batches.

Second-order boosting with a ridge term; unknown values take the side that suits them better. Rounds can be added to an
earlier model. Trees hold real cuts, so they don't depend on the bins they were found with.
"""

from __future__ import annotations

import json
from typing import NamedTuple

import numpy as np

BINS, RIDGE, LEAST_WEIGHT = 64, 1.0, 1.0


class Trees(NamedTuple):
    base: float
    logistic: bool
    feature: np.ndarray  # (trees, nodes): -1 at a leaf
    cut: np.ndarray  # the left side takes values up to it
    unknown_left: np.ndarray
    value: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Sum of all trees' leaves for each row; children of node i are 2 i + 1 and 2 i + 2."""
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, cut, left, value in zip(self.feature, self.cut, self.unknown_left, self.value, strict=True):
            at = np.zeros(len(x), np.int64)
            while True:
                f = feature[at]
                inner = f >= 0
                if not inner.any():
                    break
                v = x[rows, np.maximum(f, 0)]
                goes_left = np.where(np.isnan(v), left[at], v <= cut[at])
                at = np.where(inner, 2 * at + np.where(goes_left, 1, 2), at)
            out += value[at]
        return out

    def predict(self, x: np.ndarray) -> np.ndarray:
        raw = self.raw(x)
        return 1 / (1 + np.exp(-np.clip(raw, -500, 500))) if self.logistic else raw

    def to_json(self) -> str:
        return json.dumps({k: v.tolist() if isinstance(v, np.ndarray) else v for k, v in self._asdict().items()})

    @staticmethod
    def from_json(text: str) -> Trees:
        d = json.loads(text)
        kinds = {"feature": np.int64, "cut": float, "unknown_left": bool, "value": float}
        return Trees(**{k: np.array(v, kinds[k]) if k in kinds else v for k, v in d.items()})


def _bins(x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Bin of each value (BINS: unknown) and each feature's cuts: its quantiles."""
    out, cuts = np.full(x.shape, BINS, np.int64), []
    for j in range(x.shape[1]):
        known = x[:, j][~np.isnan(x[:, j])]
        values = np.unique(known)
        own = values[:-1] if len(values) <= BINS else np.unique(np.quantile(known, np.arange(1, BINS) / BINS, method="lower"))
        own = own[own < values[-1]] if len(values) else own
        cuts.append(own)
        out[~np.isnan(x[:, j]), j] = np.searchsorted(own, known, side="left")
    return out, cuts


def _grow(bins: np.ndarray, cuts: list[np.ndarray], columns: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int, rate: float):
    """One tree over the given rows and columns, level by level."""
    nodes = 2 ** (depth + 1) - 1
    feature, cut, left, value = np.full(nodes, -1), np.zeros(nodes), np.zeros(nodes, bool), np.zeros(nodes)
    at, wide = np.zeros(len(g), np.int64), BINS + 1
    sums = {0: (g.sum(), h.sum())}
    for level in range(depth + 1):
        first, width = 2**level - 1, 2**level
        for node in range(first, first + width):
            if node in sums:
                value[node] = -rate * sums[node][0] / (sums[node][1] + RIDGE)
        live = np.flatnonzero(at >= first)
        if level == depth or not len(live):
            break
        key = ((at[live] - first)[:, None] * len(columns) + np.arange(len(columns))) * wide + bins[live][:, columns]
        hist = [np.bincount(key.ravel(), np.repeat(w[live], len(columns)), width * len(columns) * wide).reshape(width, len(columns), wide) for w in (g, h)]
        total = [x.sum(2, keepdims=True)[:, :1] for x in hist]
        best = np.full(width, 1e-9)
        choice: list[tuple | None] = [None] * width
        score = lambda a, b: a * a / (b + RIDGE)
        for side in (False, True):  # unknown values right, then left
            gl, hl = (np.cumsum(x[:, :, :-1], 2) + (x[:, :, -1:] if side else 0) for x in hist)
            gr, hr = total[0] - gl, total[1] - hl
            gain = score(gl, hl) + score(gr, hr) - score(*total)
            gain[(hl < LEAST_WEIGHT) | (hr < LEAST_WEIGHT)] = -np.inf
            for j, c in enumerate(columns):
                gain[:, j, len(cuts[c]) :] = -np.inf
            flat = gain.reshape(width, -1)
            top = flat.argmax(1)
            for i in np.flatnonzero(flat[np.arange(width), top] > best):
                best[i] = flat[i, top[i]]
                j, b = divmod(int(top[i]), wide - 1)
                choice[i] = (j, b, side, gl[i, j, b], hl[i, j, b], gr[i, j, b], hr[i, j, b])
        for i, pick in enumerate(choice):
            rows = live[at[live] == first + i]
            if pick is None:
                continue
            j, b, side, *four = pick
            node, c = first + i, columns[j]
            feature[node], cut[node], left[node] = c, cuts[c][b], side
            own = bins[rows, c]
            at[rows] = 2 * node + np.where((own <= b) | ((own == BINS) & side), 1, 2)
            sums[2 * node + 1], sums[2 * node + 2] = (four[0], four[1]), (four[2], four[3])
    return feature, cut, left, value


def fit(x: np.ndarray, y: np.ndarray, rounds: int, depth: int, rate: float, logistic: bool = False, rows: float = 0.8, columns: float = 0.8, seed: int = 42, start: Trees | None = None) -> Trees:
    """``rounds`` trees, each on a share of rows and columns, on top of ``start``'s. A table without rows gives a constant 0."""
    if start is not None and (start.logistic != logistic or start.feature.shape[1] != 2 ** (depth + 1) - 1):
        raise ValueError("the earlier model is of another kind")
    nodes = 2 ** (depth + 1) - 1
    mean = float(np.mean(y)) if len(y) else 0.0
    base = float(np.log(max(mean, 1e-6) / max(1 - mean, 1e-6))) if logistic and len(y) else mean
    model = start or Trees(base, logistic, np.zeros((0, nodes), np.int64), np.zeros((0, nodes)), np.zeros((0, nodes), bool), np.zeros((0, nodes)))
    if not len(y):
        return model
    rng = np.random.default_rng(seed + len(model.feature))
    bins, cuts = _bins(x)
    now, grown = model.raw(x), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(now, -500, 500))) if logistic else now
        g, h = p - y, (p * (1 - p) if logistic else np.ones(len(y)))
        own = np.flatnonzero(rng.random(len(y)) < rows)
        some = np.sort(rng.choice(x.shape[1], max(1, round(columns * x.shape[1])), replace=False))
        tree = _grow(bins[own], cuts, some, g[own], h[own], depth, rate) if len(own) else (np.full(nodes, -1), np.zeros(nodes), np.zeros(nodes, bool), np.zeros(nodes))
        grown.append(tree)
        now = now + Trees(0.0, False, *[t[None] for t in tree]).raw(x)
    parts = [np.concatenate([old, np.stack(new)]) if new else old for old, new in zip(model[2:], zip(*grown, strict=True) if grown else [()] * 4, strict=True)]
    return Trees(model.base, logistic, *parts)


def auc(y: np.ndarray, score: np.ndarray) -> float:
    """Share of (positive, negative) pairs in the right order, ties half; nan with one label."""
    n1 = int((y == 1).sum())
    n0 = len(y) - n1
    if not n1 or not n0:
        return float("nan")
    _, at, count = np.unique(score, return_inverse=True, return_counts=True)
    rank = np.cumsum(count) - (count - 1) / 2
    return float((rank[at][y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0))
