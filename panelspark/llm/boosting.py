"""Gradient-boosted trees for a yes/no target, on histograms (numpy)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Boosted:
    """Complete trees of one depth: ``feature`` and ``cut`` per inner node, ``leaf`` log-odds."""

    bias: float
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        inner = self.feature.shape[1] if len(self.feature) else 0
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            at = np.zeros(len(x), np.int64)
            while at.size and at[0] < inner:
                at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
            out += leaf[at - inner] if at.size else 0
        return out


def train(x: np.ndarray, y: np.ndarray, trees: int = 50, depth: int = 4, rate: float = 0.25, bins: int = 32, ridge: float = 2.0) -> Boosted:
    """Fit by Newton steps on the logistic loss; cuts lie at quantiles of the columns."""
    rows, cols = x.shape
    inner, leaves = (1 << depth) - 1, 1 << depth
    share = min(max(y.mean() if rows else 0.5, 1e-3), 1 - 1e-3)
    model = Boosted(float(np.log(share / (1 - share))), np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    if not rows or y.min() == y.max():
        return model
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for c in x.T]
    codes = np.column_stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)])
    wide = bins + 1
    f = np.full(rows, model.bias)
    features, borders, values = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-f))
        g, h = p - y, p * (1 - p)
        at = np.zeros(rows, np.int64)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            best = np.full(width, 1e-9)
            border = np.full(width, bins, np.int64)
            for j in range(cols):
                key = (at - first) * wide + codes[:, j]
                gs = np.bincount(key, g, width * wide).reshape(width, wide).cumsum(axis=1)
                hs = np.bincount(key, h, width * wide).reshape(width, wide).cumsum(axis=1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs ** 2 / (hs + ridge) + (gt - gs) ** 2 / (ht - hs + ridge) - gt ** 2 / (ht + ridge)
                gain[:, len(cuts[j]):] = 0
                k = gain.argmax(axis=1)
                won = gain[np.arange(width), k] > best
                best = np.where(won, gain[np.arange(width), k], best)
                border = np.where(won, k, border)
                node = first + np.flatnonzero(won)
                feature[node] = j
                cut[node] = cuts[j][k[won]] if len(cuts[j]) else np.inf
            at = 2 * at + 1 + (x[np.arange(rows), feature[at]] > cut[at])
        at -= inner
        value = -rate * np.bincount(at, g, leaves) / (np.bincount(at, h, leaves) + ridge)
        f += value[at]
        features.append(feature)
        borders.append(cut)
        values.append(value)
    return Boosted(model.bias, np.array(features), np.array(borders), np.array(values))
