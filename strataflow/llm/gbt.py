"""Histogram gradient-boosted trees and isotonic calibration in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    """Complete trees of one depth, flattened: node ``k`` has the children ``2k+1`` and ``2k+2``.

    ``feature`` and ``cut`` have a row for each tree; a row goes right where its value is
    over the cut. ``leaf`` holds log-odds.
    """

    base: float
    depth: int
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row, all trees at once, in blocks of bounded memory."""
        out = np.full(len(x), self.base)
        trees = np.arange(len(self.feature))
        for a in range(0, len(x), 4096):
            rows = x[a : a + 4096]
            at = np.zeros((len(rows), len(trees)), dtype=np.int64)
            line = np.arange(len(rows))[:, None]
            for _ in range(self.depth):
                at = 2 * at + 1 + (rows[line, self.feature[trees, at]] > self.cut[trees, at])
            out[a : a + 4096] += self.leaf[trees, at - (2**self.depth - 1)].sum(axis=1)
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.raw(x))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_trees(
    x: np.ndarray,
    y: np.ndarray,
    *,
    trees: int = 100,
    depth: int = 4,
    rate: float = 0.12,
    bins: int = 48,
    ridge: float = 2.0,
    least: float = 3.0,
) -> Trees:
    """Boosts logistic loss: each level of a tree is chosen from histograms of the gradients.

    Without rows, or with one class only, the result is the smoothed share of ones for all.
    """
    n, width = x.shape
    share = (float(y.sum()) + 0.5) / (n + 1.0)
    base = float(np.log(share / (1 - share)))
    inner, leaves = 2**depth - 1, 2**depth
    if n == 0 or y.min() == y.max():
        return Trees(base, depth, np.zeros((0, inner), dtype=np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    codes = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    feature = np.zeros((trees, inner), dtype=np.int64)
    cut = np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, leaves))
    z = np.full(n, base)
    for t in range(trees):
        p = sigmoid(z)
        g, h = p - y, p * (1 - p)
        at = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            first, nodes = 2**level - 1, 2**level
            local = at - first
            best = np.full(nodes, 1e-6)
            for f in range(width):
                size = len(cuts[f]) + 1
                if size < 2:
                    continue
                key = local * size + codes[:, f]
                gs = np.bincount(key, g, nodes * size).reshape(nodes, size).cumsum(axis=1)
                hs = np.bincount(key, h, nodes * size).reshape(nodes, size).cumsum(axis=1)
                gl, hl, ga, ha = gs[:, :-1], hs[:, :-1], gs[:, -1:], hs[:, -1:]
                gain = gl**2 / (hl + ridge) + (ga - gl) ** 2 / (ha - hl + ridge) - ga**2 / (ha + ridge)
                gain[(hl < least) | (ha - hl < least)] = -1
                top = gain.argmax(axis=1)
                value = gain[np.arange(nodes), top]
                better = value > best
                best[better] = value[better]
                feature[t, first : first + nodes][better] = f
                cut[t, first : first + nodes][better] = cuts[f][top[better]]
            at = 2 * at + 1 + (x[np.arange(n), feature[t, at]] > cut[t, at])
        local = at - inner
        gs, hs = np.bincount(local, g, leaves), np.bincount(local, h, leaves)
        leaf[t] = -rate * gs / (hs + ridge)
        z += leaf[t][local]
    return Trees(base, depth, feature, cut, leaf)


@dataclass(frozen=True)
class Isotonic:
    """A rising piecewise linear map from raw scores to probabilities."""

    x: np.ndarray
    y: np.ndarray

    def __call__(self, raw: np.ndarray) -> np.ndarray:
        """A hundredth of the uncalibrated score keeps the order within flat pieces."""
        return 0.99 * np.interp(raw, self.x, self.y) + 0.01 * sigmoid(raw)


def fit_isotonic(raw: np.ndarray, y: np.ndarray) -> Isotonic:
    """Pool adjacent violators; ties of the raw score are one point."""
    if not len(raw):
        return Isotonic(np.array([-40.0, 40.0]), np.array([0.0, 1.0]))
    points, inverse = np.unique(raw, return_inverse=True)
    weight, total = np.bincount(inverse).astype(float), np.bincount(inverse, y)
    blocks: list[list[float]] = []  # weight, sum of labels, sum of weighted scores
    for w, s, v in zip(weight, total, points, strict=True):
        blocks.append([w, s, w * v])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    return Isotonic(
        np.array([b[2] / b[0] for b in blocks]), np.array([(b[1] + 0.01) / (b[0] + 0.02) for b in blocks])
    )
