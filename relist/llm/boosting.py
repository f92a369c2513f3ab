"""Gradient-boosted regression trees with logistic loss, in numpy, for a bounded table of features."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Complete binary trees: ``feature`` and ``limit`` by tree and inner node, ``value`` by tree and leaf."""

    feature: np.ndarray
    limit: np.ndarray
    value: np.ndarray
    base: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        depth = int(np.log2(self.value.shape[1])) if len(self.value) else 0
        for feature, limit, value in zip(self.feature, self.limit, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > limit[node])
            total += value[node - (len(value) - 1)]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def boosted(x: np.ndarray, y: np.ndarray, trees: int, depth: int, rate: float, bins: int, ridge: float = 1.0) -> Trees:
    """Fit by Newton boosting on histograms; a node that cannot be split sends all rows left."""
    rows, columns = x.shape
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, bins + 1)[1:-1])) for k in range(columns)]
    binned = np.column_stack([np.searchsorted(edges[k], x[:, k], "left") for k in range(columns)])
    rate_of = min(max(float(y.mean()), 1e-4), 1 - 1e-4)
    base = float(np.log(rate_of / (1 - rate_of)))
    inner, leaves = 2**depth - 1, 2**depth
    feature, limit, value = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves))
    total = np.full(rows, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        gradient, curvature = y - p, p * (1 - p)
        node = np.zeros(rows, np.int64)
        for level in range(depth):
            for n in range(2**level - 1, 2 ** (level + 1) - 1):
                inside = np.flatnonzero(node == n)
                best = 1e-6
                for k in range(columns):
                    g = np.bincount(binned[inside, k], gradient[inside], bins + 1).cumsum()
                    h = np.bincount(binned[inside, k], curvature[inside], bins + 1).cumsum()
                    gain = g**2 / (h + ridge) + (g[-1] - g) ** 2 / (h[-1] - h + ridge) - g[-1] ** 2 / (h[-1] + ridge)
                    at = int(gain[: len(edges[k])].argmax()) if len(edges[k]) else 0
                    if len(edges[k]) and gain[at] > best:
                        best, feature[t, n], limit[t, n] = float(gain[at]), k, edges[k][at]
            node = 2 * node + 1 + (x[np.arange(rows), feature[t, node]] > limit[t, node])
        leaf = node - inner
        value[t] = rate * np.bincount(leaf, gradient, leaves) / (np.bincount(leaf, curvature, leaves) + ridge)
        total += value[t, leaf]
    return Trees(feature, limit, value, base)
