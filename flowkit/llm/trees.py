"""Gradient-boosted regression trees on binned features, for a logistic loss, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32


@dataclass
class Forest:
    """Full binary trees by level: split features and cuts of inner nodes, values of leaves, and the first log odds."""

    features: np.ndarray
    cuts: np.ndarray
    values: np.ndarray
    start: float

    def odds(self, rows: np.ndarray) -> np.ndarray:
        """Log odds of each row."""
        total = np.full(len(rows), self.start)
        every = np.arange(len(rows))
        inner = self.features.shape[1]
        for features, cuts, values in zip(self.features, self.cuts, self.values, strict=True):
            at = np.zeros(len(rows), dtype=np.int64)
            while inner and at[:1].size and at[0] < inner:
                at = 2 * at + 1 + (rows[every, features[at]] > cuts[at])
            total += values[at - inner]
        return total


def grow(rows: np.ndarray, labels: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.25, ridge: float = 2.0) -> Forest:
    """Trees of a fixed depth on feature quantiles; each leaf takes a shrunken Newton step."""
    n, width = rows.shape
    edges = [np.unique(np.quantile(rows[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(e, rows[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    share = float(np.clip(labels.mean() if n else 0.5, 0.01, 0.99))
    start = float(np.log(share / (1 - share)))
    total = np.full(n, start)
    inner = (1 << depth) - 1
    features, cuts = np.zeros((trees, inner), dtype=np.int64), np.full((trees, inner), np.inf)
    values = np.zeros((trees, inner + 1))
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        pull, weight = labels - p, np.maximum(p * (1 - p), 1e-6)
        at = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            first, width_here = (1 << level) - 1, 1 << level
            best = np.full(width_here, 1e-6)
            for j in range(width):
                if not len(edges[j]):
                    continue
                key = (at - first) * BINS + binned[:, j]
                g = np.bincount(key, pull, width_here * BINS).reshape(width_here, BINS).cumsum(axis=1)
                h = np.bincount(key, weight, width_here * BINS).reshape(width_here, BINS).cumsum(axis=1)
                whole_g, whole_h = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + ridge) + (whole_g - g) ** 2 / (whole_h - h + ridge) - whole_g**2 / (whole_h + ridge)
                gain = gain[:, : len(edges[j])]
                cut = gain.argmax(axis=1)
                better = np.flatnonzero(gain[np.arange(width_here), cut] > best)
                best[better] = gain[better, cut[better]]
                features[t, first + better] = j
                cuts[t, first + better] = edges[j][cut[better]]
            at = 2 * at + 1 + (rows[np.arange(n), features[t, at]] > cuts[t, at])
        leaf = at - inner
        step = np.bincount(leaf, pull, inner + 1) / (np.bincount(leaf, weight, inner + 1) + ridge)
        values[t] = rate * step
        total += values[t, leaf]
    return Forest(features, cuts, values, start)
