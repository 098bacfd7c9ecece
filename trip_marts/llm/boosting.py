"""Gradient-boosted trees for two classes, on binned features, in numpy."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Trees:
    """Complete binary trees of one depth: feature and bin of every inner node."""

    edges: list[np.ndarray]
    depth: int
    bias: float = 0.0
    features: list[np.ndarray] = field(default_factory=list)
    cuts: list[np.ndarray] = field(default_factory=list)
    leaves: list[np.ndarray] = field(default_factory=list)

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(self.edges)], axis=1)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        bins, rows = self.binned(x), np.arange(len(x))
        total = np.full(len(x), self.bias)
        for feature, cut, leaf in zip(self.features, self.cuts, self.leaves):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (bins[rows, feature[node]] > cut[node])
            total += leaf[node - (2**self.depth - 1)]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.25, bins: int = 32, ridge: float = 1.0) -> Trees:
    """Newton boosting of the logistic loss; each split takes the best gain of all bins."""
    steps = np.linspace(0, 1, bins)[1:-1]
    model = Trees([np.unique(np.quantile(x[:, j], steps)) if len(x) else np.zeros(0) for j in range(x.shape[1])], depth)
    share = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
    model.bias = float(np.log(share / (1 - share)))
    if not len(x) or y.min() == y.max():
        return model
    binned, score = model.binned(x), np.full(len(x), model.bias)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        feature, cut = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, bins)
        node = np.zeros(len(x), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            place = node - first
            best = np.full(width, 1e-6)
            for j in range(x.shape[1]):
                cell = place * bins + binned[:, j]
                gs = np.bincount(cell, g, width * bins).reshape(width, bins).cumsum(axis=1)
                hs = np.bincount(cell, h, width * bins).reshape(width, bins).cumsum(axis=1)
                all_g, all_h = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + ridge) + (all_g - gs) ** 2 / (all_h - hs + ridge) - all_g**2 / (all_h + ridge)
                at = gain[:, :-1].argmax(axis=1)
                better = gain[np.arange(width), at] > best
                best[better] = gain[np.arange(width), at][better]
                feature[first : first + width][better] = j
                cut[first : first + width][better] = at[better]
            node = 2 * node + 1 + (binned[np.arange(len(x)), feature[node]] > cut[node])
        leaf = node - (2**depth - 1)
        values = -rate * np.bincount(leaf, g, 2**depth) / (np.bincount(leaf, h, 2**depth) + ridge)
        score += values[leaf]
        model.features.append(feature)
        model.cuts.append(cut)
        model.leaves.append(values)
    return model
