"""Histogram gradient-boosted trees in numpy: fitted on a bounded sample, flattened for vectorised scoring."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    """Complete binary trees of one depth as arrays ``(tree, node)``; a row goes right where it exceeds the cut."""

    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-odds per row: one gather and one comparison per level, for all rows and trees at once."""
        depth = int(np.log2(self.leaf.shape[1]))
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))[:, None]
        trees = np.arange(len(self.leaf))[None, :]
        node = np.zeros((len(x), len(self.leaf)), dtype=np.int64)
        for _ in range(depth):
            right = x[rows, self.feature[trees, node]] > self.cut[trees, node]
            node = 2 * node + 1 + right
        return out + self.leaf[trees, node - (2**depth - 1)].sum(axis=1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def constant(probability: float) -> Forest:
    """A forest of one tree that gives every row the same probability."""
    odds = float(np.log(probability / (1 - probability)))
    return Forest(np.zeros((1, 1), int), np.zeros((1, 1)), np.zeros((1, 2)), odds)


def fit(
    x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 64,
    penalty: float = 1.0, least: float = 1.0,
) -> Forest:
    """Boosting on the logistic loss; splits are searched in histograms of gradients over quantile bins.

    Ties between splits go to the lower feature and bin, so equal input gives equal trees. With one
    class only (or no rows) the forest is constant, and never quite certain.
    """
    n, k = x.shape
    share = (y.sum() + 1) / (n + 2)
    if n == 0 or y.min() == y.max():
        return constant(float(share) if n else 0.5)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(k)]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    base = float(np.log(share / (1 - share)))
    margin = np.full(n, base)
    nodes = 2**depth - 1
    feature, cut, leaf = np.zeros((trees, nodes), int), np.full((trees, nodes), np.inf), np.zeros((trees, nodes + 1))
    columns = np.arange(k)[None, :]
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = y - p, np.maximum(p * (1 - p), 1e-9)
        at = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            cell = (((at - first)[:, None] * k + columns) * bins + binned).ravel()
            size = width * k * bins
            g = np.bincount(cell, np.repeat(grad, k), size).reshape(width, k, bins).cumsum(axis=2)
            h = np.bincount(cell, np.repeat(hess, k), size).reshape(width, k, bins).cumsum(axis=2)
            gt, ht = g[:, :1, -1:], h[:, :1, -1:]
            gain = g**2 / (h + penalty) + (gt - g) ** 2 / (ht - h + penalty) - gt**2 / (ht + penalty)
            gain[(h < least) | (ht - h < least)] = -1
            best = gain.reshape(width, -1).argmax(axis=1)
            for i, b in enumerate(best):
                j, q = divmod(int(b), bins)
                if gain[i, j, q] > 1e-9 and q < len(cuts[j]):
                    feature[t, first + i], cut[t, first + i] = j, cuts[j][q]
            at = 2 * at + 1 + (x[np.arange(n), feature[t, at]] > cut[t, at])
        place = at - nodes
        value = np.bincount(place, grad, nodes + 1) / (np.bincount(place, hess, nodes + 1) + penalty)
        leaf[t] = rate * value
        margin += leaf[t, place]
    return Forest(feature, cut, leaf, base)
