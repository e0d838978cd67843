"""Gradient-boosted trees for a 0/1 label on numpy arrays, by histograms of quantile bins.

Small on purpose: training takes a bounded sample, prediction is array code
that runs inside tasks.
"""

from __future__ import annotations

import numpy as np

BINS = 32


class Boosted:
    """Logistic loss, Newton leaves, trees of fixed depth."""

    def __init__(self, rounds: int = 60, depth: int = 4, rate: float = 0.2, ridge: float = 1.0, least: int = 20):
        self.rounds, self.depth, self.rate, self.ridge, self.least = rounds, depth, rate, ridge, least

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        n, width = x.shape
        self.cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(width)]
        binned = self._bin(x)
        share = min(max(y.mean() if n else 0.5, 1e-3), 1 - 1e-3)
        self.base = float(np.log(share / (1 - share)))
        self.trees = []
        score = np.full(n, self.base)
        for _ in range(self.rounds if n else 0):
            p = 1 / (1 + np.exp(-score))
            tree = self._grow(binned, p - y, p * (1 - p))
            self.trees.append(tree)
            score += tree[2][self._leaf(binned, tree)]
        return self

    def _bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(self.cuts)], 1).astype(np.uint8)

    def _grow(self, binned, grad, hess):
        """(feature, last bin that goes left, value) by heap position; a node that isn't split sends all rows left."""
        n, width = binned.shape
        size = 1 << self.depth
        feature, cut, value = np.zeros(size, int), np.full(size, BINS), np.zeros(2 * size)
        at = np.ones(n, int)
        offsets = np.arange(width) * BINS
        for level in range(self.depth):
            first = 1 << level
            slot = ((at - first)[:, None] * (width * BINS) + offsets + binned).ravel()
            shape = (first, width, BINS)
            g, h, c = (np.bincount(slot, w, first * width * BINS).reshape(shape).cumsum(2)
                       for w in (np.repeat(grad, width), np.repeat(hess, width), None))
            total_g, total_h, total_c = g[:, :, -1:], h[:, :, -1:], c[:, :, -1:]
            gain = g ** 2 / (h + self.ridge) + (total_g - g) ** 2 / (total_h - h + self.ridge) - total_g ** 2 / (total_h + self.ridge)
            gain[(c < self.least) | (total_c - c < self.least)] = 0
            flat = gain.reshape(first, -1)
            best = flat.argmax(1)
            good = flat[np.arange(first), best] > 1e-6
            feature[first:2 * first] = np.where(good, best // BINS, 0)
            cut[first:2 * first] = np.where(good, best % BINS, BINS)
            at = 2 * at + (binned[np.arange(n), feature[at]] > cut[at])
        g, h = (np.bincount(at, w, 2 * size) for w in (grad, hess))
        value[:] = -self.rate * g / (h + self.ridge)
        return feature, cut, value

    def _leaf(self, binned, tree):
        feature, cut, _ = tree
        at, rows = np.ones(len(binned), int), np.arange(len(binned))
        for _ in range(self.depth):
            at = 2 * at + (binned[rows, feature[at]] > cut[at])
        return at

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Log odds."""
        binned = self._bin(x)
        out = np.full(len(x), self.base)
        for tree in self.trees:
            out += tree[2][self._leaf(binned, tree)]
        return out
