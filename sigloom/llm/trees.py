"""Gradient-boosted decision trees for two classes, on numpy: binned features, logistic loss."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Tree:
    feature: np.ndarray  # of inner nodes, in heap order
    cut: np.ndarray  # go right if the bin is above
    value: np.ndarray  # of leaves

    def leaf(self, bins: np.ndarray) -> np.ndarray:
        at = np.zeros(len(bins), np.int64)
        rows = np.arange(len(bins))
        for _ in range(int(np.log2(len(self.value)))):
            at = 2 * at + 1 + (bins[rows, self.feature[at]] > self.cut[at])
        return at - len(self.feature)


class Boosted:
    """``margin`` is the log odds of class 1."""

    def __init__(self, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 32, ridge: float = 2.0):
        self.n_trees, self.depth, self.rate, self.n_bins, self.ridge = trees, depth, rate, bins, ridge
        self.trees: list[Tree] = []
        self.edges: list[np.ndarray] = []
        self.start = 0.0

    def _bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], axis=1).astype(np.int64)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.n_bins + 1)[1:-1])) for j in range(x.shape[1])]
        bins = self._bins(x)
        share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
        self.start = float(np.log(share / (1 - share)))
        margin = np.full(len(y), self.start)
        for _ in range(self.n_trees):
            p = 1 / (1 + np.exp(-margin))
            tree = self._grow(bins, p - y, p * (1 - p))
            self.trees.append(tree)
            margin += tree.value[tree.leaf(bins)]
        return self

    def _grow(self, bins: np.ndarray, g: np.ndarray, h: np.ndarray) -> Tree:
        inner = 2**self.depth - 1
        feature, cut = np.zeros(inner, np.int64), np.full(inner, self.n_bins, np.int64)
        at = np.zeros(len(g), np.int64)
        for level in range(self.depth):
            first, count = 2**level - 1, 2**level
            best = np.full(count, 1e-6)
            for j in range(bins.shape[1]):
                cell = (at - first) * self.n_bins + bins[:, j]
                hist = lambda w: np.bincount(cell, w, count * self.n_bins).reshape(count, -1).cumsum(axis=1)  # noqa: B023, E731
                gl, hl = hist(g), hist(h)
                gt, ht = gl[:, -1:], hl[:, -1:]
                gain = gl**2 / (hl + self.ridge) + (gt - gl) ** 2 / (ht - hl + self.ridge) - gt**2 / (ht + self.ridge)
                where = gain.argmax(axis=1)
                better = gain[np.arange(count), where] > best
                nodes = np.flatnonzero(better)
                best[nodes] = gain[nodes, where[nodes]]
                feature[first + nodes], cut[first + nodes] = j, where[nodes]
            at = 2 * at + 1 + (bins[np.arange(len(g)), feature[at]] > cut[at])
        leaf = at - inner
        gs, hs = np.bincount(leaf, g, inner + 1), np.bincount(leaf, h, inner + 1)
        return Tree(feature, cut, -self.rate * gs / (hs + self.ridge))

    def margin(self, x: np.ndarray) -> np.ndarray:
        bins = self._bins(x)
        total = np.full(len(x), self.start)
        for tree in self.trees:
            total += tree.value[tree.leaf(bins)]
        return total
