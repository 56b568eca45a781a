"""Gradient-boosted trees in numpy: logistic loss, histogram splits, isotonic calibration."""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """Trees of a fixed depth over binned features; each leaf has a Newton step of the logistic loss."""

    def __init__(self, rounds: int = 40, depth: int = 3, rate: float = 0.2, bins: int = 32, l2: float = 1.0):
        self.rounds, self.depth, self.rate, self.bins, self.l2 = rounds, depth, rate, bins, l2

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> BoostedTrees:
        weight = np.ones(len(y)) if weight is None else weight
        self.cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(x.shape[1])]
        binned = self._binned(x)
        share = min(max(np.average(y, weights=weight), 1e-3), 1 - 1e-3)
        self.base = float(np.log(share / (1 - share)))
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        margin = np.full(len(y), self.base)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-margin))
            tree = self._tree(binned, weight * (p - y), weight * np.maximum(p * (1 - p), 1e-6))
            self.trees.append(tree)
            margin += self._leaf(tree, binned)
        return self

    def margin(self, x: np.ndarray) -> np.ndarray:
        binned = self._binned(x)
        return self.base + sum((self._leaf(t, binned) for t in self.trees), np.zeros(len(x)))

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.asfortranarray(np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(self.cuts)], 1)) if len(x) else np.zeros((0, len(self.cuts)), int)

    def _tree(self, b: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Level by level: one histogram of a feature serves all nodes of a level."""
        inner, bins = (1 << self.depth) - 1, self.bins + 1
        feature, cut, node = np.zeros(inner, int), np.full(inner, self.bins), np.zeros(len(b), int)
        for level in range(self.depth):
            first, wide = (1 << level) - 1, 1 << level
            best, at = np.full(wide, 1e-9), (node - first) * bins
            total_g, total_h = (np.bincount(node - first, weights=w, minlength=wide)[:, None] for w in (g, h))
            whole = total_g**2 / (total_h + self.l2)
            for j in range(b.shape[1]):
                if not len(self.cuts[j]):
                    continue
                gl, hl = (np.bincount(at + b[:, j], weights=w, minlength=wide * bins).reshape(wide, bins).cumsum(1) for w in (g, h))
                gain = gl**2 / (hl + self.l2) + (total_g - gl) ** 2 / (total_h - hl + self.l2) - whole
                top = gain.argmax(1)
                gain = gain[np.arange(wide), top]
                better = np.flatnonzero(gain > best)
                best[better], feature[first + better], cut[first + better] = gain[better], j, top[better]
            node = 2 * node + 1 + (b[np.arange(len(b)), feature[node]] > cut[node])
        leaf = node - inner
        n = 1 << self.depth
        value = -self.rate * np.bincount(leaf, weights=g, minlength=n) / (np.bincount(leaf, weights=h, minlength=n) + self.l2)
        return feature, cut, value

    def _leaf(self, tree: tuple[np.ndarray, np.ndarray, np.ndarray], b: np.ndarray) -> np.ndarray:
        feature, cut, value = tree
        node = np.zeros(len(b), int)
        for _ in range(self.depth):
            node = 2 * node + 1 + (b[np.arange(len(b)), feature[node]] > cut[node])
        return value[node - len(feature)]


class Isotonic:
    """Calibrated probabilities: the best non-decreasing fit of labels to margins, by pooling violators."""

    def fit(self, margin: np.ndarray, y: np.ndarray) -> Isotonic:
        order = np.argsort(margin, kind="stable")
        pools: list[list[float]] = []
        for m, v in zip(margin[order], y[order].astype(float), strict=True):
            pools.append([v, 1.0, m])
            while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
                v2, n2, m2 = pools.pop()
                v1, n1, _ = pools[-1]
                pools[-1] = [(v1 * n1 + v2 * n2) / (n1 + n2), n1 + n2, m2]
        self.upto = np.array([p[2] for p in pools])
        # One virtual example on either side keeps a pool of few from certainty.
        self.value = np.array([(p[0] * p[1] + 0.5) / (p[1] + 1) for p in pools])
        return self

    def __call__(self, margin: np.ndarray) -> np.ndarray:
        if not len(self.upto):
            return np.zeros(len(margin))
        return self.value[np.minimum(np.searchsorted(self.upto, margin, "left"), len(self.value) - 1)]
