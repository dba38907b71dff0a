"""Gradient-boosted trees for a two-class problem, in NumPy, with calibrated thresholds."""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """Trees of fixed depth on binned features, logistic loss, second-order leaf values."""

    def __init__(self, x: np.ndarray, y: np.ndarray, *, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 16, l2: float = 1.0):
        self.depth, self.trees = depth, []
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(v, c, side="left") for v, c in zip(cuts, x.T, strict=True)], axis=1) + bins * np.arange(x.shape[1])
        # no cut behind the last one of a feature
        none = np.array([[k >= len(v) for k in range(bins - 1)] for v in cuts])
        p = np.clip(y.mean(), 1e-6, 1 - 1e-6)
        self.base = np.log(p / (1 - p))
        z = np.full(len(y), self.base)
        for _ in range(trees):
            q = 1 / (1 + np.exp(-z))
            g, h = q - y, q * (1 - q)
            tree = self._grow(x, binned, none, g, h, cuts, l2, rate)
            self.trees.append(tree)
            z += self._leaf(tree, x)

    def _grow(self, x, binned, none, g, h, cuts, l2, rate):
        n = (1 << self.depth) - 1
        feature, cut, value = np.zeros(n, int), np.full(n, np.inf), np.zeros(n + 1)
        node = np.zeros(len(x), int)
        for at in range(n):
            rows = np.flatnonzero(node == at)
            if len(rows) > 1:
                gs, hs = g[rows].sum(), h[rows].sum()
                of, wide = binned[rows].ravel(), binned.shape[1]
                gl, hl = (np.cumsum(np.bincount(of, np.repeat(v[rows], wide), wide * (none.shape[1] + 1)).reshape(wide, -1), axis=1)[:, :-1] for v in (g, h))
                gain = gl**2 / (hl + l2) + (gs - gl) ** 2 / (hs - hl + l2) - gs**2 / (hs + l2)
                gain[none] = 0
                f, k = np.unravel_index(int(np.argmax(gain)), gain.shape)
                if gain[f, k] > 1e-6:
                    feature[at], cut[at] = f, cuts[f][k]
            node[rows] = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
        for leaf in range(n + 1):
            rows = node == n + leaf
            value[leaf] = -rate * g[rows].sum() / (h[rows].sum() + l2)
        return feature, cut, value

    def _leaf(self, tree, x):
        feature, cut, value = tree
        node = np.zeros(len(x), int)
        for _ in range(self.depth):
            node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > cut[node])
        return value[node - len(feature)]

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.base + sum(self._leaf(t, x) for t in self.trees)


class Calibrated:
    """Boosted trees with Platt scaling on held-out rows and, per kind, the lowest probability
    from which on the held-out rows reach ``precision``."""

    def __init__(self, x: np.ndarray, y: np.ndarray, kind: np.ndarray, kinds: int, precision: float, seed: int = 5, **shape: int):
        held = np.random.default_rng(seed).random(len(y)) < 0.4
        self.model = BoostedTrees(x[~held], y[~held], **shape)
        m, t = self.model.margin(x[held]), y[held]
        a, b = 1.0, 0.0
        for _ in range(50):
            p = 1 / (1 + np.exp(-(a * m + b)))
            g, w = np.array([((p - t) * m).sum() + 1e-3 * (a - 1), (p - t).sum()]), p * (1 - p) + 1e-9
            step = np.linalg.solve([[(w * m * m).sum() + 1e-3, (w * m).sum()], [(w * m).sum(), w.sum() + 1e-3]], g)
            a, b = a - step[0], b - step[1]
        self.a, self.b = a, b
        p = self.probability(x[held])
        self.threshold = np.full(kinds, 1.1)
        for k in range(kinds):
            of = kind[held] == k
            if of.any():
                order = np.argsort(-p[of], kind="stable")
                hit, sorted_p = np.cumsum(t[of][order]) / np.arange(1, of.sum() + 1), p[of][order]
                last = np.r_[sorted_p[1:] < sorted_p[:-1], True]  # all rows of one probability come or go together
                good = np.flatnonzero(last & (hit >= precision))
                if len(good):
                    self.threshold[k] = max(0.5, p[of][order][good[-1]])

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.a * self.model.margin(x) + self.b)))
