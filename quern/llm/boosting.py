"""Gradient-boosted trees on binned features with logistic loss, and isotonic calibration, in numpy."""

from __future__ import annotations

import numpy as np


class Boosted:
    """Additive trees of fixed depth; each level of a tree tests `feature <= threshold` in every node."""

    def __init__(self, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32, l2: float = 1.0, least: int = 5):
        self.trees_wanted, self.depth, self.rate, self.bins, self.l2, self.least = trees, depth, rate, bins, l2, least
        self.base, self.trees = 0.0, []

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        p = min(max(float(y.mean()), 1e-4), 1 - 1e-4)
        self.base = float(np.log(p / (1 - p)))
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T, strict=True)], axis=1)
        raw = np.full(len(y), self.base)
        for _ in range(self.trees_wanted):
            prob = 1 / (1 + np.exp(-raw))
            tree, leaf = self._tree(binned, cuts, prob - y, prob * (1 - prob))
            self.trees.append(tree)
            raw += tree[2][leaf]
        return self

    def _tree(self, binned, cuts, g, h):
        n, columns = binned.shape
        node = np.zeros(n, dtype=np.int64)
        features, thresholds = [], []
        for level in range(self.depth):
            nodes = 1 << level
            feature, threshold, best = np.zeros(nodes, dtype=np.int64), np.full(nodes, np.inf), np.full(nodes, 1e-6)
            cut_bin = np.full(nodes, self.bins + 1)
            for f in range(columns):
                k = len(cuts[f])
                if not k:
                    continue
                at = node * (k + 1) + binned[:, f]
                gs, hs, ns = (np.bincount(at, w, nodes * (k + 1)).reshape(nodes, k + 1).cumsum(1) for w in (g, h, None))
                score = lambda a, b: a * a / (b + self.l2)
                gain = score(gs, hs) + score(gs[:, -1:] - gs, hs[:, -1:] - hs) - score(gs[:, -1:], hs[:, -1:])
                gain[(ns < self.least) | (ns[:, -1:] - ns < self.least)] = 0
                top = gain.argmax(1)
                value = gain[np.arange(nodes), top]
                better = value > best
                best[better], feature[better], cut_bin[better] = value[better], f, top[better]
                threshold[better] = cuts[f][np.minimum(top[better], k - 1)]
            node = 2 * node + (binned[np.arange(n), feature[node]] > cut_bin[node])
            features.append(feature)
            thresholds.append(threshold)
        leaves = 1 << self.depth
        value = -self.rate * np.bincount(node, g, leaves) / (np.bincount(node, h, leaves) + self.l2)
        return (features, thresholds, value), node

    def raw(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for features, thresholds, value in self.trees:
            node = np.zeros(len(x), dtype=np.int64)
            for f, t in zip(features, thresholds, strict=True):
                node = 2 * node + (x[rows, f[node]] > t[node])
            out += value[node]
        return out


class Isotonic:
    """Pool-adjacent-violators fit of probabilities to raw scores, linear between the pools."""

    def fit(self, raw: np.ndarray, y: np.ndarray) -> Isotonic:
        order = np.argsort(raw, kind="stable")
        pools: list[list[float]] = []  # sum of labels, count, sum of scores
        for r, label in zip(raw[order], y[order], strict=True):
            pools.append([float(label), 1.0, float(r)])
            while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
                last = pools.pop()
                pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
        self.x = np.array([p[2] / p[1] for p in pools])
        self.y = np.array([p[0] / p[1] for p in pools])
        return self

    def __call__(self, raw: np.ndarray) -> np.ndarray:
        return np.interp(raw, self.x, self.y)
