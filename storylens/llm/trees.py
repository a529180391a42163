"""Gradient-boosted trees for a few classes, on binned features."""

from __future__ import annotations

import numpy as np

ROUNDS, DEPTH, BINS, RATE, LEAST, RIDGE = 40, 4, 32, 0.2, 20, 1.0


class Boosted:
    """Softmax boosting: each round fits one tree for each class to the gradient."""

    def __init__(self, features: np.ndarray, labels: np.ndarray, classes: int, rounds: int = ROUNDS, depth: int = DEPTH):
        self.depth = depth
        shares = np.linspace(0, 1, BINS + 1)[1:-1]
        self.cuts = [np.unique(np.quantile(features[:, f], shares)).astype(np.float32) for f in range(features.shape[1])]
        binned = self._binned(features)
        self.prior = np.log((np.bincount(labels, minlength=classes) + 1) / (len(labels) + classes))
        margin = np.tile(self.prior, (len(labels), 1))
        truth = np.eye(classes)[labels]
        self.trees: list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = []
        for _ in range(rounds):
            p = _softmax(margin)
            row = []
            for c in range(classes):
                tree = self._tree(binned, truth[:, c] - p[:, c], np.maximum(p[:, c] * (1 - p[:, c]), 1e-6))
                margin[:, c] += self._values(tree, binned)
                row.append(tree)
            self.trees.append(row)

    def _binned(self, features: np.ndarray) -> np.ndarray:
        out = np.zeros(features.shape, np.uint8)
        for f, cuts in enumerate(self.cuts):
            out[:, f] = np.searchsorted(cuts, features[:, f].astype(np.float32), side="right")
        return out

    def _tree(self, binned: np.ndarray, grad: np.ndarray, hess: np.ndarray):
        """A complete tree as arrays: feature and last bin to the left for each inner node, values of the leaves."""
        inner = (1 << self.depth) - 1
        feature, cut = np.zeros(inner, np.int64), np.full(inner, 255, np.uint8)
        node = np.zeros(len(grad), np.int64)
        for level in range(self.depth):
            first, n = (1 << level) - 1, 1 << level
            own = node - first
            best_gain = np.full(n, 1e-6)
            total_g, total_h = np.bincount(own, grad, n), np.bincount(own, hess, n)
            rows = np.bincount(own, minlength=n)
            for f in range(binned.shape[1]):
                at = own * BINS + binned[:, f]
                g = np.bincount(at, grad, n * BINS).reshape(n, BINS).cumsum(1)[:, :-1]
                h = np.bincount(at, hess, n * BINS).reshape(n, BINS).cumsum(1)[:, :-1]
                k = np.bincount(at, minlength=n * BINS).reshape(n, BINS).cumsum(1)[:, :-1]
                rest_g, rest_h = total_g[:, None] - g, total_h[:, None] - h
                gain = g * g / (h + RIDGE) + rest_g * rest_g / (rest_h + RIDGE) - (total_g ** 2 / (total_h + RIDGE))[:, None]
                gain[(k < LEAST) | (rows[:, None] - k < LEAST)] = 0
                place = gain.argmax(1)
                top = gain[np.arange(n), place]
                better = top > best_gain
                best_gain[better] = top[better]
                feature[first:first + n][better] = f
                cut[first:first + n][better] = place[better]
            node = 2 * node + 1 + (binned[np.arange(len(node)), feature[node]] > cut[node])
        leaf = node - inner
        value = RATE * np.bincount(leaf, grad, inner + 1) / (np.bincount(leaf, hess, inner + 1) + RIDGE)
        return feature, cut, value

    def _values(self, tree, binned: np.ndarray) -> np.ndarray:
        feature, cut, value = tree
        node = np.zeros(len(binned), np.int64)
        rows = np.arange(len(binned))
        for _ in range(self.depth):
            node = 2 * node + 1 + (binned[rows, feature[node]] > cut[node])
        return value[node - len(feature)]

    def log_probabilities(self, features: np.ndarray) -> np.ndarray:
        binned = self._binned(features)
        margin = np.tile(self.prior, (len(features), 1))
        for row in self.trees:
            for c, tree in enumerate(row):
                margin[:, c] += self._values(tree, binned)
        return np.log(np.maximum(_softmax(margin), 1e-6))


def _softmax(margin: np.ndarray) -> np.ndarray:
    e = np.exp(margin - margin.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)
