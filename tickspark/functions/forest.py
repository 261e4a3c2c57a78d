"""A small forest of shallow trees over a bounded sample, for use inside a task."""

from __future__ import annotations

import numpy as np

BINS = 32


def binned(x: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Each column cut at its quantiles."""
    edges = np.quantile(x, np.arange(1, bins) / bins, axis=0)
    return np.stack([np.searchsorted(np.unique(edges[:, j]), x[:, j], side="left") for j in range(x.shape[1])], axis=1)


def auc(score: np.ndarray, label: np.ndarray) -> float:
    """The share of (1, 0) pairs in the right order, ties as half."""
    values, of = np.unique(score, return_inverse=True)
    ones, zeros = np.bincount(of, label, len(values)), np.bincount(of, 1 - label, len(values))
    if not ones.sum() or not zeros.sum():
        return float("nan")
    return float((ones * (np.cumsum(zeros) - zeros / 2)).sum() / (ones.sum() * zeros.sum()))


class Forest:
    """Bootstrapped trees that split on the best of a random choice of columns by Gini impurity; leaves hold the share of ones."""

    def __init__(self, trees: int = 50, depth: int = 3, seed: int = 42):
        self.trees, self.depth, self.rng = trees, depth, np.random.default_rng(seed)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Forest:
        """``x``: binned columns."""
        self.importance, self.roots = np.zeros(x.shape[1]), []
        self.levels, self.columns = int(x.max(initial=0)) + 1, max(1, round(x.shape[1] ** 0.5))
        for _ in range(self.trees):
            weight = np.bincount(self.rng.integers(0, len(y), len(y)), minlength=len(y)).astype(float)
            self.roots.append(self._node(x, y, weight, self.depth))
        total = self.importance.sum()
        self.importance = self.importance / total if total else self.importance
        return self

    def _node(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, depth: int):
        n, ones = weight.sum(), (weight * y).sum()
        best = None
        if depth and 0 < ones < n:
            for j in self.rng.choice(x.shape[1], self.columns, replace=False):
                left, left_ones = (np.cumsum(np.bincount(x[:, j], w, self.levels))[:-1] for w in (weight, weight * y))
                right, right_ones = n - left, ones - left_ones
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.nan_to_num(left_ones**2 / left) + np.nan_to_num(right_ones**2 / right) - ones**2 / n
                gain[(left == 0) | (right == 0)] = -1
                if len(gain) and (best is None or gain.max() > best[0]):
                    best = (gain.max(), int(j), int(gain.argmax()))
        if best is None or best[0] <= 1e-12:
            return ones / n if n else 0.5
        _, j, cut = best
        self.importance[j] += best[0]
        low = x[:, j] <= cut
        return j, cut, self._node(x[low], y[low], weight[low], depth - 1), self._node(x[~low], y[~low], weight[~low], depth - 1)

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x))
        for root in self.roots:
            stack = [(root, np.arange(len(x)))]
            while stack:
                node, rows = stack.pop()
                if isinstance(node, tuple):
                    low = x[rows, node[0]] <= node[1]
                    stack += [(node[2], rows[low]), (node[3], rows[~low])]
                else:
                    out[rows] += node
        return out / len(self.roots)
