"""Histogram gradient-boosted trees for binary labels, flattened to arrays.

Fitting runs on a bounded table of features (the callers state the bound).
Values are cut into at most ``bins`` quantile bins; each level of a tree sums
gradients and hessians per (node, feature, bin) with one ``bincount`` per
feature and takes the best split.  Every tree is a perfect binary tree of
``depth`` levels stored in two arrays (split feature, threshold) and one of
leaf values, so a batch of rows walks all trees by index arithmetic alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Forest:
    """``feature``/``threshold``: (trees, 2**depth - 1); ``leaf``: (trees, 2**depth)."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    base: float
    depth: int

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                # a value above the threshold goes right
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += leaf[node - (2**self.depth - 1)]
        return out

    def predict(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.raw(x), -40, 40)))


def cut_points(x: np.ndarray, bins: int) -> list[np.ndarray]:
    cuts = []
    for column in x.T:
        values = np.unique(column)
        if len(values) > bins:
            values = np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1], method="lower"))
            cuts.append(values)
        else:
            cuts.append((values[1:] + values[:-1]) / 2)
    return cuts


def fit(
    x: np.ndarray,
    y: np.ndarray,
    trees: int = 80,
    depth: int = 4,
    rate: float = 0.15,
    bins: int = 64,
    l2: float = 1.0,
    min_hessian: float = 2.0,
) -> Forest:
    """Newton boosting of the logistic loss; rows must be finite numbers."""
    n, f = x.shape if x.ndim == 2 else (0, 1)
    mean = (y.sum() + 0.5) / (n + 1.0) if n else 0.5
    base = float(np.log(mean / (1 - mean)))
    inner, leaves = 2**depth - 1, 2**depth
    if n == 0 or f == 0:
        return Forest(np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, leaves)), base, depth)
    cuts = cut_points(x, bins)
    width = max(len(c) for c in cuts) + 1
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)])
    score = np.full(n, base)
    all_feature, all_threshold, all_leaf = [], [], []
    for _ in range(trees):
        p = 1.0 / (1.0 + np.exp(-score))
        grad, hess = y - p, np.maximum(p * (1 - p), 1e-9)
        node = np.zeros(n, dtype=np.int64)  # index within the level
        feature, threshold = np.zeros(inner, int), np.full(inner, np.inf)
        for level in range(depth):
            count = 2**level
            best_gain, best_f, best_b = np.full(count, 1e-6), np.zeros(count, int), np.full(count, -1)
            for j in range(f):
                if not len(cuts[j]):
                    continue
                key = node * width + binned[j]
                g = np.bincount(key, grad, count * width).reshape(count, width)
                h = np.bincount(key, hess, count * width).reshape(count, width)
                gl, hl = g.cumsum(1)[:, :-1], h.cumsum(1)[:, :-1]
                gt, ht = g.sum(1, keepdims=True), h.sum(1, keepdims=True)
                gr, hr = gt - gl, ht - hl
                gain = gl**2 / (hl + l2) + gr**2 / (hr + l2) - gt**2 / (ht + l2)
                gain[(hl < min_hessian) | (hr < min_hessian)] = -1
                gain[:, len(cuts[j]) :] = -1
                b = gain.argmax(1)
                top = gain[np.arange(count), b]
                better = top > best_gain
                best_gain[better], best_f[better], best_b[better] = top[better], j, b[better]
            first = count - 1
            for k in np.nonzero(best_b >= 0)[0]:
                feature[first + k], threshold[first + k] = best_f[k], cuts[best_f[k]][best_b[k]]
            slot = first + node
            node = 2 * node + (x[np.arange(n), feature[slot]] > threshold[slot])
        leaf = rate * np.bincount(node, grad, leaves) / (np.bincount(node, hess, leaves) + l2)
        score += leaf[node]
        all_feature.append(feature)
        all_threshold.append(threshold)
        all_leaf.append(leaf)
    return Forest(np.array(all_feature), np.array(all_threshold), np.array(all_leaf), base, depth)
