"""Gradient-boosted trees on histograms of binned features, for two classes.

Training runs on a bounded sample in memory. A model is three arrays of complete binary trees,
so scoring steps all rows and all trees down one level at a time with numpy indexing.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np


class Trees(NamedTuple):
    """Node ``k`` of a tree has the children ``2k + 1`` (feature <= threshold) and ``2k + 2``."""

    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray  # trees x inner nodes
    value: np.ndarray  # trees x leaves
    prior: float


def constant(rate: float) -> Trees:
    """A model without trees, which scores every row alike."""
    rate = min(max(rate, 1e-6), 1 - 1e-6)
    return Trees(np.zeros((0, 0), np.int64), np.zeros((0, 0)), np.zeros((0, 1)), float(np.log(rate / (1 - rate))))


def fit(x: np.ndarray, y: np.ndarray, *, trees: int = 120, depth: int = 4, rate: float = 0.1, bins: int = 64, least: float = 5.0, l2: float = 1.0) -> Trees:
    """Trees for labels 0 and 1; equal input gives equal trees. ``least``: hessian of a leaf."""
    if len(y) == 0 or y.min() == y.max():
        return constant((float(np.sum(y)) + 0.5) / (len(y) + 1))
    x = np.asarray(x, dtype=np.float64)
    n, width = x.shape
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins)[1:-1])) for f in range(width)]
    cell = np.stack([np.searchsorted(cuts[f], x[:, f], side="left") for f in range(width)], axis=1) + np.arange(width) * bins
    model = constant(float(np.mean(y)))
    margin = np.full(n, model.prior)
    inner, leaves = (1 << depth) - 1, 1 << depth
    feature, threshold, value = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves))
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            at = (node[:, None] * (width * bins) + cell).ravel()
            size = (1 << level) * width * bins
            shape = (1 << level, width, bins)
            left_g = np.bincount(at, np.repeat(g, width), size).reshape(shape).cumsum(axis=2)
            left_h = np.bincount(at, np.repeat(h, width), size).reshape(shape).cumsum(axis=2)
            all_g, all_h = left_g[:, :1, -1:], left_h[:, :1, -1:]
            right_g, right_h = all_g - left_g, all_h - left_h
            gain = left_g**2 / (left_h + l2) + right_g**2 / (right_h + l2) - all_g**2 / (all_h + l2)
            gain[(left_h < least) | (right_h < least)] = 0
            best = gain.reshape(1 << level, -1).argmax(axis=1)
            first = (1 << level) - 1
            split = np.full((1 << level, 2), [0, bins], dtype=np.int64)  # nothing goes right
            for k, b in enumerate(best):
                f, c = divmod(int(b), bins)
                if gain[k, f, c] > 1e-9 and c < len(cuts[f]):
                    split[k] = f, c
                    feature[t, first + k], threshold[t, first + k] = f, cuts[f][c]
            right = cell[np.arange(n), split[node, 0]] - split[node, 0] * bins > split[node, 1]
            node = 2 * node + right
        leaf_g, leaf_h = np.bincount(node, g, leaves), np.bincount(node, h, leaves)
        value[t] = -rate * leaf_g / (leaf_h + l2)
        margin += value[t][node]
    return model._replace(feature=feature, threshold=threshold, value=value)


def predict(model: Trees, x: np.ndarray) -> np.ndarray:
    """Probability of label 1 for each row."""
    x = np.asarray(x, dtype=np.float64)
    trees, inner = model.feature.shape
    margin = np.full(len(x), model.prior)
    if trees and len(x):
        rows, own = np.arange(len(x))[:, None], np.arange(trees)[None, :]
        node = np.zeros((len(x), trees), dtype=np.int64)
        for _ in range((inner + 1).bit_length() - 1):
            node = 2 * node + 1 + (x[rows, model.feature[own, node]] > model.threshold[own, node])
        margin += model.value[own, node - inner].sum(axis=1)
    return 1 / (1 + np.exp(-margin))
