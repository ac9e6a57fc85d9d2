"""Histogram gradient-boosted trees for a 0/1 label, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Complete binary trees as arrays: row t holds tree t, node i has children 2i + 1 and 2i + 2."""

    feature: np.ndarray  # (trees, inner nodes)
    threshold: np.ndarray  # (trees, inner nodes): right if the value is larger
    value: np.ndarray  # (trees, leaves)
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row; all rows walk down one level at a time."""
        inner = self.feature.shape[1]
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), np.int64)
            while len(node) and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += value[node - inner]
        return 1 / (1 + np.exp(-total))


def fit(
    x: np.ndarray,
    y: np.ndarray,
    rounds: int = 80,
    depth: int = 4,
    rate: float = 0.15,
    bins: int = 64,
    ridge: float = 1.0,
    least: float = 5.0,
) -> Trees:
    """Fit on a bounded sample. Without rows or with one class the score is the smoothed share of label 1."""
    x = np.asarray(x, np.float64)
    prior = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(prior / (1 - prior)))
    inner, leaves = (1 << depth) - 1, 1 << depth
    columns = max(1, x.shape[1])
    if len(y) == 0 or y.min() == y.max():
        return Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)), base)
    # Quantile bins: value v falls into bin searchsorted(edges, v), so "bin > b" is "v > edges[b]".
    edges = []
    for column in x.T:
        edge = np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1], method="lower"))
        edges.append(np.append(edge, np.full(bins - 1 - len(edge), np.inf)))
    edges = np.array(edges)
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)
    margin = np.full(len(y), base)
    out = []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, p * (1 - p)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            width = 1 << level
            at = node - (width - 1)
            g, h = (_histograms(binned, at, w, width, bins) for w in (grad, hess))
            gain, bin_ = _best(g, h, ridge, least)
            chosen = gain.reshape(width, -1).argmax(axis=1)
            use = gain.reshape(width, -1)[np.arange(width), chosen] > 1e-9
            best_bin = bin_.reshape(width, -1)[np.arange(width), chosen]
            first = width - 1
            feature[first : first + width] = chosen % columns
            threshold[first : first + width] = np.where(use, edges[chosen % columns, best_bin], np.inf)
            cut = np.where(use, best_bin, bins)
            node = 2 * node + 1 + (binned[np.arange(len(y)), feature[node]] > cut[at])
        leaf = node - inner
        value = -rate * np.bincount(leaf, grad, leaves) / (np.bincount(leaf, hess, leaves) + ridge)
        margin += value[leaf]
        out.append((feature, threshold, value))
    return Trees(*(np.array(a) for a in zip(*out)), base)


def _histograms(binned: np.ndarray, node: np.ndarray, weight: np.ndarray, width: int, bins: int) -> np.ndarray:
    """Sums of ``weight`` by node, feature and bin."""
    out = [np.bincount(node * bins + c, weight, width * bins).reshape(width, bins) for c in binned.T]
    return np.stack(out, axis=1)


def _best(g: np.ndarray, h: np.ndarray, ridge: float, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Best gain and its bin for each node and feature."""
    left_g, left_h = g.cumsum(axis=2)[:, :, :-1], h.cumsum(axis=2)[:, :, :-1]
    all_g, all_h = g.sum(axis=2, keepdims=True), h.sum(axis=2, keepdims=True)
    right_g, right_h = all_g - left_g, all_h - left_h
    gain = left_g**2 / (left_h + ridge) + right_g**2 / (right_h + ridge) - all_g**2 / (all_h + ridge)
    gain[(left_h < least / 4) | (right_h < least / 4)] = -1.0
    best = gain.argmax(axis=2)
    return np.take_along_axis(gain, best[:, :, None], axis=2)[:, :, 0], best
