"""Histogram gradient-boosted trees for a yes/no label, and isotonic calibration, in numpy.

Training works on a bounded sample held in memory; scoring works on any number of rows, batch by
batch. All trees of a model lie flattened in arrays: node i of a tree has its children at 2i + 1 and
2i + 2, every path has the same depth, and a batch walks all its rows down one level at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    """`feature` and `limit` per inner node, `leaf` per leaf, one row per tree; `base` is the prior log-odds."""

    base: float
    depth: int
    feature: np.ndarray
    limit: np.ndarray
    leaf: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, limit, leaf in zip(self.feature, self.limit, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > limit[node])
            total += leaf[node - len(feature)]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def _borders(column: np.ndarray, bins: int) -> np.ndarray:
    """Cut points between bins: quantiles, or all midpoints where there are few values."""
    values = np.unique(column)
    if len(values) > bins:
        values = np.unique(np.quantile(column, np.linspace(0, 1, bins)))
    return (values[1:] + values[:-1]) / 2


def train(
    x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.15,
    least_weight: float = 2.0, ridge: float = 1.0,
) -> Trees:
    """Newton boosting of the logistic loss. No rows: even odds; one class only: the smoothed prior."""
    n, width = x.shape
    prior = (y.sum() + 0.5) / (n + 1)
    base = float(np.log(prior / (1 - prior)))
    inner, leaves = 2**depth - 1, 2**depth
    borders = [_borders(x[:, f], bins) for f in range(width)]
    binned = np.stack([np.searchsorted(b, x[:, f], "left") for f, b in enumerate(borders)], axis=1) if n else np.zeros((0, width), int)
    wide = bins + 1
    slots = binned + np.arange(width) * wide
    score = np.full(n, base)
    made = []
    for _ in range(trees if n and 0 < y.sum() < n else 0):
        p = 1 / (1 + np.exp(-score))
        grad, hess = p - y, np.maximum(p * (1 - p), 1e-9)
        feature, limit = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(n, np.int64)  # within its level
        for level in range(depth):
            count = 2**level
            at = (node[:, None] * (width * wide) + slots).ravel()
            shape = (count, width, wide)
            g = np.bincount(at, np.repeat(grad, width), count * width * wide).reshape(shape).cumsum(axis=2)
            h = np.bincount(at, np.repeat(hess, width), count * width * wide).reshape(shape).cumsum(axis=2)
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + ridge) + (all_g - g)**2 / (all_h - h + ridge) - all_g**2 / (all_h + ridge)
            gain[(h < least_weight) | (all_h - h < least_weight)] = -np.inf
            best = gain.reshape(count, -1).argmax(axis=1)
            better = gain.reshape(count, -1)[np.arange(count), best] > 1e-6
            f, b = best // wide, best % wide
            for k in np.flatnonzero(better):
                feature[count - 1 + k], limit[count - 1 + k] = f[k], borders[f[k]][b[k]]
            node = 2 * node + (x[np.arange(n), feature[count - 1 + node]] > limit[count - 1 + node])
        g, h = np.bincount(node, grad, leaves), np.bincount(node, hess, leaves)
        leaf = -rate * g / (h + ridge)
        score += leaf[node]
        made.append((feature, limit, leaf))
    if not made:
        made = [(np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(leaves))]
    return Trees(base, depth, *(np.stack(part) for part in zip(*made)))


@dataclass(frozen=True)
class Isotonic:
    """A rising step function through pooled blocks, linear between their centres."""

    at: np.ndarray
    value: np.ndarray

    def __call__(self, score: np.ndarray) -> np.ndarray:
        return np.interp(score, self.at, self.value)


def isotonic(score: np.ndarray, y: np.ndarray, prior_rows: float = 1.0) -> Isotonic:
    """Pool adjacent violators; each pool is shrunk a little to the overall share. No rows: the identity."""
    if not len(score):
        return Isotonic(np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    order = np.argsort(score, kind="stable")
    pools: list[list[float]] = []
    for s, label in zip(score[order].tolist(), y[order].tolist()):
        pools.append([label, 1.0, s])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    share = float(np.mean(y))
    at = np.array([s / n for _, n, s in pools])
    value = np.array([(hits + share * prior_rows) / (n + prior_rows) for hits, n, _ in pools])
    return Isotonic(at, np.maximum.accumulate(value))
