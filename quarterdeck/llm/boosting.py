"""Gradient-boosted trees on a small table of numbers, and isotonic calibration."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Boosted:
    """Trees of fixed depth for the log-odds of label 1, grown on binned features."""

    cuts: list[np.ndarray]
    base: float
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    depth: int = 3

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(self.cuts)], axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        b, out = self.binned(x), np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (b[rows, feature[node]] > cut[node])
            out += value[node - (2**self.depth - 1)]
        return out


def fit_boosted(
    x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 48, l2: float = 2.0
) -> Boosted:
    """Second-order boosting of the logistic loss, level by level, best split of each node by
    histograms. Nodes that no split improves send all rows left."""
    levels = np.linspace(0, 1, bins + 1)[1:-1]
    cuts = [np.unique(np.quantile(x[:, j], levels)) for j in range(x.shape[1])]
    rate_of_one = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = Boosted(cuts, float(np.log(rate_of_one / (1 - rate_of_one))), depth=depth)
    b = model.binned(x)
    width = bins + 1
    score, rows = np.full(len(y), model.base), np.arange(len(y))
    inner = 2**depth - 1
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, width)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, many = 2**level - 1, 2**level
            at = node - first
            gain = np.zeros(many)
            for j in range(x.shape[1]):
                cell = at * width + b[:, j]
                gs = np.bincount(cell, g, many * width).reshape(many, width).cumsum(1)
                hs = np.bincount(cell, h, many * width).reshape(many, width).cumsum(1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                better = gs**2 / (hs + l2) + (gt - gs) ** 2 / (ht - hs + l2) - gt**2 / (ht + l2)
                better[(hs < 1) | (ht - hs < 1)] = 0
                best = better.argmax(1)
                value = better[np.arange(many), best]
                take = value > gain + 1e-9
                gain[take] = value[take]
                feature[first : first + many][take] = j
                cut[first : first + many][take] = best[take]
            node = 2 * node + 1 + (b[rows, feature[node]] > cut[node])
        leaf = node - inner
        value = -rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + l2)
        model.trees.append((feature, cut, value))
        score += value[leaf]
    return model


def fit_isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points of the increasing function of the score nearest to the labels (pool adjacent
    violators); between them it is read off linearly. Each pool is drawn towards a half by one row."""
    order = np.argsort(score, kind="stable")
    pools: list[list[float]] = []  # sum of labels, rows, sum of scores
    for s, label in zip(score[order], y[order], strict=True):
        pools.append([float(label), 1.0, float(s)])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            top = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], top, strict=True)]
    xs = np.array([p[2] / p[1] for p in pools])
    ys = np.array([(p[0] + 0.5) / (p[1] + 1) for p in pools])
    return xs, np.maximum.accumulate(ys)
