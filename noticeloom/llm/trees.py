"""Gradient-boosted trees for several classes over small dense samples (softmax loss, histogram splits)."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@dataclass
class Forest:
    """Trees of fixed depth: node i has children 2i+1 and 2i+2; a row goes right if its value exceeds the threshold."""

    classes: int
    depth: int
    base: np.ndarray
    feature: list[np.ndarray] = field(default_factory=list)
    threshold: list[np.ndarray] = field(default_factory=list)
    leaf: list[np.ndarray] = field(default_factory=list)
    scale: np.ndarray | None = None
    shift: np.ndarray | None = None

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.tile(self.base, (len(x), 1))
        rows = np.arange(len(x))
        for t, (feature, threshold, leaf) in enumerate(zip(self.feature, self.threshold, self.leaf)):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out[:, t % self.classes] += leaf[node - (2**self.depth - 1)]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = self.margin(x)
        return softmax(z if self.scale is None else z * self.scale + self.shift)


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, classes: int, rounds: int = 40, depth: int = 4, rate: float = 0.2, bins: int = 32, least: float = 1.0) -> Forest:
    """Boosting on x (rows, features) with classes y in 0..classes-1. Deterministic."""
    n, m = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1)
    prior = np.array([weight[y == k].sum() + 1 for k in range(classes)])
    forest = Forest(classes, depth, np.log(prior / prior.sum()))
    z, wanted = np.tile(forest.base, (n, 1)), np.eye(classes)[y]
    columns = np.arange(m) * bins
    for _ in range(rounds):
        p = softmax(z)
        for k in range(classes):
            g, h = weight * (wanted[:, k] - p[:, k]), weight * p[:, k] * (1 - p[:, k]) + 1e-9
            feature, threshold = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, np.inf)
            node = np.zeros(n, np.int64)
            for level in range(depth):
                first, wide = 2**level - 1, 2**level
                place = ((node - first)[:, None] * (m * bins) + columns + binned).ravel()
                gs, hs = (np.bincount(place, np.repeat(v, m), wide * m * bins).reshape(wide, m, bins).cumsum(axis=2) for v in (g, h))
                gt, ht = gs[:, :1, -1:], hs[:, :1, -1:]
                gain = gs**2 / (hs + 1) + (gt - gs) ** 2 / (ht - hs + 1) - gt**2 / (ht + 1)
                gain[(hs < least) | (ht - hs < least)] = 0
                best = gain.reshape(wide, -1).argmax(axis=1)
                for i, b in enumerate(best):
                    j, cut = divmod(int(b), bins)
                    if gain[i, j, cut] > 1e-6 and cut < len(edges[j]):
                        feature[first + i], threshold[first + i] = j, edges[j][cut]
                node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
            node -= 2**depth - 1
            leaf = rate * np.bincount(node, g, 2**depth) / (np.bincount(node, h, 2**depth) + 1)
            z[:, k] += leaf[node]
            forest.feature.append(feature)
            forest.threshold.append(threshold)
            forest.leaf.append(leaf)
    return forest


def calibrate(forest: Forest, x: np.ndarray, y: np.ndarray, least: int = 30, steps: int = 300) -> Forest:
    """One scale and a shift for each class, fitted on held-out rows; fewer than `least` rows leave the forest as it is."""
    if len(y) < least:
        return forest
    z, wanted = forest.margin(x), np.eye(forest.classes)[y]
    scale, shift = 1.0, np.zeros(forest.classes)
    for _ in range(steps):
        d = softmax(z * scale + shift) - wanted
        scale = max(0.05, scale - 0.05 * ((d * z).sum(axis=1).mean() + 0.01 * (scale - 1)))
        shift = shift - 0.5 * (d.mean(axis=0) + 0.01 * shift)
    forest.scale, forest.shift = np.full(forest.classes, scale), shift
    return forest
