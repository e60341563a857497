"""Gradient-boosted regression trees for a yes-or-no label, on binned features."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Bins of a feature.
BINS = 32


@dataclass
class Boosted:
    """Trees of one depth as arrays: feature and bin of each inner node, value of each leaf."""

    cuts: list[np.ndarray]
    feature: np.ndarray  # trees x (2**depth - 1)
    split: np.ndarray
    value: np.ndarray  # trees x 2**depth
    base: float
    depth: int

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, k], side="left") for k, c in enumerate(self.cuts)], axis=1).astype(np.int16) if len(x) else np.zeros(x.shape, np.int16)

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1."""
        b = self.binned(x)
        total = np.full(len(b), self.base)
        rows = np.arange(len(b))
        for feature, split, value in zip(self.feature, self.split, self.value, strict=True):
            node = np.zeros(len(b), dtype=np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (b[rows, feature[node]] > split[node])
            total += value[node - (len(feature))]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, *, trees: int = 40, depth: int = 3, rate: float = 0.3, ridge: float = 1.0) -> Boosted:
    """Newton boosting on the logistic loss; each level splits every node at its best histogram cut."""
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) for k in range(x.shape[1])]
    inner = 2**depth - 1
    model = Boosted(cuts, np.zeros((0, inner), np.int64), np.zeros((0, inner), np.int64), np.zeros((0, inner + 1)), float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))), depth)
    b = model.binned(x).astype(np.int64)
    score = np.full(len(y), model.base)
    features, splits, values = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        node = np.zeros(len(y), dtype=np.int64)
        feature, split = np.zeros(inner, np.int64), np.full(inner, BINS)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            best = np.zeros(count)
            for k in range(x.shape[1]):
                at = (node - first) * (BINS + 1) + b[:, k]
                gs, hs = (np.bincount(at, weights=w, minlength=count * (BINS + 1)).reshape(count, BINS + 1).cumsum(axis=1) for w in (g, h))
                gain = gs**2 / (hs + ridge) + (gs[:, -1:] - gs) ** 2 / (hs[:, -1:] - hs + ridge) - gs[:, -1:] ** 2 / (hs[:, -1:] + ridge)
                top = gain.argmax(axis=1)
                better = gain[np.arange(count), top] > best + 1e-9
                best = np.where(better, gain[np.arange(count), top], best)
                feature[first : first + count][better] = k
                split[first : first + count][better] = top[better]
            node = 2 * node + 1 + (b[np.arange(len(y)), feature[node]] > split[node])
        leaf = node - inner
        value = rate * np.bincount(leaf, weights=g, minlength=inner + 1) / (np.bincount(leaf, weights=h, minlength=inner + 1) + ridge)
        score = score + value[leaf]
        features.append(feature)
        splits.append(split)
        values.append(value)
    model.feature, model.split, model.value = np.array(features), np.array(splits), np.array(values)
    return model
