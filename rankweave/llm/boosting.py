"""Small gradient-boosted trees for the logistic loss, fitted and applied in numpy on bounded samples."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Boosted:
    """Complete trees of equal depth: `feature` and `cut` by tree and inner node, `leaf` by tree and leaf."""

    base: float
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(int(np.log2(len(leaf)))):
                at = 2 * at + 1 + (x[np.arange(len(x)), feature[at]] > cut[at])
            out += leaf[at - (len(leaf) - 1)]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -35, 35)))


def boost(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.3, ridge: float = 1.0, bins: int = 64) -> Boosted:
    """Newton boosting with splits halfway between up to `bins` + 1 quantiles of each feature."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(share / (1 - share)))
    marks = [np.unique(np.quantile(f, np.linspace(0, 1, bins + 1))) if len(f) else np.zeros(0) for f in x.T]
    cuts = [(m[1:] + m[:-1]) / 2 for m in marks]
    coded = np.stack([np.searchsorted(c, f, "left") for c, f in zip(cuts, x.T, strict=True)], axis=1) if len(x) else np.zeros((0, x.shape[1]), int)
    features, thresholds, leaves = [], [], []
    margin = np.full(len(y), base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        at = np.zeros(len(y), np.int64)
        feature, cut = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, np.inf)
        for level in range(depth):
            for node in range(2**level - 1, 2 ** (level + 1) - 1):
                here = np.flatnonzero(at == node)
                best = 1e-6
                for f in range(x.shape[1]):
                    if not len(cuts[f]) or not len(here):
                        continue
                    gs = np.cumsum(np.bincount(coded[here, f], g[here], minlength=len(cuts[f]) + 1))
                    hs = np.cumsum(np.bincount(coded[here, f], h[here], minlength=len(cuts[f]) + 1))
                    gain = (gs**2 / (hs + ridge) + (gs[-1] - gs) ** 2 / (hs[-1] - hs + ridge) - gs[-1] ** 2 / (hs[-1] + ridge))[:-1]
                    k = int(gain.argmax())
                    if gain[k] > best:
                        best, feature[node], cut[node] = gain[k], f, cuts[f][k]
            at = 2 * at + 1 + (x[np.arange(len(x)), feature[at]] > cut[at])
        slot = at - (2**depth - 1)
        leaf = rate * np.bincount(slot, g, minlength=2**depth) / (np.bincount(slot, h, minlength=2**depth) + ridge)
        margin = margin + leaf[slot]
        features.append(feature)
        thresholds.append(cut)
        leaves.append(leaf)
    return Boosted(base, np.array(features), np.array(thresholds), np.array(leaves))
