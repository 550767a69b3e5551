"""Gradient-boosted trees in numpy: histogram fitting with monotonic constraints, flat node arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    """All trees in one set of node arrays; a leaf points to itself."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def raw(self, x: np.ndarray) -> np.ndarray:
        at = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            goes_left = x[rows, self.feature[at]] <= self.threshold[at]
            at = np.where(goes_left, self.left[at], self.right[at])
        return self.base + self.value[at].sum(axis=1)

    def chance(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -40, 40)))


def fit(
    x: np.ndarray, y: np.ndarray, monotone: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15,
    bins: int = 64, ridge: float = 2.0, least: float = 5.0,
) -> Forest:
    """Logistic boosting of 0/1 labels.

    ``monotone`` holds -1, 0 or 1 per feature.  A split of a constrained feature must
    order its two values, and the subtrees keep to the two sides of their middle.
    """
    n, m = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    rate_of_ones = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(rate_of_ones / (1 - rate_of_ones)))
    raw = np.full(n, base)
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def node() -> int:
        k = len(feature)
        feature.append(0), threshold.append(0.0), left.append(k), right.append(k), value.append(0.0)
        return k

    def best_value(g, h, low, high):
        return np.clip(-g / (h + ridge), low, high)

    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        grad, hess = p - y, p * (1 - p)
        roots.append(node())
        todo = [(roots[-1], np.arange(n), 0, -np.inf, np.inf)]
        while todo:
            k, rows, level, low, high = todo.pop()
            g, h = grad[rows], hess[rows]
            value[k] = rate * float(best_value(g.sum(), h.sum(), low, high))
            best = (1e-6, None)
            if level < depth:
                gain_here = lambda g, v, h: -(g * v + 0.5 * (h + ridge) * v * v)
                whole = gain_here(g.sum(), best_value(g.sum(), h.sum(), low, high), h.sum())
                for j in range(m):
                    own = binned[rows, j]
                    gl = np.bincount(own, g, len(cuts[j]) + 1).cumsum()[:-1]
                    hl = np.bincount(own, h, len(cuts[j]) + 1).cumsum()[:-1]
                    nl = np.bincount(own, minlength=len(cuts[j]) + 1).cumsum()[:-1]
                    gr, hr = g.sum() - gl, h.sum() - hl
                    vl, vr = best_value(gl, hl, low, high), best_value(gr, hr, low, high)
                    gain = gain_here(gl, vl, hl) + gain_here(gr, vr, hr) - whole
                    allowed = (nl >= least) & (len(rows) - nl >= least) & (monotone[j] * (vr - vl) >= 0)
                    gain = np.where(allowed, gain, -np.inf)
                    if len(gain) and gain.max() > best[0]:
                        at = int(gain.argmax())
                        best = (gain[at], (j, at, float(vl[at]), float(vr[at])))
            if best[1] is None:
                raw[rows] += value[k]
                continue
            j, at, vl, vr = best[1]
            feature[k], threshold[k] = j, float(cuts[j][at])
            a, b = node(), node()
            left[k], right[k] = a, b
            goes_left = binned[rows, j] <= at
            middle = (vl + vr) / 2
            bounds = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle)), 0: ((low, high),) * 2}[int(monotone[j])]
            todo += [(a, rows[goes_left], level + 1, *bounds[0]), (b, rows[~goes_left], level + 1, *bounds[1])]
    arrays = (np.array(v) for v in (roots, feature, threshold, left, right, value))
    return Forest(*arrays, base, depth)
