"""Small searches over everything, to compare the Spark operators with."""

import numpy as np


def best_split(x: np.ndarray, y: np.ndarray):
    """(gain, feature, threshold) by trying every midpoint of every feature, or None."""
    n, best = len(y), None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for low, high in zip(values, values[1:]):
            cut = (low + high) / 2
            left = x[:, f] <= cut
            a, b = y[left], y[~left]
            gain = len(a) * len(b) / n**2 * (a.mean() - b.mean()) ** 2
            if gain > 0 and (best is None or gain > best[0] * (1 + 1e-12)):
                best = (gain, f, cut)
    return best


def tree(x: np.ndarray, y: np.ndarray, depth: int, node: int = 1) -> dict:
    """node -> (feature, threshold, rows, mean)."""
    best = best_split(x, y) if depth > 0 and len(y) > 1 else None
    if best is None:
        return {node: (None, None, len(y), y.mean())}
    _, f, cut = best
    left = x[:, f] <= cut
    out = {node: (f, cut, len(y), y.mean())}
    out |= tree(x[left], y[left], depth - 1, 2 * node)
    out |= tree(x[~left], y[~left], depth - 1, 2 * node + 1)
    return out


def auc(y, score) -> float:
    pos = [s for s, v in zip(score, y) if v == 1]
    neg = [s for s, v in zip(score, y) if v == 0]
    if not pos or not neg:
        return 0.0
    return sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))


def descent(x: np.ndarray, y: np.ndarray, step: float, iterations: int, mean: bool = False) -> np.ndarray:
    x = np.c_[x, np.ones(len(y))]
    w = np.zeros(x.shape[1])
    for _ in range(iterations):
        g = x.T @ (1 / (1 + np.exp(-(x @ w))) - y)
        w = w - step * (g / len(y) if mean else g)
    return w
