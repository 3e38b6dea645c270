"""Sparse feature rows in flat arrays and the small linear models that are trained on bounded samples of them."""

from __future__ import annotations

import numpy as np


class Rows:
    """Sparse rows: ``at`` are row offsets into ``col`` and ``val``."""

    def __init__(self, at: np.ndarray, col: np.ndarray, val: np.ndarray):
        self.at, self.col, self.val = at, col, val
        self.row = np.repeat(np.arange(len(at) - 1), np.diff(at))

    def __len__(self) -> int:
        return len(self.at) - 1

    def dot(self, w: np.ndarray) -> np.ndarray:
        """Each row's product with ``w`` (features, or features x outputs)."""
        if w.ndim == 1:
            return np.bincount(self.row, self.val * w[self.col], len(self))
        return np.stack([np.bincount(self.row, self.val * w[self.col, k], len(self)) for k in range(w.shape[1])], 1)

    def back(self, g: np.ndarray, n: int) -> np.ndarray:
        """Sum of rows weighted by ``g``."""
        return np.bincount(self.col, self.val * g[self.row], n)

    def take(self, rows: np.ndarray) -> Rows:
        n = np.diff(self.at)[rows]
        at = np.concatenate([[0], np.cumsum(n)])
        flat = np.repeat(self.at[rows] - at[:-1], n) + np.arange(at[-1])
        return Rows(at, self.col[flat], self.val[flat])


def stack(parts: list[Rows]) -> Rows:
    at = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(p.at) for p in parts]))]).astype(np.int64)
    return Rows(at, np.concatenate([p.col for p in parts]), np.concatenate([p.val for p in parts]))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_logistic(x: Rows, y: np.ndarray, n: int, weight: np.ndarray | None = None, l2: float = 1e-4, steps: int = 250,
                 rate: float = 0.3) -> np.ndarray:
    """Logistic regression by full-batch Adam; the last weight is the intercept."""
    return _adam(x, y, n, lambda m, t: sigmoid(m) - t, weight, l2, steps, rate)


def fit_svm(x: Rows, y: np.ndarray, n: int, l2: float = 1e-5, steps: int = 250, rate: float = 0.3) -> np.ndarray:
    """A linear support vector machine (squared hinge loss) on labels 0 and 1; the last weight is the intercept."""
    return _adam(x, y, n, lambda m, t: -(2 * t - 1) * np.maximum(0, 1 - (2 * t - 1) * m), None, l2, steps, rate)


def _adam(x, y, n, slope, weight, l2, steps, rate):
    w = np.zeros(n + 1)
    m, v = np.zeros(n + 1), np.zeros(n + 1)
    weight = np.ones(len(y)) if weight is None else weight
    weight = weight / max(weight.sum(), 1e-12)
    for t in range(1, steps + 1):
        g = slope(x.dot(w[:-1]) + w[-1], y) * weight
        grad = np.append(x.back(g, n) + l2 * w[:-1], g.sum())
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        w -= rate * (1 - t / (steps + 1)) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def margin(x: Rows, w: np.ndarray) -> np.ndarray:
    return x.dot(w[:-1]) + w[-1]


def calibrate(margins: np.ndarray, y: np.ndarray, steps: int = 200) -> tuple[float, float]:
    """Platt scaling: slope and offset of the logistic curve that fits the margins of held-out rows."""
    if not len(y):
        return 1.0, 0.0
    scale = max(float(np.abs(margins).mean()), 1e-6)
    x = Rows(np.arange(len(y) + 1), np.zeros(len(y), np.int64), margins / scale)
    w = fit_logistic(x, (y * (y.sum() + 1) + (1 - y)) / (y * (y.sum() + 2) + (1 - y) * ((1 - y).sum() + 2)), 1, l2=1e-3, steps=steps)
    return float(w[0] / scale), float(w[1])
