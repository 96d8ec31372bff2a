"""Logistic regression on sparse rows, with Platt calibration: numpy code for one bounded sample."""

import numpy as np


class Sparse:
    """Rows of (feature, value) pairs laid end to end."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], width: int):
        self.width = width
        self.sizes = np.array([len(f) for f, _ in rows])
        self.row = np.repeat(np.arange(len(rows)), self.sizes)
        self.feature = np.concatenate([f for f, _ in rows] or [np.empty(0, np.int64)])
        self.value = np.concatenate([v for _, v in rows] or [np.empty(0)])

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * w[self.feature], minlength=len(self.sizes))

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.feature, self.value * r[self.row], minlength=self.width)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def fit(x: Sparse, target: np.ndarray, weight: np.ndarray, l2: float = 1e-4, steps: int = 200, rate: float = 0.1) -> tuple[np.ndarray, float]:
    """(weights, bias) that minimise the weighted log-loss to the targets in [0, 1] plus l2/2 |w|^2, by Adam."""
    w, total = np.zeros(x.width + 1), max(weight.sum(), 1e-9)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        r = weight * (sigmoid(x.times(w[:-1]) + w[-1]) - target) / total
        g = np.append(x.back(r) + l2 * w[:-1], r.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (1 - t / (steps + 1)) * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-9)
    return w[:-1], float(w[-1])


def platt(score: np.ndarray, target: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """(a, b) such that sigmoid(a * score + b) is a calibrated probability, by Newton steps on smoothed targets."""
    pos, neg = target.sum(), len(target) - target.sum()
    if not pos or not neg:
        return 1.0, 0.0
    goal = np.where(target > 0.5, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.stack([score, np.ones_like(score)], axis=1)
    ab = np.array([1.0, 0.0])
    for _ in range(steps):
        p = sigmoid(x @ ab)
        g = x.T @ (p - goal) + 1e-3 * (ab - [1.0, 0.0])
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, g)
        ab = ab - step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
    return float(ab[0]), float(ab[1])
