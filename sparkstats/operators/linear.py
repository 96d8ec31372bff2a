"""Least squares, ridge and their sweeps, all from `Moments`."""

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import vectors
from .gram import Moments, moments, vector_moments

BIAS = "bias"


def solve(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a⁻¹b, or the minimum-norm solution when a is singular."""
    try:
        if np.linalg.cond(a) < 1e13:
            return np.linalg.solve(a, b)
    except np.linalg.LinAlgError:
        pass
    return np.linalg.pinv(a, rcond=1e-12, hermitian=True) @ b


@dataclass
class LinearModel:
    names: list[str]
    weights: np.ndarray
    intercept: float

    def predict(self, columns: dict[str, Column]) -> Column:
        """A native scoring expression over scalar columns."""
        out = F.lit(float(self.intercept))
        for n, w in zip(self.names, self.weights):
            out = out + F.lit(float(w)) * columns[n]
        return out

    def predict_vector(self, features="features") -> Column:
        return vectors.dot(features, F.array(*[F.lit(float(w)) for w in self.weights])) + F.lit(float(self.intercept))

    def table(self, spark) -> DataFrame:
        rows = [(n, float(w)) for n, w in zip(self.names, self.weights)] + [(BIAS, float(self.intercept))]
        return spark.createDataFrame(rows, "feature string, weight double")

    @staticmethod
    def from_table(df: DataFrame) -> "LinearModel":
        rows = {r["feature"]: r["weight"] for r in df.collect()}
        bias = rows.pop(BIAS)
        return LinearModel(list(rows), np.array(list(rows.values())), bias)

    def sse(self, m: Moments) -> float:
        """Sum of squared errors on the rows behind `m` (target last), with no scan.

        Works on deviations from the means, so little is lost to cancellation.
        """
        centred = m.cross - np.outer(m.sums, m.sums) / m.n
        v = np.append(self.weights, -1.0)
        gap = float(m.means @ v + self.intercept)
        return max(float(v @ centred @ v), 0.0) + m.n * gap * gap

    def rmse(self, m: Moments) -> float:
        return float(np.sqrt(self.sse(m) / m.n))


def _centred(m: Moments):
    c = m.cross - np.outer(m.sums, m.sums) / m.n
    return c[:-1, :-1], c[:-1, -1], m.means


def fit_normal(m: Moments) -> LinearModel:
    """(XᵀX)⁻¹Xᵀt with the constant feature last; the target is the last column of `m`."""
    mean = m.means
    raw = m.cross if m.shift is None else (
        m.cross + np.outer(m.shift, m.sums) + np.outer(m.sums, m.shift) + m.n * np.outer(m.shift, m.shift))
    d = len(m.names) - 1
    a = np.zeros((d + 1, d + 1))
    a[:d, :d] = raw[:d, :d]
    a[:d, d] = a[d, :d] = mean[:d] * m.n
    a[d, d] = m.n
    w = solve(a, np.append(raw[:d, -1], mean[-1] * m.n))
    return LinearModel(m.names[:-1], w[:-1], float(w[-1]))


def fit_ols(m: Moments) -> LinearModel:
    """Least squares with an intercept, minimum norm when columns are collinear."""
    return fit_ridge(m, 0.0)


def fit_ridge(m: Moments, alpha: float) -> LinearModel:
    """Least squares plus alpha·|w|², intercept unpenalised."""
    a, b, mean = _centred(m)
    w = solve(a + alpha * np.eye(len(a)), b)
    return LinearModel(m.names[:-1], w, float(mean[-1] - mean[:-1] @ w))


def ridge_path(train: Moments, test: Moments, alphas: list[float]) -> list[tuple[float, float]]:
    """(alpha, test RMSE) for every alpha: one eigendecomposition, no further scan."""
    a, b, mean = _centred(train)
    values, basis = np.linalg.eigh(a)
    values = np.clip(values, 0, None)
    rotated = basis.T @ b
    out = []
    for alpha in alphas:
        scale = values + alpha
        w = basis @ np.divide(rotated, scale, out=np.zeros_like(rotated), where=scale > 1e-12 * max(values.max(), 1e-300))
        model = LinearModel(train.names[:-1], w, float(mean[-1] - mean[:-1] @ w))
        out.append((float(alpha), model.rmse(test)))
    return out


def order_sweep(df: DataFrame, x: Column, target: Column, is_test: Column, orders: int) -> list[tuple[int, float]]:
    """Test RMSE of polynomial fits of order 1..orders, from one scan.

    x should be scaled to [-1, 1]. Every lower order is a leading block of the
    highest one.
    """
    src = df.select(x.alias("x"), target.alias("t"), is_test.alias("is_test"))
    cols = {f"x{k}": F.pow("x", F.lit(float(k))) for k in range(1, orders + 1)}
    parts = moments(src, {**cols, "t": F.col("t")}, by="is_test", center=True)
    out = []
    for order in range(1, orders + 1):
        keep = list(range(order)) + [orders]
        pick = lambda m: Moments([m.names[i] for i in keep], m.n, m.sums[keep], m.cross[np.ix_(keep, keep)], m.shift[keep])
        out.append((order, fit_ols(pick(parts[False])).rmse(pick(parts[True]))))
    return out


def fold_grid(parts: dict[int, Moments], alphas: list[float]) -> list[tuple[float, int, float]]:
    """(alpha, fold, held-out RMSE): each fold's training moments are total minus fold."""
    total = None
    for m in parts.values():
        total = m if total is None else total + m
    return [(a, int(fold), r) for fold, held in sorted(parts.items())
            for a, r in ridge_path(total - held, held, alphas)]


def grid_refit(parts: dict[int, Moments], test: Moments, alphas: list[float]) -> tuple[float, float, float]:
    """(alpha, its mean held-out RMSE over the folds, RMSE on `test` after a fit on all folds); no further scan."""
    rows = fold_grid(parts, alphas)
    mean = [(a, sum(v for b, _, v in rows if b == a) / len(parts)) for a in alphas]
    alpha, score = first_best([(a, round(v, 12)) for a, v in mean])
    total = None
    for m in parts.values():
        total = m if total is None else total + m
    return alpha, score, ridge_path(total, test, [alpha])[0][1]


def first_best(rows: list[tuple], lowest: bool = True):
    """The (parameter, score) with the best score; the first one wins ties."""
    best = None
    for row in rows:
        if best is None or (row[-1] < best[-1] if lowest else row[-1] > best[-1]):
            best = row
    return best


__all__ = ["LinearModel", "Moments", "moments", "vector_moments", "fit_normal", "fit_ols", "fit_ridge",
           "ridge_path", "order_sweep", "fold_grid", "grid_refit", "first_best", "solve"]
