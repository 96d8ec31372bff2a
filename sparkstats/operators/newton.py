"""Many two-class logistic models at once, by Newton steps.

A model is a penalty and a fold that it leaves out. One pass over the rows gives every
model its loss, gradient and weighted Gram matrix as one array sum, so a whole grid with
its refit costs as many passes as the slowest model has steps. The driver holds
models x D x D numbers, whatever the number of rows.
"""

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ..functions import vectors
from .cache import held
from .gradient import with_ones
from .linear import first_best, solve

#: The fold of a model that leaves no row out.
ALL = -1
#: Rows that a pass takes at once, for all models.
ROWS = 1024


@dataclass
class Fit:
    """C * sum of losses + |w|^2 / 2, the bias (last weight) free of penalty."""

    c: float
    fold: int
    w: np.ndarray
    steps: int = 0
    done: bool = False


def _losses(z: np.ndarray, t: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z) - t[:, None] * z


def _sums(models: list[Fit], target: str, fold: str):
    """A block function: [loss, gradient, upper Gram] of every model, over the rows that it is fitted on."""
    w, folds = np.stack([m.w for m in models], axis=1), np.array([m.fold for m in models])
    upper = np.triu_indices(len(w))

    def block(x, cols):
        return sum(some(x[s:s + ROWS], {c: np.asarray(v)[s:s + ROWS] for c, v in cols.items()}) for s in range(0, len(x), ROWS))

    def some(x, cols):
        x1, t = with_ones(x), np.asarray(cols[target], dtype=float)
        mine = (np.asarray(cols[fold])[:, None] != folds).astype(float)
        z = x1 @ w
        p = 0.5 * (1.0 + np.tanh(0.5 * z))
        loss, slope, weight = (_losses(z, t) * mine).sum(0), x1.T @ ((p - t[:, None]) * mine), p * (1 - p) * mine
        return np.concatenate([np.concatenate([[loss[k]], slope[:, k], (x1.T @ (x1 * weight[:, k:k + 1]))[upper]])
                               for k in range(len(folds))])

    return block


def fit_many(df: DataFrame, dim: int, penalties: list[float], folds: list[int], features: str = "features", target: str = "label",
             fold: str = "fold", max_steps: int = 50, tolerance: float = 1e-8, cache: bool = True) -> list[Fit]:
    """A `Fit` for every C in penalties and every fold left out (ALL: none), in that order.

    Steps are halved where they do not lower the objective. A model is `done` when a step would change the
    objective by less than tolerance ** 2 of it; done models take no part in later passes. target holds 0 and 1,
    fold whole numbers from 0; rows with a null in a column read are left out. A table without rows gives zero weights.
    """
    models = [Fit(float(c), int(f), np.zeros(dim + 1)) for c in penalties for f in folds]
    upper, size = np.triu_indices(dim + 1), 2 + dim + (dim + 1) * (dim + 2) // 2
    ridge = np.append(np.ones(dim), 0.0)
    before: dict[int, tuple] = {}  # model: (objective, weights, step) of its last accepted point
    src = df.select(features, F.col(target).cast("double").alias(target), F.col(fold).cast("int").alias(fold)).dropna()
    with held(src, cache) as rows:
        for _ in range(max_steps):
            live = [n for n, m in enumerate(models) if not m.done]
            if not live:
                break
            block = _sums([models[n] for n in live], target, fold)
            sums = vectors.collect_sums(vectors.block_sums(rows, block, features=features, extra=[target, fold]), size * len(live))
            for n, s in zip(live, sums.reshape(len(live), size)):
                m = models[n]
                value = m.c * s[0] + 0.5 * float(ridge @ m.w ** 2)
                if n in before and value > before[n][0] + 1e-12 * abs(before[n][0]):
                    _, start, step = before[n]
                    before[n] = (before[n][0], start, step / 2)
                    m.w = start + step / 2
                    continue
                gram = np.zeros((dim + 1, dim + 1))
                gram[upper] = s[2 + dim:]
                slope = m.c * s[1:2 + dim] + ridge * m.w
                step = -solve(m.c * (gram + np.triu(gram, 1).T) + np.diag(ridge), slope)
                before[n] = (value, m.w, step)
                m.done = -float(slope @ step) <= tolerance ** 2 * max(1.0, abs(value))
                m.w, m.steps = m.w + step, m.steps + 1
    return models


def scores(df: DataFrame, models: list[Fit], features: str = "features", target: str = "label", fold: str = "fold") -> list[tuple]:
    """(accuracy, mean loss) of every model on the rows of the fold that it left out (ALL: on all rows), from one pass."""
    w, folds = np.stack([m.w for m in models], axis=1), np.array([m.fold for m in models])

    def block(x, cols):
        return sum(some(x[s:s + ROWS], {c: np.asarray(v)[s:s + ROWS] for c, v in cols.items()}) for s in range(0, len(x), ROWS))

    def some(x, cols):
        t = np.asarray(cols[target], dtype=float)
        z = with_ones(x) @ w
        mine = (np.asarray(cols[fold])[:, None] == folds) | (folds == ALL)
        return np.concatenate([mine.sum(0), (((z >= 0) == (t[:, None] == 1)) & mine).sum(0), (_losses(z, t) * mine).sum(0)]).astype(float)

    src = df.select(features, F.col(target).cast("double").alias(target), F.col(fold).cast("int").alias(fold)).dropna()
    n, hits, loss = vectors.collect_sums(vectors.block_sums(src, block, features=features, extra=[target, fold]), 3 * len(models)).reshape(3, -1)
    return [(float(h / k), float(v / k)) if k else (None, None) for k, h, v in zip(n, hits, loss)]


def grid_search(train: DataFrame, test: DataFrame, dim: int, penalties: list[float], folds: int, **columns):
    """Every C on every fold and on all rows, from the same passes: (rows, best).

    rows: (c, mean held-out accuracy, mean held-out loss, accuracy on `test` of the fit on all training rows). best is
    the first row with the highest mean accuracy. `test` needs no fold of its own. Empty folds count for nothing.
    """
    fold = columns.get("fold", "fold")
    models = fit_many(train, dim, penalties, [*range(folds), ALL], **columns)
    held_out = scores(train, models, **columns)
    whole = [m for m in models if m.fold == ALL]
    tested = scores(test.withColumn(fold, F.lit(ALL)), whole, **columns)
    rows = []
    for i, m in enumerate(whole):
        own = [s for s in held_out[i * (folds + 1):i * (folds + 1) + folds] if s[0] is not None]
        mean = [sum(s[j] for s in own) / len(own) if own else None for j in (0, 1)]
        rows.append((m.c, *mean, tested[i][0]))
    chosen, _ = first_best([(r, -1.0 if r[1] is None else round(r[1], 12)) for r in rows], lowest=False)
    return rows, chosen


__all__ = ["ALL", "Fit", "fit_many", "scores", "grid_search"]
