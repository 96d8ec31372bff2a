"""Sufficient statistics: one pass over the table, a D x D state on the driver.

Everything least-squares needs (fits, ridge paths, order sweeps, per-fold grid
searches, full-batch gradient descent, RMSE of any linear model) is a function
of these sums, so none of those re-reads the table.
"""

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import vectors

MAX_NATIVE = 32


@dataclass
class Moments:
    """n, column sums and the cross-product matrix of some columns."""

    names: list[str]
    n: float
    sums: np.ndarray
    cross: np.ndarray
    shift: np.ndarray = field(default=None)

    def __add__(self, other: "Moments") -> "Moments":
        return Moments(self.names, self.n + other.n, self.sums + other.sums, self.cross + other.cross, self.shift)

    def __sub__(self, other: "Moments") -> "Moments":
        return Moments(self.names, self.n - other.n, self.sums - other.sums, self.cross - other.cross, self.shift)

    @property
    def means(self) -> np.ndarray:
        return self.sums / self.n + (0 if self.shift is None else self.shift)

    def covariance(self) -> np.ndarray:
        """Population covariance (divides by n)."""
        m = self.sums / self.n
        return self.cross / self.n - np.outer(m, m)

    def correlation(self) -> np.ndarray:
        """Pearson correlations; NaN in the rows and columns of a constant column."""
        c = self.covariance()
        s = np.sqrt(np.clip(np.diag(c), 0, None))
        s = np.where(s > 1e-12 * np.maximum(1.0, np.abs(self.means)), s, np.nan)
        return c / np.outer(s, s)


def _unpack(names: list[str], flat, shift=None) -> Moments:
    d = len(names)
    cross = np.zeros((d, d))
    upper = np.triu_indices(d)
    cross[upper] = flat[1 + d:]
    cross = cross + np.triu(cross, 1).T
    return Moments(names, float(flat[0]), np.array(flat[1:1 + d], dtype=float), cross, shift)


def moments(df: DataFrame, columns: dict[str, Column], by: str | None = None, center: bool = False):
    """`Moments` of scalar columns; a dict of them if grouped by a low-cardinality column.

    The sums are native aggregates inside whole-stage codegen. With `center`,
    a first pass finds the means and the second sums products of deviations,
    which keeps covariances exact when means are far from zero.
    """
    if len(columns) > MAX_NATIVE:
        raise ValueError("put more than 32 columns into one array column and use vector_moments")
    names = list(columns)
    x = [F.col(f"_x{i}") for i in range(len(names))]
    src = df.select(*([by] if by else []), *[c.cast("double").alias(f"_x{i}") for i, c in enumerate(columns.values())])
    shift = None
    if center:
        shift = np.array([v or 0.0 for v in src.agg(*[F.avg(c) for c in x]).first()], dtype=float)
        x = [c - F.lit(float(s)) for c, s in zip(x, shift)]
    sums = [F.count("*").cast("double")] + [F.sum(c) for c in x]
    sums += [F.sum(x[i] * x[j]) for i in range(len(x)) for j in range(i, len(x))]
    if by:
        rows = src.groupBy(by).agg(*sums).collect()
        return {r[0]: _unpack(names, list(r)[1:], shift) for r in rows}
    return _unpack(names, [v or 0.0 for v in src.agg(*sums).first()], shift)


def vector_moments(df: DataFrame, dim: int, features: str = "features", target: str | None = None,
                   by: str | None = None, center: bool = False):
    """`Moments` of a vector column (and a target, last), one Arrow block at a time."""
    names = [str(i) for i in range(dim)] + (["target"] if target else [])
    d = len(names)
    upper = np.triu_indices(d)
    shift = None
    if center:
        first = vectors.collect_sums(vectors.block_sums(
            df, lambda x, c: np.concatenate([[len(x)], x.sum(0), [c[target].sum()] if target else []]),
            features=features, extra=[target] if target else []), d + 1)
        shift = first[1:] / max(first[0], 1)

    def block(x, cols):
        if target:
            x = np.column_stack([x, cols[target].astype(float)])
        if shift is not None:
            x = x - shift
        return np.concatenate([[len(x)], x.sum(0), (x.T @ x)[upper]])

    sums = vectors.block_sums(df, block, group=by, features=features, extra=[target] if target else [])
    size = 1 + d + len(upper[0])
    if by:
        return {k: _unpack(names, v, shift) for k, v in vectors.collect_sums(sums, size, by).items()}
    return _unpack(names, vectors.collect_sums(sums, size), shift)


def matrix_table(spark, m: np.ndarray, names: list | None = None, value: str = "value") -> DataFrame:
    """A model-sized matrix as rows (i, j, value)."""
    rows = [(int(i), int(j), float(m[i, j]) if np.isfinite(m[i, j]) else None)
            for i in range(m.shape[0]) for j in range(m.shape[1])]
    out = spark.createDataFrame(rows, f"i int, j int, {value} double")
    if names is None:
        return out
    label = F.array(*[F.lit(n) for n in names])
    return out.select(F.get(label, F.col("i")).alias("a"), F.get(label, F.col("j")).alias("b"), value)
