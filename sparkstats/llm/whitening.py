"""Whitening of embeddings by an incremental eigendecomposition.

A partition holds the spectrum of the rows it has read: their mean, and the eigenvalues and eigenvectors of their
scatter about it. A further row is a rank-one update: the roots of a secular equation are the new eigenvalues, and
vectors that the update leaves alone are deflated. Spectra are combined by one rank-one update for each eigenpair
and one for the difference of the means. The combined basis is refined by Rayleigh-Ritz steps, whose inner
products are summed over all rows.
"""

from collections.abc import Iterator
from dataclasses import dataclass, field
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import vectors
from . import common

EPS = np.finfo(float).eps
SCALE = 256
#: Rayleigh-Ritz steps at most; they end when the basis is orthogonal in the covariance to STILL.
STEPS, STILL = 4, 1e-13


# ---- rank-one updates ----------------------------------------------------------------

def secular_roots(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """The roots of 1 + rho sum z_j^2 / (d_j - t) = 0, as (index of a pole, distance from it).

    d ascends without ties, z has no zero and norm 1, rho > 0: a root lies above each pole. It is approached by
    rational functions with the two poles beside it, and kept in brackets.
    """
    k = len(d)
    weight = rho * z * z
    above = np.append(d[1:], d[-1] + rho)
    middle = (above - d) / 2
    right = 1 + (weight / (d - (d + middle)[:, None])).sum(axis=1) < 0
    right[-1] = False
    origin = np.arange(k) + right
    away = d - d[origin][:, None]  # poles, seen from each root's own
    near = d - d[origin]
    far = above - d[origin]
    low, high = np.where(right, -middle, 0.0), np.where(right, 0.0, middle)
    high[-1] = rho
    left = np.tril(np.ones((k, k), bool))
    s = (low + high) / 2
    with np.errstate(all="ignore"):
        for _ in range(80):
            gap = away - s[:, None]
            part = weight / gap
            slope = part / gap
            psi, dpsi = (part * left).sum(axis=1), (slope * left).sum(axis=1)
            total, dtotal = part.sum(axis=1), slope.sum(axis=1)
            f = 1 + total
            low, high = np.where(f < 0, s, low), np.where(f < 0, high, s)
            a, b = near - s, far - s
            c = 1 + psi - a * dpsi + (total - psi) - b * (dtotal - dpsi)
            p, q = a * a * dpsi, b * b * (dtotal - dpsi)
            lin, con = c * (a + b) + p + q, a * b * f
            root = np.sqrt(np.maximum(lin * lin - 4 * c * con, 0))
            step = np.where(lin <= 0, (lin - root) / (2 * c), 2 * con / (lin + root))
            step[-1] = a[-1] + p[-1] / (1 + psi[-1] - a[-1] * dpsi[-1])
            new = s + step
            out = ~((new > low) & (new < high))
            new[out] = (low[out] + high[out]) / 2
            done = (np.abs(f) <= 4 * EPS * (1 + np.abs(part).sum(axis=1))) | (np.abs(new - s) <= 2 * EPS * np.abs(s)) | (high - low <= 4 * EPS * np.maximum(np.abs(low), np.abs(high)))
            s = np.where(done, s, new)
            if done.all():
                break
    return origin, s


def rank_one(values: np.ndarray, basis: np.ndarray, rho: float, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values, basis) of basis diag(values) basis^T + rho v v^T; values ascend."""
    z = basis.T @ v
    size = float(np.sqrt(z @ z))
    if not rho * size * size > 0:
        return values, basis
    z, rho = z / size, rho * size * size
    least = 8 * EPS * max(float(np.abs(values).max()), rho)
    # Deflation: a reflection puts all of z that lies in equal values on one of them.
    starts = np.flatnonzero(np.append(True, np.diff(values) > least))
    for a, b in zip(starts, np.append(starts[1:], len(values))):
        if b - a > 1:
            w = z[a:b].copy()
            length = float(np.sqrt(w @ w))
            w[-1] += np.copysign(length, w[-1])
            norm = float(w @ w)
            if norm > 0:
                basis = basis.copy() if a == starts[0] or basis.base is not None else basis
                basis[:, a:b] -= np.outer(basis[:, a:b] @ w, 2 / norm * w)
                z[b - 1], z[a:b - 1] = -np.copysign(length, w[-1]), 0.0
    # Deflation: what z hardly reaches stays.
    live = np.flatnonzero(rho * np.abs(z) > least)
    if not len(live):
        return values, basis
    d, zl = values[live], z[live]
    norm = float(np.sqrt(zl @ zl))
    zl, rho = zl / norm, rho * norm * norm
    origin, s = secular_roots(d, zl, rho)
    gap = (d - d[origin][:, None]) - s[:, None]  # pole j less root i
    # The z that has exactly these roots makes the vectors orthogonal.
    k = len(d)
    between = d[None, :] - d[:, None]  # pole j less pole i
    with np.errstate(divide="ignore", invalid="ignore"):
        lower = np.tril(np.ones((k, k), bool), -1).T  # i < j: paired with pole i
        ratio = np.where(lower, gap / between, 1.0)
        ratio[:-1] *= np.where(~lower[:-1], gap[:-1] / between[1:], 1.0)
    exact = np.sqrt(np.abs(ratio.prod(axis=0) * gap[-1])) * np.sign(zl)
    turn = (exact / gap).T
    turn /= np.sqrt((turn * turn).sum(axis=0))
    values, out = values.copy(), basis.copy()
    out[:, live] = basis[:, live] @ turn
    values[live] = d[origin] + s
    order = np.argsort(values, kind="stable")
    return values[order], out[:, order]


@dataclass
class Spectrum:
    """The mean of n rows, and the eigenvalues and eigenvectors (columns) of their scatter about it."""

    d: int
    n: int = 0
    mean: np.ndarray = field(default=None)
    values: np.ndarray = field(default=None)
    basis: np.ndarray = field(default=None)

    def __post_init__(self):
        if self.mean is None:
            self.mean, self.values, self.basis = np.zeros(self.d), np.zeros(self.d), np.eye(self.d)

    def add(self, x: np.ndarray) -> None:
        off = x - self.mean
        if self.n:
            self.values, self.basis = rank_one(self.values, self.basis, self.n / (self.n + 1), off)
        self.n += 1
        self.mean = self.mean + off / self.n

    def merge(self, other: "Spectrum") -> None:
        if not other.n:
            return
        for value, vector in zip(other.values, other.basis.T):
            if value > 0:
                self.values, self.basis = rank_one(self.values, self.basis, float(value), vector)
        off, both = other.mean - self.mean, self.n + other.n
        if self.n:
            self.values, self.basis = rank_one(self.values, self.basis, self.n * other.n / both, off)
        self.mean = self.mean + off * (other.n / both)
        self.n = both


# ---- distributed parts -----------------------------------------------------------------

SPECTRUM = "part int, n long, mean array<double>, vals array<double>, basis array<double>"


def _row(part: int, s: Spectrum) -> pa.RecordBatch:
    doubles = pa.list_(pa.float64())
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([s.n], pa.int64()), pa.array([s.mean], doubles),
                                       pa.array([s.values], doubles), pa.array([s.basis.ravel()], doubles)], names=["part", "n", "mean", "vals", "basis"])


def _spectrum(d: int, row: dict) -> Spectrum:
    return Spectrum(d, row["n"], np.array(row["mean"]), np.array(row["vals"]), np.array(row["basis"]).reshape(d, d))


def spectrum(fit: DataFrame, d: int) -> Spectrum:
    """The spectrum of all rows' x: one by one within partitions, then by groups of partitions, then of the groups."""
    def one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Spectrum(d)
        for batch in batches:
            for x in vectors.as_matrix(batch.column(0)) if batch.num_rows else ():
                s.add(x)
        if s.n:
            yield _row(TaskContext.get().partitionId(), s)

    def together(key: tuple, rows: pa.Table) -> pa.Table:
        rows = sorted(rows.to_pylist(), key=lambda r: r["part"])
        s = _spectrum(d, rows[0])
        for r in rows[1:]:
            s.merge(_spectrum(d, r))
        return pa.Table.from_batches([_row(rows[0]["part"], s)])

    groups = max(1, round(fit.rdd.getNumPartitions() ** 0.5))
    found = fit.select("x").mapInArrow(one_by_one, SPECTRUM)
    found = found.groupBy(F.col("part") % groups).applyInArrow(together, SPECTRUM)
    rows = found.groupBy(F.col("part") * 0).applyInArrow(together, SPECTRUM).collect()  # model-sized: one row
    return _spectrum(d, rows[0].asDict()) if rows else Spectrum(d)


def _exact(x: np.ndarray, bound: int) -> np.ndarray:
    """Whole numbers in a type that holds products of them up to a bound."""
    return x if bound < 1 << 62 else x.astype(object)


def sums(fit: DataFrame, d: int) -> list[int]:
    """The exact sum of every entry of x."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * d
        for batch in batches:
            if batch.num_rows:
                x = _whole(batch.column(0), d)
                x = _exact(x, len(x) * int(max(abs(int(x.min())), abs(int(x.max())))) if x.size else 0)
                total = [a + int(b) for a, b in zip(total, x.sum(axis=0))]
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))], names=["i", "v"])
    found = {r["i"]: int(r["v"]) for r in fit.select("x").mapInArrow(run, "i int, v decimal(38,0)").groupBy("i").agg(F.sum("v").alias("v")).collect()}
    return [found.get(i, 0) for i in range(d)]


def _whole(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d)


def whole_numbers(vector: Column) -> Column:
    """floor(256 c) of every entry as a long; beyond its range, the nearest long."""
    return F.transform(vector, lambda c: F.floor(SCALE * c.cast("double")))


def usable(vector: Column) -> Column:
    inf = F.lit(float("inf"))
    return F.coalesce(F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != inf)), F.lit(False))


@dataclass
class Fit:
    """What whitens: n distinct vectors with sums S, eigenvectors (columns) and eigenvalues of their covariance, falling."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float | None


def centred(x: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    return (n * x - total) / n


def fit(rows: DataFrame, d: int, components: int) -> Fit:
    """Fit on rows of x that are distinct and lie in files."""
    n, total = rows.count(), sums(rows, d)
    at = np.array(total, float)
    basis = np.linalg.qr(spectrum(rows, d).basis)[0]
    doubles = rows.select(F.col("x").cast("array<double>").alias("x"))
    for _ in range(STEPS):
        def inner(x: np.ndarray, _cols: dict, basis=basis) -> np.ndarray:
            y = centred(x, n, at) @ basis
            return (y.T @ y).ravel()
        h = vectors.collect_sums(vectors.block_sums(doubles, inner, features="x"), d * d).reshape(d, d) / n
        h = (h + h.T) / 2
        size = np.sqrt(np.maximum(np.diag(h), EPS * max(np.trace(h), 0)))
        off = np.abs(h / np.outer(size, size) - np.diag(np.diag(h) / size / size)).max() if size.all() else 0.0
        value, turn = np.linalg.eigh(h)
        basis, value = (basis @ turn)[:, ::-1], value[::-1]
        if off <= STILL:
            break
    basis, value = basis[:, :components], np.maximum(value[:components], 0)
    there = value > d * EPS * np.trace(h)
    scale = basis[:, there] / np.sqrt(value[there])
    error = None
    if there.any():
        k = int(there.sum())

        def products(x: np.ndarray, _cols: dict) -> np.ndarray:
            w = centred(x, n, at) @ scale
            return np.append((w.T @ w).ravel(), w.sum(axis=0))
        got = vectors.collect_sums(vectors.block_sums(doubles, products, features="x"), k * k + k) / n
        error = float(np.abs(got[:k * k].reshape(k, k) - np.outer(got[k * k:], got[k * k:]) - np.eye(k)).max())
    return Fit(n, total, basis, np.where(there, value, 0.0), float(np.trace(h)), error)


def whitened(rows: DataFrame, components: int = 4, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): a row per usable row and component.

    Rows whose vector is null or has a null, NaN or infinite entry go. Entries become whole numbers (`whole_numbers`);
    vectors shorter than the longest are filled up with zeros. The fit is over the distinct vectors. A component
    without variance has a null `whitened`; where there is none at all, `explained` and `identity_error` are null
    too. A deviation beyond 64 bits is null. Repeated rows and null ids stay; there are never more components than
    entries; an empty table, or one without a usable row, gives none; other columns are not read. The basis is
    d x d numbers, which the driver and each task hold.
    """
    spark = rows.sparkSession
    kept = rows.select(F.col(id_col).alias("id"), F.col(vector).alias("v")).where(usable(F.col("v"))).select("id", whole_numbers(F.col("v")).alias("x"))
    d = kept.agg(F.max(F.size("x"))).first()[0] or 0
    kept = kept.select("id", F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(d) - F.size("x"))).alias("x"))
    schema = f"id {kept.schema['id'].dataType.simpleString()}, component int, deviation long, whitened double"
    if not d:
        return spark.createDataFrame([], schema).select("id", "component", F.lit(0).cast("long").alias("n"), "deviation", "whitened",
                                                        F.lit(0.0).alias("explained"), F.lit(0.0).alias("identity_error"))
    found = fit(common.cut(kept.select("x").distinct()), d, components)
    total, n, k = found.sums, found.n, found.vectors.shape[1]
    at, there = np.array(total, float), found.values > 0
    scale = found.vectors[:, there] / np.sqrt(found.values[there])
    most = max(map(abs, total))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _whole(batch.column(1), d)
            w = np.full((len(x), k), np.nan)
            w[:, there] = centred(x.astype(float), n, at) @ scale
            bound = d * (n * max(abs(int(x.min())), abs(int(x.max()))) + most) ** 2
            off = n * _exact(x, bound) - (np.array(total) if bound < 1 << 62 else np.array(total, object))
            deviation = [v if v < 1 << 63 else None for v in map(int, (off * off).sum(axis=1))]
            of = pa.array(np.repeat(np.arange(len(x)), k))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(of), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                                              pa.array(deviation, pa.int64()).take(of), pa.array(w.ravel(), from_pandas=True)],
                                             names=["id", "component", "deviation", "whitened"])
    share = F.array(*[F.lit(float(v / found.trace) if found.trace > 0 else None).cast("double") for v in found.values])
    return kept.mapInArrow(run, schema).select(
        "id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened", F.element_at(share, F.col("component")).alias("explained"),
        F.lit(found.identity_error).cast("double").alias("identity_error"))
