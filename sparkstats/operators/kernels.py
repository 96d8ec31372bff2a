"""Polynomial and RBF kernels without N x N matrices.

The polynomial kernel is an inner product of finitely many monomials, and the
RBF kernel of a few inputs is one up to rounding error. So a kernel sum over
all training rows, Σ_j c_j K(x, x_j), equals φ(x)·s with s = Σ_j c_j φ(x_j):
one aggregate over the training rows, then one scoring pass, no pairs.
"""

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..functions import vectors

MAX_MAP = 4096
MAX_SUPPORT_BYTES = 64 << 20
SUPPORT_ROWS = 4096
TRUNCATION = 1e-13


def kernel_matrix(kind: str, x: np.ndarray, y: np.ndarray, gamma: float = 1.0, degree: int = 3) -> np.ndarray:
    """poly: (γ x·y + 1)^degree; rbf: exp(-γ|x - y|²)."""
    if kind == "poly":
        return (gamma * (x @ y.T) + 1.0) ** degree
    if kind != "rbf":
        raise ValueError("kernel must be poly or rbf")
    out = np.empty((len(x), len(y)))
    for j, c in enumerate(y):
        out[:, j] = ((x - c) ** 2).sum(1)
    return np.exp(-gamma * out)


@dataclass
class FeatureMap:
    """φ with K(x, y) = φ(x)·φ(y)."""

    kind: str
    gamma: float
    terms: list[tuple[int, ...]]
    scale: np.ndarray

    @staticmethod
    def build(kind: str, dim: int, gamma: float = 1.0, degree: int = 3, radius: float = 1.0) -> "FeatureMap":
        """`radius` bounds |x| for the RBF expansion; its rest term stays below 1e-13."""
        if kind == "rbf":
            t, degree, rest = 2 * gamma * radius * radius, 0, 1.0
            while rest > TRUNCATION or degree < t:
                degree += 1
                rest = rest * t / degree
                if math.comb(degree + dim, dim) > MAX_MAP:
                    raise ValueError("too many terms for this dimension and radius; use kernel_sums_in_blocks")
        if math.comb(degree + dim, dim) > MAX_MAP:
            raise ValueError("too many monomials; use kernel_sums_in_blocks")
        terms = vectors.monomials(dim, degree, include_bias=True)
        scale = []
        for term in terms:
            ways = math.prod(math.factorial(c) for c in Counter(term).values())
            if kind == "poly":
                ways = math.factorial(degree) / (math.factorial(degree - len(term)) * ways)
                scale.append(math.sqrt(ways * gamma ** len(term)))
            else:
                scale.append(math.sqrt((2 * gamma) ** len(term) / ways))
        return FeatureMap(kind, gamma, terms, np.array(scale))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        out = np.empty((len(x), len(self.terms)))
        seen = {(): np.ones(len(x))}
        for j, term in enumerate(self.terms):
            if term:
                seen[term] = seen[term[:-1]] * x[:, term[-1]]
            out[:, j] = seen[term]
        out *= self.scale
        if self.kind == "rbf":
            out *= np.exp(-self.gamma * (x ** 2).sum(1))[:, None]
        return out


def kernel_values(df: DataFrame, support: np.ndarray, kind: str, gamma: float = 1.0, degree: int = 3,
                  features: str = "features", name: str = "kernel") -> DataFrame:
    """Append the kernel of each row with every point of a model-sized support set."""
    if support.nbytes > MAX_SUPPORT_BYTES:
        raise ValueError("support set too large to ship; use kernel_sums")
    return vectors.map_vectors(df, lambda x: [kernel_matrix(kind, x, support, gamma, degree)], [(name, vectors.VECTOR)], features)


def kernel_score(df: DataFrame, support: np.ndarray, coef: np.ndarray, bias: float, kind: str, gamma: float = 1.0,
                 degree: int = 3, features: str = "features") -> DataFrame:
    """Append score = Σ_j coef_j K(x, x_j) + bias and its sign."""
    if support.nbytes > MAX_SUPPORT_BYTES:
        raise ValueError("support set too large to ship; use kernel_sums or kernel_sums_in_blocks")

    def run(x):
        y = np.full(len(x), float(bias))
        for at in range(0, len(support), SUPPORT_ROWS):
            y += kernel_matrix(kind, x, support[at:at + SUPPORT_ROWS], gamma, degree) @ coef[at:at + SUPPORT_ROWS]
        return y, np.sign(y).astype(int)

    return vectors.map_vectors(df, run, [("score", T.DoubleType()), ("sign", T.IntegerType())], features)


def kernel_sums(df: DataFrame, train: DataFrame, coef: str, fmap: FeatureMap, bias: float = 0.0,
                features: str = "features") -> DataFrame:
    """The same score against a training table of any size, through the feature map."""
    s = vectors.collect_sums(vectors.block_sums(
        train, lambda x, c: fmap(x).T @ c[coef].astype(float), features=features, extra=[coef]), len(fmap.terms))

    def run(x):
        y = fmap(x) @ s + bias
        return y, np.sign(y).astype(int)

    return vectors.map_vectors(df, run, [("score", T.DoubleType()), ("sign", T.IntegerType())], features)


def kernel_sums_in_blocks(df: DataFrame, train: DataFrame, coef: str, kind: str, gamma: float = 1.0, degree: int = 3,
                          bias: float = 0.0, features: str = "features", id_col: str = "id", block_rows: int = 4096) -> DataFrame:
    """(id, score, sign): the same score without a feature map, for any kernel, dimension and size.

    Blocks of rows meet blocks of training rows; a pair of blocks gives one
    partial sum per row. Each row is copied once per block of the other side,
    and the work is rows x rows.
    """
    blocks = [max(1, math.ceil(t.count() / block_rows)) for t in (df, train)]
    q = (df.select(F.col(id_col).alias("id"), F.col(features).alias("x")).withColumn("qb", F.pmod(F.xxhash64("id"), F.lit(blocks[0])))
         .withColumn("tb", F.explode(F.sequence(F.lit(0), F.lit(blocks[1] - 1)).cast("array<bigint>"))))
    t = (train.select(F.col(features).alias("x"), F.col(coef).cast("double").alias("c")).withColumn("tb", F.pmod(F.xxhash64("x", "c"), F.lit(blocks[1])))
         .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(blocks[0] - 1)).cast("array<bigint>"))))

    def partial(rows: pa.Table, known: pa.Table) -> pa.Table:
        y = np.zeros(len(rows))
        if len(rows) and len(known):
            a, b, c = vectors.as_matrix(rows.column("x")), vectors.as_matrix(known.column("x")), known.column("c").to_numpy()
            for at in range(0, len(a), 1024):
                y[at:at + 1024] = kernel_matrix(kind, a[at:at + 1024], b, gamma, degree) @ c
        return pa.table({"id": rows.column("id"), "y": pa.array(y)})

    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType), T.StructField("y", T.DoubleType())])
    sums = q.groupBy("qb", "tb").cogroup(t.groupBy("qb", "tb")).applyInArrow(partial, schema).groupBy("id").agg((F.sum("y") + F.lit(float(bias))).alias("score"))
    return sums.select(F.col("id").alias(id_col), "score", F.signum("score").cast("int").alias("sign"))


def support_rows(df: DataFrame, alpha: str, sign: str, tolerance: float = 1e-7) -> DataFrame:
    """Rows that carry weight (a_i > tolerance), with coefficient a_i·t_i."""
    return df.where(F.col(alpha) > tolerance).withColumn("coef", F.col(alpha) * F.col(sign))


@dataclass
class KernelRegression:
    """Dual coefficients, as a formula over rows.

    A full-batch step maps β to (1 - lr·l2)β - lr/n (Kβ - r) with r = t - bias,
    so after any number of steps β_i = c_b r_i - φ(x_i)·g_b, where b is the
    batch of row i. Only c and g change, and they need φᵀφ and φᵀr alone.
    """

    fmap: FeatureMap
    bias: float
    c: dict
    g: dict
    s: np.ndarray

    def predict(self, df: DataFrame, features: str = "features") -> DataFrame:
        fmap, s, bias = self.fmap, self.s, self.bias
        return vectors.map_vectors(df, lambda x: [fmap(x) @ s + bias], [("prediction", T.DoubleType())], features)

    def betas(self, df: DataFrame, target: str, batch: str = "batch", features: str = "features") -> DataFrame:
        """Append the dual coefficient of each training row."""
        fmap = self.fmap
        keys = sorted(self.g)
        g = np.stack([self.g[k] for k in keys], 1)
        dots = vectors.map_vectors(df, lambda x: [fmap(x) @ g], [("_p", vectors.VECTOR)], features)
        at = F.array_position(F.array(*[F.lit(k) for k in keys]), F.col(batch)).cast("int")
        c = F.element_at(F.array(*[F.lit(float(self.c[k])) for k in keys]), at)
        return dots.withColumn("beta", c * (F.col(target) - F.lit(self.bias)) - F.element_at("_p", at)).drop("_p")


def fit_regression(df: DataFrame, fmap: FeatureMap, iterations: int, learning_rate: float, l2: float = 0.0,
                   features: str = "features", target: str = "target", batch: str = "batch", is_test: str = "is_test"):
    """Dual gradient steps; returns (model, curve of (iteration, is_test, rmse)).

    The bias is the mean training target for both splits. `batch` numbers the
    (few) batches from 0; each iteration visits them in order and decays all
    coefficients at each step. Two scans in total: the mean, then the sums.
    """
    bias = float(df.where(~F.col(is_test)).agg(F.avg(target)).first()[0])
    d = len(fmap.terms)
    upper = np.triu_indices(d)

    def block(x, cols):
        f, r = fmap(x), cols[target].astype(float) - bias
        return np.concatenate([[len(x), (r * r).sum()], f.T @ r, (f.T @ f)[upper]])

    keyed = df.withColumn("_b", F.when(F.col(is_test), F.lit(-1)).otherwise(F.col(batch)).cast("int"))
    sums = vectors.collect_sums(vectors.block_sums(keyed, block, group="_b", features=features, extra=[target]),
                                2 + d + len(upper[0]), "_b")

    def unpack(v):
        m = np.zeros((d, d))
        m[upper] = v[2 + d:]
        return v[0], v[1], v[2:2 + d], m + np.triu(m, 1).T

    parts = {b: unpack(v) for b, v in sums.items()}
    train = sorted(b for b in parts if b >= 0)
    c, g = {b: 0.0 for b in train}, {b: np.zeros(d) for b in train}
    s = np.zeros(d)
    curve = []

    def rmse(keys, s):
        n = sum(parts[b][0] for b in keys)
        e = sum(s @ parts[b][3] @ s - 2 * s @ parts[b][2] + parts[b][1] for b in keys)
        return float(np.sqrt(max(e, 0.0) / n))

    for step in range(1, iterations + 1):
        for b in train:
            n = parts[b][0]
            grad = s
            for k in train:
                c[k] *= 1 - learning_rate * l2
                g[k] = g[k] * (1 - learning_rate * l2)
            c[b] += learning_rate / n
            g[b] = g[b] + learning_rate / n * grad
            s = sum(c[k] * parts[k][2] - parts[k][3] @ g[k] for k in train)
        curve.append((step, False, rmse(train, s)))
        if -1 in parts:
            curve.append((step, True, rmse([-1], s)))
    return KernelRegression(fmap, bias, c, g, s), curve
