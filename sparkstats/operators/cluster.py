"""k-means with random or k-means++ initialisation."""

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from ..functions import rng, vectors
from . import sampling
from .cache import held


def lp_distances(x: np.ndarray, points: np.ndarray, p: int = 2) -> np.ndarray:
    """N x M distances (sum |x - y|^p)^(1/p), from plain differences."""
    out = np.empty((len(x), len(points)))
    for j, c in enumerate(points):
        out[:, j] = (np.abs(x - c) ** p).sum(1) ** (1.0 / p)
    return out


def distances_to(df: DataFrame, points: np.ndarray, p: int = 2, features: str = "features",
                 name: str = "distances") -> DataFrame:
    """Append the distances of each row to a model-sized list of points."""
    return vectors.map_vectors(df, lambda x: [lp_distances(x, points, p)], [(name, vectors.VECTOR)], features)


def nearest_center(df: DataFrame, centers: np.ndarray, features: str = "features") -> DataFrame:
    """Append (cluster, distance); an equidistant row goes to the lowest index."""

    def run(x):
        d = np.round(lp_distances(x, centers), 12)
        best = d.argmin(1)
        return best, d[np.arange(len(x)), best]

    return vectors.map_vectors(df, run, [("cluster", T.IntegerType()), ("distance", T.DoubleType())], features)


def random_init(df: DataFrame, k: int, seed: int = 42, id_col: str = "id", features: str = "features"):
    """k distinct rows; returns (ids, centers)."""
    rows = sampling.sample_rows(df.select(id_col, features), id_col, k, seed, "init").collect()
    return [r[0] for r in rows], np.array([r[1] for r in rows], dtype=float)


def plus_plus_init(df: DataFrame, k: int, seed: int = 42, id_col: str = "id", features: str = "features",
                   cache: bool = True):
    """k-means++: each next centre drawn with probability ∝ squared distance.

    Weighted sampling is a race: the row with the least -ln(u) / d² wins. That
    is one min aggregate per centre; chosen rows have d = 0 and cannot win.
    """
    with held(df.select(id_col, features), cache) as src:
        ids, centers = random_init(src, 1, seed, id_col, features)
        while len(ids) < k:
            scored = vectors.map_vectors(
                src, lambda x: [np.round(lp_distances(x, centers).min(1), 12) ** 2], [("_d2", T.DoubleType())], features)
            u = (rng.hash32(seed, "race", F.lit(len(ids)), id_col).cast("double") + 0.5) / float(rng.TWO32)
            key = F.try_divide(-F.ln(u), F.col("_d2"))
            row = scored.where(F.col("_d2") > 0).agg(F.min(F.struct(key, F.col(id_col), F.col(features))).alias("m")).first()["m"]
            if row is None:
                raise ValueError("fewer distinct points than clusters")
            ids.append(row[1])
            centers = np.vstack([centers, np.array(row[2], dtype=float)])
    return ids, centers


def center_sums(centers: np.ndarray):
    """A block function: per cluster [rows, sum of x...], and the inertia last."""
    k, dim = centers.shape

    def block(x, _):
        d = np.round(lp_distances(x, centers), 12)
        best = d.argmin(1)
        out = np.zeros((k, dim + 1))
        np.add.at(out, best, np.column_stack([np.ones(len(x)), x]))
        return np.append(out.ravel(), (d[np.arange(len(x)), best] ** 2).sum())

    return block


def kmeans(df: DataFrame, centers: np.ndarray, iterations: int, features: str = "features", cache: bool = True):
    """A fixed number of iterations; returns (assigned, centers, inertias).

    `assigned` holds the assignment made before the last centre update. An
    empty cluster keeps its centre. Each iteration is one aggregate that
    shuffles k x D sums per task.
    """
    centers = np.array(centers, dtype=float)
    k, dim = centers.shape
    before, inertias = centers, []
    with held(df.select(features), cache) as src:
        for _ in range(iterations):
            s = vectors.collect_sums(vectors.block_sums(src, center_sums(centers), features=features), k * (dim + 1) + 1)
            table, before = s[:-1].reshape(k, dim + 1), centers
            inertias.append(float(s[-1]))
            counts = table[:, :1]
            centers = np.where(counts > 0, table[:, 1:] / np.maximum(counts, 1), centers)
    return nearest_center(df, before, features), centers, inertias


def center_table(spark, centers: np.ndarray) -> DataFrame:
    rows = [(k, d, float(v)) for k, c in enumerate(centers) for d, v in enumerate(c)]
    return spark.createDataFrame(rows, "cluster int, d int, value double")
