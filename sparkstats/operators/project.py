"""Principal components from the distributed covariance matrix."""

import numpy as np
from pyspark.sql import DataFrame

from ..functions import rng, vectors
from .gram import vector_moments

POWER_LIMIT = 10
POWER_ITERATIONS = 10
DECIMALS = 4


def power_components(s: np.ndarray, k: int, seed: int = 42) -> np.ndarray:
    """k components as columns: power iteration with deflation, then rounding."""
    d = len(s)
    out = np.zeros((d, k))
    for c in range(k):
        v = np.array([2 * rng.uniform_value(seed, "pca", c, i) - 1 for i in range(d)])
        size = 0.0
        for _ in range(POWER_ITERATIONS):
            v = s @ v
            size = np.linalg.norm(v)
            v = v / size if size > 0 else v
        out[:, c] = v
        s = s - size * np.outer(v, v)
    return np.around(out, DECIMALS)


def spectral_components(s: np.ndarray, k: int) -> np.ndarray:
    """The k leading eigenvectors; the largest entry of each is made positive."""
    values, basis = np.linalg.eigh(s)
    v = basis[:, np.argsort(-values, kind="stable")[:k]]
    flip = np.sign(v[np.abs(v).argmax(0), np.arange(v.shape[1])])
    return np.around(v * np.where(flip == 0, 1, flip), DECIMALS)


def fit(df: DataFrame, dim: int, k: int, seed: int = 42, features: str = "features") -> np.ndarray:
    """D x k components: power iteration for up to 10, a full decomposition beyond."""
    s = vector_moments(df, dim, features, center=True).covariance()
    return power_components(s, k, seed) if k <= POWER_LIMIT else spectral_components(s, k)


def transform(df: DataFrame, components: np.ndarray, features: str = "features", name: str = "projected") -> DataFrame:
    """x·V. The projection does not centre x."""
    return vectors.map_vectors(df, lambda x: [x @ components], [(name, vectors.VECTOR)], features)
