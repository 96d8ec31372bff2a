"""Naive Bayes by grouped sums: Gaussian, Bernoulli and multinomial."""

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, types as T

from ..functions import vectors

THRESHOLD = 8.0


@dataclass
class ClassSums:
    """Per class: row count, and sums of x, of squared deviations and of [x >= threshold]."""

    classes: list[int]
    n: np.ndarray
    total: np.ndarray
    square: np.ndarray
    bits: np.ndarray

    @property
    def priors(self) -> np.ndarray:
        """n_k / N, not smoothed."""
        return self.n / self.n.sum()

    @property
    def means(self) -> np.ndarray:
        return self.total / self.n[:, None]

    def variances(self, alpha: float) -> np.ndarray:
        """Population variance + alpha."""
        return self.square / self.n[:, None] + alpha

    def bernoulli(self, alpha: float) -> np.ndarray:
        return (self.bits + alpha) / (self.n[:, None] + 2 * alpha)

    def multinomial(self, alpha: float) -> np.ndarray:
        d = self.total.shape[1]
        return (self.total + alpha) / (self.total.sum(1, keepdims=True) + alpha * d)


def class_sums(df: DataFrame, dim: int, features: str = "features", label: str = "label",
               threshold: float = THRESHOLD) -> ClassSums:
    """One pass per class x feature. Squares are summed around the overall mean,
    found first, so that variances do not cancel."""
    first = vectors.collect_sums(vectors.block_sums(
        df, lambda x, _: np.concatenate([[len(x)], x.sum(0)]), features=features), dim + 1)
    shift = first[1:] / max(first[0], 1.0)

    def block(x, _):
        d = x - shift
        return np.concatenate([[len(x)], x.sum(0), d.sum(0), (d * d).sum(0), (x >= threshold).sum(0)])

    table = vectors.collect_sums(vectors.block_sums(df, block, group=label, features=features), 1 + 4 * dim, label)
    classes = sorted(table)
    rows = np.stack([table[c] for c in classes])
    n = rows[:, 0]
    total, dev, square, bits = (rows[:, 1 + i * dim:1 + (i + 1) * dim] for i in range(4))
    return ClassSums(classes, n, total, np.clip(square - dev * dev / n[:, None], 0, None), bits)


def class_table(spark, sums: ClassSums, matrix: np.ndarray, value: str) -> DataFrame:
    """A class x feature matrix as rows (label, feature, value)."""
    rows = [(int(c), d, float(matrix[k, d])) for k, c in enumerate(sums.classes) for d in range(matrix.shape[1])]
    return spark.createDataFrame(rows, f"label int, feature int, {value} double")


@dataclass
class NaiveBayes:
    kind: str
    classes: np.ndarray
    log_prior: np.ndarray
    params: dict

    def log_scores(self, x: np.ndarray) -> np.ndarray:
        """N x K log posterior up to a constant."""
        if self.kind == "gaussian":
            mean, var = self.params["mean"], self.params["variance"]
            out = np.stack([(-0.5 * np.log(2 * np.pi * v) - (x - m) ** 2 / (2 * v)).sum(1) for m, v in zip(mean, var)], 1)
        elif self.kind == "bernoulli":
            p = self.params["p"]
            bits = (x >= self.params["threshold"]).astype(float)
            out = bits @ np.log(p / (1 - p)).T + np.log(1 - p).sum(1)
        else:
            out = x @ np.log(self.params["p"]).T
        return out + self.log_prior

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        """Append (prediction, score); ties go to the smallest class."""
        model = self

        def predict(x):
            s = model.log_scores(x)
            best = s.argmax(1)
            return model.classes[best], s[np.arange(len(s)), best]

        return vectors.map_vectors(df, predict, [("prediction", T.IntegerType()), ("score", T.DoubleType())], features)


def fit(df: DataFrame, dim: int, kind: str = "gaussian", alpha: float = 0.1, features: str = "features",
        label: str = "label", threshold: float = THRESHOLD) -> NaiveBayes:
    s = class_sums(df, dim, features, label, threshold)
    if kind == "gaussian":
        params = {"mean": s.means, "variance": s.variances(alpha)}
    elif kind == "bernoulli":
        params = {"p": s.bernoulli(alpha), "threshold": threshold}
    elif kind == "multinomial":
        params = {"p": s.multinomial(alpha)}
    else:
        raise ValueError("kind must be gaussian, bernoulli or multinomial")
    return NaiveBayes(kind, np.array(s.classes), np.log(s.priors), params)
