"""Feature building: categorical detection, one-hot, scaling, polynomials, quantiles.

Fitting reads the training table once or twice and keeps a model-sized state;
transforming is a projection. The classes at the end are `pyspark.ml` stages,
so they go into a `Pipeline`, a grid search and a saved `PipelineModel`.
"""

import json
import math

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import vectors
from . import project, sampling

MAX_CATEGORIES = 10_000
LANDMARKS = 1000
#: Bytes of numbers that one task makes where rows are dealt out, and tasks for each that reads, at most.
DEALT_BYTES, FAN = 4 << 20, 16


def dealt(df: DataFrame, width: int) -> DataFrame:
    """The rows dealt evenly over tasks, for a step that makes `width` numbers of each; as they are where one task makes them all.

    Files and their row groups can hold any number of rows. Rows go by their place, not by a key that many could share.
    """
    tasks = math.ceil(df.count() * width * 8 / DEALT_BYTES)
    return df if tasks <= 1 else df.repartition(min(tasks, FAN * df.rdd.getNumPartitions()), F.monotonically_increasing_id())


def infer_categorical(df: DataFrame, columns: list[str]) -> list[str]:
    """Columns that hold whole numbers only, decided over the whole table."""
    row = df.agg(*[F.bool_and(F.col(c).cast("double") % 1 == 0).alias(c) for c in columns]).first()
    return [c for c in columns if row[c]]


def distinct_categories(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, n) for all the columns, in one pass; values as strings."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]))
    return df.select(pairs.alias("p")).groupBy("p.column", "p.value").agg(F.count("*").alias("n"))


def categories(df: DataFrame, columns: list[str]) -> dict[str, list]:
    """Sorted distinct values per column, for columns of few values."""
    limit = MAX_CATEGORIES * max(len(columns), 1)
    rows = distinct_categories(df, columns).where(F.col("value").isNotNull()).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError("too many distinct values for one-hot columns")
    out = {}
    for c in columns:
        kind = df.schema[c].dataType
        cast = str if isinstance(kind, T.StringType) else float if isinstance(kind, (T.DoubleType, T.FloatType)) else int
        out[c] = sorted(cast(r["value"]) for r in rows if r["column"] == c)
    return out


def one_hot(column: str, values: list) -> Column:
    """0/1 per known category; an unknown value gives zeros."""
    return F.array(*[F.coalesce((F.col(column) == F.lit(v)).cast("double"), F.lit(0.0)) for v in values])


def column_stats(df: DataFrame, columns: list[str]) -> dict[str, dict[str, float]]:
    """min, max, mean and population deviation of each column, in one pass."""
    aggs = [f(F.col(c).cast("double")).alias(f"{c}_{n}") for c in columns
            for n, f in (("min", F.min), ("max", F.max), ("mean", F.avg), ("std", F.stddev_pop))]
    row = df.agg(*aggs).first()
    return {c: {n: row[f"{c}_{n}"] for n in ("min", "max", "mean", "std")} for c in columns}


def standardize(x: Column, mean: float, std: float) -> Column:
    """(x - mean) / population deviation; 0 for a constant column."""
    return (x - F.lit(float(mean))) / F.lit(float(std)) if std and std > 0 else x * 0.0


def min_max(x: Column, low: float, high: float) -> Column:
    """Scale to [0, 1]; 0 for a constant column."""
    return (x - F.lit(float(low))) / F.lit(float(high - low)) if high > low else x * 0.0


def quantile_landmarks(df: DataFrame, column: str, n: int = LANDMARKS) -> list[float]:
    """n evenly spaced exact quantiles."""
    return sampling.exact_quantiles(df, column, [i / (n - 1) for i in range(n)])


def quantile_values(x: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Position of x among the landmarks in [0, 1]; the middle of a flat run inside it."""
    refs = np.linspace(0, 1, len(marks))
    up = np.interp(x, marks, refs)
    down = -np.interp(-x, -marks[::-1], -refs[::-1])
    out = 0.5 * (up + down)
    return np.where(x <= marks[0], 0.0, np.where(x >= marks[-1], 1.0, out))


def quantile_transform(x: Column, landmarks: list[float]) -> Column:
    marks = np.array(landmarks, dtype=float)

    @F.pandas_udf("double")
    def run(s: pd.Series) -> pd.Series:
        return pd.Series(quantile_values(s.to_numpy(dtype=float), marks))

    return run(x.cast("double"))


def _vector_udf(fn):
    """An array<double> -> array<double> function over whole batches."""

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def run(s: pd.Series) -> pd.Series:
        if not len(s):
            return s
        return pd.Series(list(fn(np.array(s.tolist(), dtype=float))))

    return run


def poly_values(x: np.ndarray, degree: int, include_bias: bool) -> np.ndarray:
    seen = {(): np.ones(len(x))}
    out = []
    for term in vectors.monomials(x.shape[1], degree, include_bias):
        if term:
            seen[term] = seen[term[:-1]] * x[:, term[-1]] if term[:-1] else x[:, term[-1]]
        out.append(seen[term])
    return np.column_stack(out)


class _Stage(DefaultParamsReadable, DefaultParamsWritable):
    """A stage whose settings and fitted state are string params, so Spark saves them."""


class ColumnTransform(Estimator, _Stage):
    """Transforms of column groups, laid side by side in the given order.

    groups: list of (kind, columns) with kind one_hot, standard, min_max,
    quantile or pass. A column may appear in several groups; columns in none
    are dropped. The result is one array<double> column.
    """

    groups = Param(Params._dummy(), "groups", "column groups as JSON", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "output column", TypeConverters.toString)
    landmarks = Param(Params._dummy(), "landmarks", "number of quantile landmarks", TypeConverters.toInt)

    def __init__(self, groups=None, outputCol="features", landmarks=LANDMARKS):
        super().__init__()
        self._set(groups=json.dumps(groups or []), outputCol=outputCol, landmarks=landmarks)

    def _fit(self, df: DataFrame) -> "ColumnTransformModel":
        groups = json.loads(self.getOrDefault(self.groups))
        of = lambda *kinds: list(dict.fromkeys(c for k, cols in groups if k in kinds for c in cols))
        hot, scaled, ranked = of("one_hot"), of("standard", "min_max"), of("quantile")
        marks = min(self.getOrDefault(self.landmarks), max(df.count(), 2)) if ranked else 0
        state = {"groups": groups, "categories": categories(df, hot) if hot else {},
                 "stats": column_stats(df, scaled) if scaled else {},
                 "marks": {c: quantile_landmarks(df, c, marks) for c in ranked}}
        return ColumnTransformModel(json.dumps(state), self.getOrDefault(self.outputCol))


class ColumnTransformModel(Model, _Stage):
    state = Param(Params._dummy(), "state", "fitted state as JSON", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "output column", TypeConverters.toString)

    def __init__(self, state="{}", outputCol="features"):
        super().__init__()
        self._set(state=state, outputCol=outputCol)

    def width(self) -> int:
        """Numbers in a row of the result."""
        state = json.loads(self.getOrDefault(self.state))
        return sum(len(state["categories"][c]) if kind == "one_hot" else 1 for kind, cols in state["groups"] for c in cols)

    def _transform(self, df: DataFrame) -> DataFrame:
        state = json.loads(self.getOrDefault(self.state))
        parts = []
        for kind, cols in state["groups"]:
            for c in cols:
                x = F.col(c)
                if kind == "one_hot":
                    parts.append(one_hot(c, state["categories"][c]))
                    continue
                x = x.cast("double")
                if kind == "standard":
                    x = standardize(x, state["stats"][c]["mean"], state["stats"][c]["std"])
                elif kind == "min_max":
                    x = min_max(x, state["stats"][c]["min"], state["stats"][c]["max"])
                elif kind == "quantile":
                    x = quantile_transform(x, state["marks"][c])
                parts.append(F.array(x))
        return df.withColumn(self.getOrDefault(self.outputCol), F.concat(*parts))


class _ArrayStage(Transformer, _Stage):
    inputCol = Param(Params._dummy(), "inputCol", "input column", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "output column", TypeConverters.toString)


class PolyExpand(_ArrayStage):
    """Monomials up to a degree: all of degree 1, then all of degree 2, ..."""

    degree = Param(Params._dummy(), "degree", "highest degree", TypeConverters.toInt)
    includeBias = Param(Params._dummy(), "includeBias", "put a constant first", TypeConverters.toBoolean)

    def __init__(self, inputCol="features", outputCol="poly", degree=2, includeBias=False):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol, degree=degree, includeBias=includeBias)

    def _transform(self, df: DataFrame) -> DataFrame:
        degree, bias = self.getOrDefault(self.degree), self.getOrDefault(self.includeBias)
        run = _vector_udf(lambda x: poly_values(x, degree, bias))
        return df.withColumn(self.getOrDefault(self.outputCol), run(F.col(self.getOrDefault(self.inputCol))))


class FourierFeatures(_ArrayStage):
    """√(2/k)·cos(w·x + b) with w ~ N(0, 2γ): inner products approximate exp(-γ|x - y|²)."""

    k = Param(Params._dummy(), "k", "number of features", TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "kernel width", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "random seed", TypeConverters.toInt)

    def __init__(self, inputCol="features", outputCol="fourier", k=256, gamma=1.0, seed=42):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol, k=k, gamma=gamma, seed=seed)

    def _transform(self, df: DataFrame) -> DataFrame:
        k, gamma, seed = (self.getOrDefault(p) for p in (self.k, self.gamma, self.seed))

        def values(x):
            draw = np.random.Generator(np.random.PCG64(seed))
            w = draw.normal(scale=np.sqrt(2 * gamma), size=(x.shape[1], k))
            b = draw.uniform(0, 2 * np.pi, size=k)
            return np.sqrt(2.0 / k) * np.cos(x @ w + b)

        return df.withColumn(self.getOrDefault(self.outputCol), _vector_udf(values)(F.col(self.getOrDefault(self.inputCol))))


class ToVector(_ArrayStage):
    """array<double> to the vector type of `pyspark.ml` estimators."""

    def __init__(self, inputCol="features", outputCol="vector"):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.getOrDefault(self.outputCol), array_to_vector(F.col(self.getOrDefault(self.inputCol))))


class ScaleArray(Estimator, _Stage):
    """Min-max or standard scaling of every element of an array column."""

    inputCol = Param(Params._dummy(), "inputCol", "input column", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "output column", TypeConverters.toString)
    kind = Param(Params._dummy(), "kind", "min_max or standard", TypeConverters.toString)

    def __init__(self, inputCol="features", outputCol="scaled", kind="min_max"):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol, kind=kind)

    def _fit(self, df: DataFrame) -> "LinearArrayModel":
        col = self.getOrDefault(self.inputCol)
        rows = sorted(array_stats(df, col).collect(), key=lambda r: r["d"])
        if self.getOrDefault(self.kind) == "min_max":
            shift = [r["min"] for r in rows]
            size = [r["max"] - r["min"] for r in rows]
        else:
            shift = [r["mean"] for r in rows]
            size = [r["std"] for r in rows]
        scale = [1.0 / s if s > 0 else 0.0 for s in size]
        return LinearArrayModel(json.dumps({"shift": shift, "scale": scale}), col, self.getOrDefault(self.outputCol))


def array_stats(df: DataFrame, features: str = "features") -> DataFrame:
    """(d, min, max, mean, std): statistics of every element of an array column."""
    return (df.select(F.posexplode(features).alias("d", "x")).groupBy("d")
            .agg(F.min("x").alias("min"), F.max("x").alias("max"), F.avg("x").alias("mean"), F.stddev_pop("x").alias("std")))


class PcaProject(Estimator, _Stage):
    """Principal components; the projection does not centre its input."""

    inputCol = Param(Params._dummy(), "inputCol", "input column", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "output column", TypeConverters.toString)
    k = Param(Params._dummy(), "k", "number of components", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "random seed", TypeConverters.toInt)

    def __init__(self, inputCol="features", outputCol="projected", k=2, seed=42):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol, k=k, seed=seed)

    def _fit(self, df: DataFrame) -> "LinearArrayModel":
        col = self.getOrDefault(self.inputCol)
        dim = df.select(F.max(F.size(col))).first()[0]
        v = project.fit(df, dim, self.getOrDefault(self.k), self.getOrDefault(self.seed), col)
        return LinearArrayModel(json.dumps({"matrix": v.tolist()}), col, self.getOrDefault(self.outputCol))


class LinearArrayModel(Model, _Stage):
    """((x - shift) * scale) · matrix, each part optional."""

    inputCol = Param(Params._dummy(), "inputCol", "input column", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "output column", TypeConverters.toString)
    state = Param(Params._dummy(), "state", "fitted state as JSON", TypeConverters.toString)

    def __init__(self, state="{}", inputCol="features", outputCol="scaled"):
        super().__init__()
        self._set(state=state, inputCol=inputCol, outputCol=outputCol)

    def _transform(self, df: DataFrame) -> DataFrame:
        state = json.loads(self.getOrDefault(self.state))
        shift, scale = np.array(state.get("shift", 0.0)), np.array(state.get("scale", 1.0))
        matrix = np.array(state["matrix"]) if "matrix" in state else None
        run = _vector_udf(lambda x: (x - shift) * scale @ matrix if matrix is not None else (x - shift) * scale)
        return df.withColumn(self.getOrDefault(self.outputCol), run(F.col(self.getOrDefault(self.inputCol))))
