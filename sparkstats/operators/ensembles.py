"""Estimators of `pyspark.ml`, set up with this library's feature stages."""

import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LinearSVC, LogisticRegression, MultilayerPerceptronClassifier,
                                       OneVsRest)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import HashingTF, RegexTokenizer, SQLTransformer
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from . import features as ft

WORDS = "[\\p{L}\\p{N}_]{2,}"
#: Bytes of the rows of a task of the text network, which holds them as full rows of numbers.
TASK_BYTES = 128 << 20


def logistic(c: float, rows: int, features: str = "vector", label: str = "label", max_iter: int = 100) -> LogisticRegression:
    """C·Σ loss + ½|w|², written as mean loss + λ/2·|w|² with λ = 1 / (rows·C)."""
    return LogisticRegression(featuresCol=features, labelCol=label, regParam=1.0 / (rows * c), elasticNetParam=0.0,
                              standardization=False, maxIter=max_iter, tol=1e-8)


def linear_svm(c: float, rows: int, features: str = "vector", label: str = "label", max_iter: int = 100) -> LinearSVC:
    """C·Σ hinge + ½|w|² on explicit features."""
    return LinearSVC(featuresCol=features, labelCol=label, regParam=1.0 / (rows * c), standardization=False,
                     maxIter=max_iter, tol=1e-6)


def svm(df: DataFrame, c: float = 1.0, kernel: str = "poly", degree: int = 1, gamma: float = 1.0, width: int = 256,
        kind: str = "standard", max_iter: int = 100) -> Pipeline:
    """Two-class SVM as a linear SVM on explicit features: monomials for the
    polynomial kernel, `width` random Fourier features for the RBF kernel."""
    if kernel not in ("poly", "rbf"):
        raise ValueError("kernel must be poly or rbf")
    expand = ft.PolyExpand("scaled", "wide", degree) if kernel == "poly" else ft.FourierFeatures("scaled", "wide", width, gamma)
    return Pipeline(stages=[ft.ScaleArray("features", "scaled", kind), expand, ft.ToVector("wide", "vector"),
                            linear_svm(c, df.count(), max_iter=max_iter)])


def support_vectors(scored: DataFrame, label: str = "label", tolerance: float = 1e-3) -> DataFrame:
    """Rows on or inside the margin of a fitted two-class SVM: those that determine it."""
    score = vector_to_array("rawPrediction")[1]
    sign = F.when(F.col(label) > 0, 1.0).otherwise(-1.0)
    return scored.where(sign * score <= 1.0 + tolerance)


def svm_multiclass(df: DataFrame, components: int, c: float = 10.0, degree: int = 3, max_iter: int = 50) -> Pipeline:
    """Standardise, project, expand, then one SVM per class. The projection
    keeps the number of monomials of a wide input within reach."""
    return Pipeline(stages=[ft.ScaleArray("features", "scaled", "standard"), ft.PcaProject("scaled", "projected", components),
                            ft.PolyExpand("projected", "poly", degree), ft.ToVector("poly", "vector"),
                            OneVsRest(classifier=linear_svm(c, df.count(), max_iter=max_iter), featuresCol="vector")])


def scaled_logistic(df: DataFrame, c: float = 1.0, degree: int = 1, components: int | None = None,
                    max_iter: int = 100) -> Pipeline:
    """Min-max scaling, optional projection, polynomials, logistic regression."""
    stages, at = [ft.ScaleArray("features", "scaled", "min_max")], "scaled"
    if components:
        stages.append(ft.PcaProject(at, "projected", components))
        at = "projected"
    if degree > 1:
        stages.append(ft.PolyExpand(at, "poly", degree))
        at = "poly"
    return Pipeline(stages=[*stages, ft.ToVector(at, "vector"), logistic(c, df.count(), max_iter=max_iter)])


def boosted_trees(max_depth: int = 6, trees: int = 500, step: float = 0.1, features: str = "vector",
                  label: str = "label", seed: int = 42) -> OneVsRest:
    """Gradient-boosted trees for any number of classes."""
    return OneVsRest(classifier=GBTClassifier(maxDepth=max_depth, maxIter=trees, stepSize=step, seed=seed),
                     featuresCol=features, labelCol=label)


def spread(df: DataFrame, width: int) -> DataFrame:
    """The rows dealt over as many tasks as full rows of `width` numbers take; as they are where one task can hold all."""
    parts = math.ceil(df.count() * width * 8 / TASK_BYTES)
    return df if parts <= 1 else df.repartition(max(parts, df.sparkSession.sparkContext.defaultParallelism))


def fit_text_mlp(df: DataFrame, width: int = 4096, text: str = "text", label: str = "label", hidden: tuple = (11, 2),
                 max_iter: int = 1000, tol: float = 2e-7, high: int = 3, seed: int = 42) -> PipelineModel:
    """Counts of word 1..`high`-grams into a two-class network.

    Every n-gram counts: it falls into one of `width` columns by its hash. The
    model held by the driver is the network's weights; the rows of a task take TASK_BYTES.
    """
    grams = ", ".join(
        f"transform(if(size(_toks) >= {n}, sequence(1, size(_toks) - {n - 1}), cast(array() as array<int>)), "
        f"i -> array_join(slice(_toks, i, {n}), ' '))" for n in range(1, high + 1))
    counts = PipelineModel(stages=[
        RegexTokenizer(inputCol=text, outputCol="_toks", pattern=WORDS, gaps=False, toLowercase=True),
        SQLTransformer(statement=f"SELECT *, concat({grams}) AS _grams FROM __THIS__"),
        HashingTF(inputCol="_grams", outputCol="vector", numFeatures=width)])
    network = MultilayerPerceptronClassifier(featuresCol="vector", labelCol=label, layers=[width, *hidden, 2],
                                             maxIter=max_iter, tol=tol, seed=seed)
    return PipelineModel(stages=[*counts.stages, network.fit(counts.transform(spread(df, width)))])


def grid_search(df: DataFrame, pipeline: Pipeline, grid: list, folds: str, k: int, label: str = "label",
                metric: str = "accuracy", parallelism: int = 4, train_scores: bool = False):
    """Every combination on every fold; the best mean score is refitted on all rows.

    Folds come from a column (see `stratified_folds`). Returns the fitted
    cross-validator and rows (combination, mean score), with the mean score on
    the training folds added if asked for.
    """
    evaluator = MulticlassClassificationEvaluator(labelCol=label, metricName=metric)
    cv = CrossValidator(estimator=pipeline, estimatorParamMaps=grid, numFolds=k, foldCol=folds, parallelism=parallelism,
                        evaluator=evaluator, collectSubModels=train_scores)
    model = cv.fit(df)
    if not train_scores:
        return model, list(enumerate(model.avgMetrics))
    seen = [sum(evaluator.evaluate(model.subModels[f][i].transform(df.where(F.col(folds) != f))) for f in range(k)) / k
            for i in range(len(grid))]
    return model, [(i, held_out, seen[i]) for i, held_out in enumerate(model.avgMetrics)]


__all__ = ["logistic", "linear_svm", "svm", "support_vectors", "svm_multiclass", "scaled_logistic", "boosted_trees", "fit_text_mlp",
           "grid_search", "ParamGridBuilder"]
