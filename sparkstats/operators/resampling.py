"""Edit counts, F-beta and its correlation with ratings over bootstrap samples."""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import scalars
from . import sampling


def edit_counts(df: DataFrame, group: str | None, gold: str, predicted: str, correct: str, rating: str,
                times: str | None = None) -> DataFrame:
    """(group, tp, fp, fn, rating): sums of edits and the mean rating, rows counted `times` over."""
    w = F.col(times) if times else F.lit(1)
    aggs = [F.sum(w * F.col(correct)).alias("tp"),
            F.sum(w * (F.col(predicted) - F.col(correct))).alias("fp"),
            F.sum(w * (F.col(gold) - F.col(correct))).alias("fn"),
            (F.sum(w * F.col(rating)).cast("double") / F.sum(w)).alias("rating")]
    return df.groupBy(group).agg(*aggs) if group else df.agg(*aggs)


def pearson(x, y) -> Column:
    """Correlation as an aggregate; NULL when either side is constant."""
    x, y = (F.col(c) if isinstance(c, str) else c for c in (x, y))
    both = F.when(x.isNotNull() & y.isNotNull(), F.lit(1))
    flat = (F.max(both * x) <= F.min(both * x)) | (F.max(both * y) <= F.min(both * y))
    spread = F.stddev_pop(both * x) * F.stddev_pop(both * y)
    return F.when(~flat, F.try_divide(F.covar_pop(x, y), spread))


def f_beta_correlations(samples: DataFrame, betas: list[float]) -> DataFrame:
    """(beta, correlation) of F-beta with the rating over the sample table."""
    grid = F.explode(F.array(*[F.lit(float(b)) for b in betas]))
    scored = (samples.withColumn("beta", grid)
              .withColumn("f", scalars.f_beta("tp", "fp", "fn", "beta")))
    return scored.groupBy("beta").agg(pearson("f", "rating").alias("correlation"))


def bootstrap_counts(df: DataFrame, id_col: str, samples: int, columns: dict[str, str], seed: int = 42,
                     exact: bool = False) -> DataFrame:
    """`edit_counts` of every bootstrap sample; partial sums leave the map side."""
    drawn = (sampling.bootstrap_exact if exact else sampling.bootstrap_weights)(df, id_col, samples, seed)
    return edit_counts(drawn, "sample", columns["gold"], columns["predicted"], columns["correct"], columns["rating"], "times")
