"""Evaluation metrics: each is one aggregate over the scored table."""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import scalars, text


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def accuracy(pred, label) -> Column:
    return F.avg((_col(pred) == _col(label)).cast("double"))


def accuracy_prob(p, t) -> Column:
    """Right when |p - t| <= 0.5, so 0.5 counts for both classes."""
    return F.avg((F.abs(_col(p) - _col(t)) <= 0.5).cast("double"))


def rmse(pred, target) -> Column:
    return F.sqrt(F.avg(F.pow(_col(pred) - _col(target), F.lit(2.0))))


def log_loss(p, t) -> Column:
    return F.avg(scalars.log_loss_binary(p, t))


def per_class_counts(df: DataFrame, pred: str, label: str) -> DataFrame:
    """(class, tp, predicted, actual) over the classes of either column."""
    both = F.explode(F.array(
        F.struct(F.col(pred).alias("class"), F.lit(1).alias("p"), F.lit(0).alias("a"),
                 (F.col(pred) == F.col(label)).cast("int").alias("hit")),
        F.struct(F.col(label).alias("class"), F.lit(0).alias("p"), F.lit(1).alias("a"), F.lit(0).alias("hit"))))
    return (df.select(both.alias("c")).groupBy("c.class")
            .agg(F.sum("c.hit").alias("tp"), F.sum("c.p").alias("predicted"), F.sum("c.a").alias("actual")))


def macro_f1(df: DataFrame, pred: str, label: str) -> DataFrame:
    """Unweighted mean F1 over all classes seen; 0 where F1 is undefined."""
    f1 = F.coalesce(F.try_divide(2.0 * F.col("tp"), F.col("predicted") + F.col("actual")), F.lit(0.0))
    return per_class_counts(df, pred, label).agg(F.avg(f1).alias("macro_f1"))


def word_hits(gold, system) -> Column:
    """(hits, words) of two texts compared word by word; differing word counts are an error."""
    g, s = text.words(gold), text.words(system)
    same = F.zip_with(g, s, lambda a, b: (a == b).cast("int"))
    hits = F.aggregate(same, F.lit(0), lambda acc, v: acc + v)
    n = F.when(F.size(g) == F.size(s), F.size(g)).otherwise(
        F.raise_error(F.lit("the two texts must have the same number of words")))
    return F.struct(n.alias("words"), hits.alias("hits"))


def word_accuracy(df: DataFrame, gold: str, system: str) -> DataFrame:
    return (df.select(word_hits(gold, system).alias("w"))
            .agg(F.sum("w.hits").alias("hits"), F.sum("w.words").alias("words"),
                 F.try_divide(F.sum("w.hits").cast("double"), F.sum("w.words")).alias("word_accuracy")))


def best_by(df: DataFrame, key: str, value: str, group: list[str] | None = None, lowest: bool = True) -> DataFrame:
    """The key with the least (or greatest) value; the first key wins ties."""
    v = F.col(value) if lowest else -F.col(value)
    pick = F.min(F.struct(v.alias("v"), F.col(key).alias("k"), F.col(value).alias("raw")))
    valid = df.where(F.col(value).isNotNull())
    out = valid.groupBy(*group).agg(pick.alias("b")) if group else valid.agg(pick.alias("b"))
    return out.select(*(group or []), F.col("b.k").alias(key), F.col("b.raw").alias(value))
