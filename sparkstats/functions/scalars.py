"""Scalar statistics as column expressions."""

import math

from pyspark.sql import Column, functions as F

CLIP = 1e-15


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def sigmoid(x) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_col(x)))


def log_loss_binary(p, t) -> Column:
    """Cross-entropy of one row; p is clipped so that a sure mistake stays finite."""
    p = F.greatest(F.lit(CLIP), F.least(F.lit(1.0 - CLIP), _col(p)))
    t = _col(t)
    return -t * F.ln(p) - (F.lit(1.0) - t) * F.ln(F.lit(1.0) - p)


def log_loss_multi(p, label) -> Column:
    """-ln of the probability given to the true class (any number of classes)."""
    return -F.ln(F.greatest(F.lit(CLIP), F.get(_col(p), _col(label))))


def gaussian_logpdf(x, mean, variance) -> Column:
    x, mean, variance = _col(x), _col(mean), _col(variance)
    return -0.5 * F.ln(F.lit(2 * math.pi) * variance) - F.pow(x - mean, F.lit(2.0)) / (F.lit(2.0) * variance)


def f_beta(tp, fp, fn, beta) -> Column:
    """NULL when every count is zero."""
    tp, fp, fn = (_col(c).cast("double") for c in (tp, fp, fn))
    b2 = _col(beta) * _col(beta)
    return F.try_divide(tp + b2 * tp, tp + fp + b2 * (tp + fn))


def binarize(x, threshold: float) -> Column:
    """1 when x >= threshold (inclusive)."""
    return (_col(x) >= F.lit(float(threshold))).cast("double")


def label_index(label, classes: list[str]) -> Column:
    """Position in a fixed list; an unknown label is an error."""
    at = F.array_position(F.array(*[F.lit(c) for c in classes]), _col(label))
    return (F.when(at > 0, at - 1)
            .otherwise(F.raise_error(F.concat(F.lit("unknown label: "), _col(label))))).cast("int")


def to_sign(t) -> Column:
    """{0, 1} to {-1, +1}."""
    return F.lit(2) * _col(t) - F.lit(1)


def parity(t) -> Column:
    return _col(t) % 2


def clip(x, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), _col(x)))


def linspace(low: float, high: float, n: int) -> list[float]:
    return [low + (high - low) * i / (n - 1) for i in range(n)] if n > 1 else [low]


def geomspace(low: float, high: float, n: int) -> list[float]:
    return [low * (high / low) ** (i / (n - 1)) for i in range(n)] if n > 1 else [low]
