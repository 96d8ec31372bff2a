"""Seeded random numbers as column expressions.

Every draw is a hash of (seed, tag, row key). It does not depend on how rows
are partitioned, so retries, lost executors and re-layouts give equal results.
"""

import hashlib

from pyspark.sql import Column, functions as F

TWO32 = 4294967296


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def digest(seed: int, tag: str, *keys) -> Column:
    """32 hex digits that depend only on the seed, the tag and the keys."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(tag), *[_col(k).cast("string") for k in keys]))


def hash32(seed: int, tag: str, *keys) -> Column:
    """A uniform integer in [0, 2**32)."""
    return F.conv(F.substring(digest(seed, tag, *keys), 1, 8), 16, 10).cast("bigint")


def uniform(seed: int, tag: str, *keys) -> Column:
    """A uniform double in [0, 1)."""
    return hash32(seed, tag, *keys).cast("double") / F.lit(float(TWO32))


def lanes(hex_digits: Column) -> Column:
    """The four uniform integers in [0, 2**32) held in a 32-digit digest."""
    return F.array(*[F.conv(F.substring(hex_digits, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)])


def poisson1(h: Column) -> Column:
    """Poisson(1) multiplicity: the distribution function inverted at h / 2**32."""
    u = h.cast("double") / F.lit(float(TWO32))
    out = None
    for k, t in enumerate(poisson1_thresholds()):
        out = F.when(u < t, k) if out is None else out.when(u < t, k)
    return out.otherwise(k + 1).cast("int")


def poisson1_thresholds() -> list[float]:
    """P(X <= k) for k = 0, 1, 2, ..."""
    cdf, term, out = 0.0, 0.36787944117144233, []
    for k in range(1, 13):
        cdf += term
        out.append(cdf)
        term /= k
    return out


def uniform_value(seed: int, tag: str, *keys) -> float:
    """The same draw as `uniform`, for a few model-sized values on the driver."""
    text = ":".join([str(seed), tag, *[str(k) for k in keys]])
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16) / TWO32
