"""Keeping the input of an iterative fit for the length of the fit."""

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame


@contextmanager
def held(df: DataFrame, cache: bool = True):
    """Persist `df` inside the block; with cache=False every step re-reads its source.

    Lost blocks are recomputed from the source, and the plan of a step never
    contains an earlier step.
    """
    if not cache:
        yield df
        return
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()
