"""Ready-made queries over the test tables, each with its SQL counterpart where one exists."""

from . import scans, vectors_and_columns, texts, fits  # noqa: F401  (they register their queries)
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
