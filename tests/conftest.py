import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]


@pytest.fixture(scope="session")
def spark():
    import compare
    return compare.session()


@pytest.fixture(scope="session")
def points(spark):
    """200 seeded 3-D rows in clumps with copies: (id, features, label)."""
    import numpy as np
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(200, 3)) + 4 * rng.integers(0, 3, size=(200, 1)), 2)
    x[50:110] = x[7]  # one vector holds almost a third of all rows
    rows = [(int(i), [float(v) for v in x[i]], int(x[i].sum() > 9) + int(x[i, 0] > 4)) for i in range(200)]
    return spark.createDataFrame(rows, "id long, features array<double>, label int"), x, [r[2] for r in rows]
