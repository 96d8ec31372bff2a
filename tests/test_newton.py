"""Newton fits of many logistic models against single fits by plain numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkstats.operators import newton


def optimum(x, t, c):
    """Damped Newton on one model until the gradient is gone."""
    x1 = np.column_stack([x, np.ones(len(x))])
    ridge = np.diag(np.append(np.ones(x.shape[1]), 0.0))
    value = lambda w: c * np.sum(np.logaddexp(0, x1 @ w) - t * (x1 @ w)) + w @ ridge @ w / 2
    w = np.zeros(x1.shape[1])
    for _ in range(200):
        p = 1 / (1 + np.exp(-x1 @ w))
        g = c * x1.T @ (p - t) + ridge @ w
        step, size = np.linalg.solve(c * (x1.T * (p * (1 - p))) @ x1 + ridge, g), 1.0
        while value(w - size * step) > value(w) * (1 + 1e-12) + 1e-12 and size > 1e-9:
            size /= 2
        w = w - size * step
    assert np.abs(g).max() < 1e-7
    return w


@pytest.fixture(scope="module")
def rows(spark):
    r = np.random.default_rng(11)
    x = r.normal(size=(240, 3))
    x[:80] = x[0]  # a third of all rows are copies
    t = (x @ [1.0, -2.0, 0.5] + r.normal(size=240) > 0.3).astype(int)
    fold = r.integers(0, 3, 240)
    df = spark.createDataFrame([(i, [float(v) for v in x[i]], int(t[i]), int(fold[i])) for i in range(240)],
                               "id long, features array<double>, label int, fold int").repartition(5)
    return df, x, t, fold


def test_every_model_is_at_its_optimum(spark, rows):
    df, x, t, fold = rows
    odd = spark.createDataFrame([(1000, None, 1, 0), (1001, [1.0, 2.0, 3.0], None, 1), (1002, [9.0, 9.0, 9.0], 0, None)], df.schema)
    models = newton.fit_many(df.unionByName(odd), 3, [0.01, 1.0, 1000.0], [0, 1, 2, newton.ALL])
    assert [(m.c, m.fold) for m in models] == [(c, f) for c in (0.01, 1.0, 1000.0) for f in (0, 1, 2, -1)]
    for m in models:
        keep = fold != m.fold
        assert m.done and m.w == pytest.approx(optimum(x[keep], t[keep], m.c), abs=1e-7)


def test_separable_classes_need_halved_steps(spark):
    x = np.linspace(-1, 1, 40)[:, None] * [[1.0, 50.0]]
    t = (x[:, 0] > 0).astype(int)
    df = spark.createDataFrame([([float(v) for v in a], int(b), 0) for a, b in zip(x, t)], "features array<double>, label int, fold int")
    m = newton.fit_many(df, 2, [1e4], [newton.ALL])[0]
    assert m.done and m.w == pytest.approx(optimum(x, t, 1e4), rel=1e-6, abs=1e-6)


def test_grid_scores_and_refit(spark, rows):
    df, x, t, fold = rows
    grid = [0.001, 0.1, 10.0]
    found, best = newton.grid_search(df, df.where("id % 2 = 0").drop("fold"), 3, grid, 3)
    hits = lambda w, at: float(np.mean((np.column_stack([x[at], np.ones(at.sum())]) @ w >= 0) == (t[at] == 1)))
    for c, (got, accuracy, loss, tested) in zip(grid, found):
        each = [hits(optimum(x[fold != f], t[fold != f], c), fold == f) for f in range(3)]
        assert got == c and accuracy == pytest.approx(np.mean(each)) and loss > 0
        assert tested == pytest.approx(hits(optimum(x, t, c), np.arange(240) % 2 == 0))
    assert best[1] == max(row[1] for row in found)


def test_empty_and_one_class(spark, rows):
    df, *_ = rows
    none = newton.fit_many(df.where("id < 0"), 3, [1.0], [0, newton.ALL])
    assert all(m.w.tolist() == [0.0] * 4 for m in none) and newton.scores(df.where("id < 0"), none) == [(None, None)] * 2
    one = newton.fit_many(df.withColumn("label", F.lit(1)), 3, [1.0], [newton.ALL], max_steps=12)[0]
    assert np.isfinite(one.w).all() and newton.scores(df.withColumn("label", F.lit(1)), [one])[0][0] == 1.0


def test_a_pass_holds_few_rows_for_all_models_at_once():
    import tracemalloc
    rng = np.random.default_rng(4)
    models = [newton.Fit(1.0, f, rng.normal(size=9)) for _ in range(12) for f in (0, 1, newton.ALL)]
    x, cols = rng.normal(size=(30_000, 8)), {"label": rng.integers(0, 2, 30_000).astype(float), "fold": rng.integers(0, 2, 30_000)}
    block = newton._sums(models, "label", "fold")
    tracemalloc.start()
    found = block(x, cols)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 << 20  # one array of 30,000 x 36 numbers
    halves = sum(block(x[s], {c: v[s] for c, v in cols.items()}) for s in (slice(0, 700), slice(700, None)))
    assert np.allclose(found, halves)
