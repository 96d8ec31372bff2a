"""Boosted trees against trees grown row by row."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkstats.operators import boosting

EDGES = [[1.0, 3.0, 5.0, 7.0], [0.0, 4.0, 8.0], [2.0, 6.0]]


def slow_trees(x, y, classes, rounds, depth, step, ridge=1.0):
    """Rows of trees: nested tuples (feature, threshold, left, right) or a leaf's value, and the loss before each round."""
    n = len(y)
    scores = [[math.log(max(y.count(k), 0.5) / n) for k in range(classes)] for _ in y]
    out, losses = [], []
    for _ in range(rounds):
        p = []
        for s in scores:
            e = [math.exp(v) for v in s]
            p.append([v / sum(e) for v in e])
        losses.append(sum(-math.log(q[c]) for q, c in zip(p, y)) / n)
        trees = []
        for k in range(classes):
            g, h = [q[k] - (c == k) for q, c in zip(p, y)], [q[k] * (1 - q[k]) for q in p]

            def worth(rows):
                return sum(g[i] for i in rows) ** 2 / (sum(h[i] for i in rows) + ridge)

            def grow(rows, left):
                best = (1e-9, None)
                for j, marks in enumerate(EDGES if left else []):
                    for t in marks:
                        low, high = [i for i in rows if not x[i][j] > t], [i for i in rows if x[i][j] > t]
                        if low and high:
                            gain = worth(low) + worth(high) - worth(rows)
                            if gain > best[0] + 1e-6:
                                best = (gain, (j, t, low, high))
                if best[1] is None:
                    return -sum(g[i] for i in rows) / (sum(h[i] for i in rows) + ridge)
                j, t, low, high = best[1]
                return (j, t, grow(low, left - 1), grow(high, left - 1))
            trees.append(grow(range(n), depth))
        out.append(trees)
        for i in range(n):
            for k in range(classes):
                scores[i][k] += step * value_of(trees[k], x[i])
    return out, losses, scores


def value_of(tree, row):
    while isinstance(tree, tuple):
        tree = tree[3] if row[tree[0]] > tree[1] else tree[2]
    return tree


def test_trees_are_those_grown_row_by_row(spark, points):
    df, x, y = points
    rounds, depth, step = 5, 3, 0.3
    model = boosting.fit(df.repartition(5), 3, 3, rounds=rounds, depth=depth, step=step, bins=8, edges=EDGES, rewrite=2)
    want, losses, scores = slow_trees(x.tolist(), y, 3, rounds, depth, step)
    assert np.allclose(model.losses, losses, atol=1e-6) and losses[-1] < losses[0]
    got = {r["id"]: r for r in model.transform(df).collect()}
    assert np.allclose([got[i]["scores"] for i in range(len(y))], scores, atol=1e-5)
    assert all(got[i]["prediction"] == int(np.argmax(scores[i])) for i in got)
    assert sum(got[i]["prediction"] == y[i] for i in got) > 150
    root = model.table(spark).where("node = 0 and round = 0").orderBy("class").collect()
    assert [(r["feature"], r["threshold"]) for r in root] == [t[:2] for t in want[0]]


def test_partitions_do_not_change_the_trees(spark, points):
    df, _, _ = points
    one = boosting.fit(df.coalesce(1), 3, 3, rounds=3, depth=2, bins=8, edges=EDGES)
    other = boosting.fit(df.repartition(9), 3, 3, rounds=3, depth=2, bins=8, edges=EDGES)
    for a, b in zip(sum(one.rounds, []), sum(other.rounds, [])):
        assert (a.feature == b.feature).all() and (a.cut == b.cut).all() and (a.value == b.value).all()
    assert one.losses == other.losses


def test_odd_rows(spark, points):
    df, _, _ = points
    nan = float("nan")
    rows = [([1.0, nan], 0), ([None, 2.0], 0), ([5.0, 2.0], 1), ([5.0, 2.0], 1), (None, 1), ([1.0, 1.0], None)]
    odd = spark.createDataFrame(rows, "features array<double>, label int").withColumn("y", F.lit("x")).withColumn("codes", F.lit(1))
    model = boosting.fit(odd, 2, 3, rounds=2, depth=2, bins=4)
    assert math.isclose(model.losses[0], -math.log(0.5 / (0.5 + 0.5 + 0.125)), abs_tol=1e-6)
    assert [r["prediction"] for r in model.transform(odd.where("features is not null and features[0] is not null"))
            .where("label is not null").collect()] == [0, 1, 1]
    empty = boosting.fit(odd.limit(0), 2, 3)
    assert empty.rounds == [] and empty.transform(odd.limit(0)).count() == 0
    with pytest.raises(ValueError):
        boosting.fit(df, 3, 2, edges=EDGES, bins=8)


def test_rows_of_the_same_bins_are_one_row(spark, monkeypatch):
    rows = [([float(i % 5), float(i % 3), float(i % 7)], i % 2) for i in range(210)]
    df = spark.createDataFrame(rows, "features array<double>, label int")
    stored, written = [], boosting.Written.of

    def of(d, name):
        out = written(d, name)
        stored.append(out.frame.count())
        return out
    monkeypatch.setattr(boosting.Written, "of", staticmethod(of))
    boosting.fit(df, 3, 2, rounds=1, depth=2, edges=EDGES)
    few = len({(*boosting.codes_of(np.array([x]), [np.array(e) for e in EDGES])[0].tolist(), y) for x, y in rows})
    assert stored == [few] and few < 210
    one = boosting.fit(df, 3, 2, rounds=3, depth=2, edges=EDGES, rewrite=1)
    wide = boosting.fit(df.crossJoin(spark.range(300)), 3, 2, rounds=3, depth=2, edges=EDGES, ridge=300.0, rewrite=2)
    assert set(stored) == {few}
    for a, c in zip(sum(one.rounds, []), sum(wide.rounds, [])):
        assert np.array_equal(a.feature, c.feature) and np.array_equal(a.cut, c.cut) and np.allclose(a.value, c.value)


def test_sums_beyond_a_double_stay_exact():
    key, values = np.array([0, 1, 0]), np.array([1 << 60, 3, 1])
    assert boosting._added(key, values, 2, False).tolist() == [(1 << 60) + 1, 3]
    assert boosting._added(key, np.array([5, 3, 1]), 2, True).tolist() == [6, 3]


def test_one_task_grows_the_trees_of_many(spark, points):
    df, x, _ = points
    odd = df.unionByName(spark.createDataFrame([(900, [None, float("nan"), 1.0], 2)], df.schema)).withColumn("label", F.when(F.col("id") % 17 != 3, F.col("label")))
    for d, options in ((df, {"depth": 3, "edges": EDGES, "bins": 8}), (odd, {"depth": 6, "bins": 16}), (df.limit(1), {"depth": 2})):
        one = boosting.fit(d, 3, 4, rounds=7, rewrite=3, **options)
        many = boosting.fit(d, 3, 4, rounds=7, rewrite=3, one_task=0, **options)
        assert one.losses == many.losses and len(one.rounds) == 7
        for a, b in zip(sum(one.rounds, []), sum(many.rounds, [])):
            assert (a.feature == b.feature).all() and (a.cut == b.cut).all() and (a.value == b.value).all()
    early = [boosting.fit(df, 3, 4, rounds=9, depth=2, tolerance=0.06, one_task=n) for n in (0, boosting.ONE_TASK)]
    assert early[0].losses == early[1].losses and 1 < len(early[0].rounds) < 9


def test_events_get_all_rounds(spark, tmp_path, monkeypatch):
    from sparkstats.plans import QUERIES
    from sparkstats.plans.base import EVENT_TYPES
    types = "element_at(array({}), cast(1 + pmod(xxhash64(id), 5) as int))".format(", ".join(f"'{t}'" for t in EVENT_TYPES))
    spark.range(600).selectExpr("id as event_id", "timestamp_seconds(id * 5000) as ts", "id % 37 as user_id", f"{types} as event_type",
                                "pmod(hash(id), 1000) / 10.0D as value").write.parquet(f"{tmp_path}/events.parquet")
    models, fit = [], boosting.fit
    monkeypatch.setattr(boosting, "fit", lambda *a, **k: models.append(fit(*a, **k)) or models[-1])
    assert QUERIES["gbt_multiclass"](spark, str(tmp_path)).count() > 200
    (model,) = models
    assert (len(model.rounds), model.depth, model.step) == (500, 6, 0.1) and model.losses[-1] < model.losses[19] < model.losses[0]
