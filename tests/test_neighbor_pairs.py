"""The search without cells pairs packed blocks; no row is shuffled for each block of the other side."""

import numpy as np
import pyarrow as pa
import pytest

from sparkstats.operators import neighbors


def test_all_pairs_of_blocks(spark):
    r = np.random.default_rng(3)
    x = np.round(r.normal(size=(130, 9)), 1)
    x[::4] = x[1]  # copies
    rows = [(i, [float(v) for v in x[i]], int(i % 3)) for i in range(130)]
    df = spark.createDataFrame(rows, "id long, features array<double>, label int")
    out = neighbors.knn_join(df.where("id < 40"), df.where("id >= 40"), 4, neighbors.Dense(1), ["label"], block_rows=16)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "CartesianProduct" in plan
    want = []
    for i in range(40):
        d = np.round(np.abs(x[40:] - x[i]).sum(1), 9)
        want += [(i, n, int(j) + 40, float(d[j]), (int(j) + 40) % 3) for n, j in enumerate(np.argsort(d, kind="stable")[:4], 1)]
    assert sorted(tuple(row) for row in out.collect()) == want
    none = neighbors.knn_join(df.where("id < 0"), df, 2)
    assert none.count() == 0


@pytest.mark.parametrize("p", [1, 2, 3])
def test_few_pairs_of_long_rows_get_a_plain_distance(spark, p, monkeypatch):
    r = np.random.default_rng(p)
    x = r.normal(size=(1500, 33))
    x[::50] = x[7] + np.round(r.normal(size=(30, 33)), 1)
    x[3::40] = x[11]  # copies and ties
    x[5], x[9] = 1e6, -3e4
    left, right, dense = x[:400], x[400:], neighbors.Dense(p)
    d = np.round((np.abs(left[:, None] - right[None]) ** p).sum(2) ** (1 / p), 9)
    best, seen, computed = np.full((400, 4), np.inf), [], 0
    for s in range(0, 1100, 275):
        i, j, near, best = dense.screen(left, right[s:s + 275]).nearest(4, best)
        computed += len(i)
        seen += zip(i.tolist(), (j + s).tolist(), near.tolist())
    assert np.allclose(best, np.sort(d, axis=1)[:, :4], atol=2e-9)
    assert {(i, int(j)) for i in range(400) for j in np.argsort(d[i], kind="stable")[:4]} <= {(i, j) for i, j, _ in seen} and computed < d.size / 5

    def refused(*_):
        raise AssertionError("all pairs were compared")
    monkeypatch.setattr(neighbors, "_nearest", refused)
    asked = neighbors._Asked(pa.table({"id": np.arange(400), "features": x[:400].tolist()}), dense, 4, ["label"])
    for s in range(400, 1500, 300):
        n = np.arange(s, min(s + 300, 1500))
        asked.meet(pa.table({"id": n, "features": x[n].tolist(), "label": n % 7}))
    got = [tuple(row) for row in asked.found().itertuples(index=False)]
    want = [(i, int(j) + 400, d[i, j], (int(j) + 400) % 7) for i in range(400) for j in np.argsort(d[i], kind="stable")[:4]]
    assert [(q, t, c) for q, t, _, c in got] == [(q, t, c) for q, t, _, c in want]
    assert np.allclose([g[2] for g in got], [w[2] for w in want], atol=2e-9)


def test_rows_that_are_not_screened():
    a = np.ones((3, 20))
    assert neighbors.Dense(1).screen(a, a * np.nan) is None and neighbors.Dense(2).screen(a, a * 1e30) is None
    assert neighbors.Dense(3).screen(a[:, :8], a[:, :8]) is None and neighbors.Dense(2).screen(a[:0], a) is None


def test_one_block_needs_no_pairs(spark):
    r = np.random.default_rng(4)
    x = np.round(r.normal(size=(130, 5)), 1)
    df = spark.createDataFrame([(i, [float(v) for v in x[i]]) for i in range(130)], "id long, features array<double>")
    out = neighbors.knn_join(df.where("id >= 20"), df.where("id < 20"), 3, neighbors.Dense(1), block_rows=20)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    want = []
    for i in range(20, 130):
        d = np.round(np.abs(x[:20] - x[i]).sum(1), 9)
        want += [(i, n, int(j), float(d[j])) for n, j in enumerate(np.argsort(d, kind="stable")[:3], 1)]
    assert sorted(tuple(row) for row in out.collect()) == want
