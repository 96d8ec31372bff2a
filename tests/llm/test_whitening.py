"""Whitening against numpy on the whole matrix."""

import math
import random

import numpy as np
import pytest
from corpus_rows import rows_of

from sparkstats.llm import whitening

FIELDS = "vec_id long, embedding array<float>, label int, x string, id long, component int"


def brute(rows, components=4):
    kept = [(i, [math.floor(256 * np.float64(np.float32(c))) + 0 for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    d = max((len(x) for _, x in kept), default=0)
    kept = [(i, tuple(x + [0] * (d - len(x)))) for i, x in kept]
    distinct = sorted({x for _, x in kept})
    n, s = len(distinct), [sum(c) for c in zip(*distinct)]
    c = np.array([[n * a - b for a, b in zip(x, s)] for x in distinct], float) / n
    v = c.T @ c / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1], q[:, ::-1]
    out = []
    for i, x in kept:
        off = [n * a - b for a, b in zip(x, s)]
        for k in range(min(components, d)):
            out.append((i, k + 1, n, sum(o * o for o in off), np.array(off, float) / n @ q[:, k] / np.sqrt(e[k]), e[k] / e.sum()))
    return out


def compare(got, want, tol=1e-9):
    key = lambda r: (r[0] is None, r[0] or 0, r[1], abs(r[4]))
    rows = [(r["id"], r["component"], r["n"], r["deviation"], r["whitened"], r["explained"]) for r in got]
    rows, want = sorted(rows, key=key), sorted(want, key=key)
    assert [r[:4] for r in rows] == [r[:4] for r in want]
    a, b = np.array([r[4:] for r in rows]), np.array([r[4:] for r in want])
    assert np.allclose(np.abs(a), np.abs(b), atol=tol) and np.allclose(a[:, 1], b[:, 1], rtol=1e-10)
    for k in range(1, 5):  # one sign for all rows
        of = [i for i, r in enumerate(rows) if r[1] == k and abs(r[4]) > 1e-6]
        assert len({np.sign(rows[i][4] * want[i][4]) for i in of}) <= 1


def random_rows(seed, n, d):
    r = np.random.default_rng(seed)
    mix = r.normal(size=(d, d)) * np.logspace(0, -2, d)
    return [(int(i), [float(np.float32(c)) for c in v]) for i, v in enumerate(r.normal(size=(n, d)) @ mix)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2, 3) for i, v in rows], FIELDS)


@pytest.mark.parametrize("d, n, parts", [(8, 400, 5), (24, 150, 3), (4, 50, 1)])
def test_against_numpy(spark, d, n, parts):
    rows = random_rows(d, n, d)
    rows += [(1000 + i, rows[7][1]) for i in range(n // 2)] + [(7, rows[7][1]), (None, rows[3][1])]
    rows += [(2000, None), (2001, [None] * d), (2002, [float("nan")] * d), (2003, [float("-inf")] + [0.0] * (d - 1))]
    got = rows_of(whitening.whitened(frame(spark, rows).repartition(parts)))
    compare(got, brute(rows))
    assert {r["identity_error"] for r in got} == {got[0]["identity_error"]} and got[0]["identity_error"] < 1e-12


def test_short_vectors_are_filled_up(spark):
    rows = random_rows(5, 60, 5) + [(100, [1.0, 2.0]), (101, []), (102, [0.5])]
    compare(rows_of(whitening.whitened(frame(spark, rows))), brute(rows))


def test_without_variance(spark):
    empty = whitening.whitened(frame(spark, []))
    assert empty.count() == 0 and empty.columns == ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert whitening.whitened(frame(spark, [(1, None), (2, [])])).count() == 0
    same = rows_of(whitening.whitened(frame(spark, [(1, [1.0, 2.0, 3.0])] * 3)))
    assert len(same) == 9 and all(r["whitened"] is None and r["explained"] is None and r["identity_error"] is None and r["deviation"] == 0 and r["n"] == 1 for r in same)
    line = rows_of(whitening.whitened(frame(spark, [(i, [float(i), 2.0 * i, 0.0]) for i in range(10)])))
    assert all((r["whitened"] is None) == (r["component"] > 1) for r in line) and line[0]["identity_error"] < 1e-12


def test_large_entries(spark):
    rows = [(1, [1e30, 1.0]), (2, [-1e12, 2.0]), (3, [1e12, 3.0]), (4, [5.0, 1e9])]
    got = rows_of(whitening.whitened(frame(spark, rows)))
    assert len(got) == 8 and all(r["deviation"] is None for r in got if r["id"] == 1)
    some = rows_of(whitening.whitened(frame(spark, [(1, [1e5, 1.0]), (2, [-2e5, 2.0]), (3, [3e5, 3.0])])))
    assert {r["id"]: r["deviation"] for r in some} == {b[0]: b[3] for b in brute([(1, [1e5, 1.0]), (2, [-2e5, 2.0]), (3, [3e5, 3.0])], 2)}


def test_rank_one_updates():
    rng = np.random.default_rng(2)
    for d, spread in ((1, 0), (2, 0), (6, 3), (30, 8), (64, 2)):
        values, basis = np.zeros(d), np.eye(d)
        want = np.zeros((d, d))
        for step in range(120):
            v = rng.normal(size=d) * 10.0 ** -rng.integers(0, spread + 1)
            if step % 7 == 0:
                v[rng.random(d) < 0.8] = 0.0
            if step % 11 == 0 and step:
                v = basis[:, rng.integers(d)] * 3.0
            rho = float(rng.random())
            values, basis = whitening.rank_one(values, basis, rho, v)
            want += rho * np.outer(v, v)
        assert (np.diff(values) >= 0).all()
        assert np.abs(basis.T @ basis - np.eye(d)).max() < 1e-12
        assert np.abs(basis * values @ basis.T - want).max() < 1e-12 * np.abs(want).max()


def test_secular_roots():
    rng = np.random.default_rng(4)
    for k in (1, 2, 5, 40):
        d = np.sort(rng.normal(size=k)) * 10
        d[k // 2:] += 1e-9
        z = rng.normal(size=k) * 10.0 ** -rng.integers(0, 6, k)
        z /= np.sqrt(z @ z)
        origin, s = whitening.secular_roots(d, z, 2.5)
        assert np.allclose(d[origin] + s, np.linalg.eigvalsh(np.diag(d) + 2.5 * np.outer(z, z)), atol=1e-13 * 50)


def test_merge_is_as_one():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(90, 7)) @ rng.normal(size=(7, 7)) + 5
    one, parts = whitening.Spectrum(7), [whitening.Spectrum(7) for _ in range(4)]
    for i, row in enumerate(x):
        one.add(row)
        parts[min(3, i // 40)].add(row)  # the last but one has ten, the last none
    for p in parts[1:]:
        parts[0].merge(p)
    c = x - x.mean(axis=0)
    for s in (one, parts[0]):
        assert s.n == 90 and np.allclose(s.mean, x.mean(axis=0)) and np.allclose(s.basis * s.values @ s.basis.T, c.T @ c)


def test_query(spark, tmp_path):
    from sparkstats.llm.queries import QUERIES
    rows = random_rows(11, 80, 6)
    frame(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = QUERIES["op12_whitening"](spark, str(tmp_path))
    assert dict(got.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
    compare(rows_of(got.withColumnRenamed("vec_id", "id")), brute(rows))
