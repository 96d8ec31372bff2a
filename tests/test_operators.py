"""Hand-made cases, brute-force checks and invariants."""

import math
import os
import tempfile

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from sparkstats.functions import rng, scalars, text as tx, vectors
from sparkstats.operators import (bayes, cluster, documents as dc, ensembles, features as ft, gradient, gram, kernels, linear,
                                  metrics, neighbors, project, resampling, sampling)
from sparkstats.sources import models, tables


def collect(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


# ---- random numbers, splits, ranks ------------------------------------------------

def test_uniform_matches_driver_value(spark):
    row = spark.range(5).select(rng.uniform(3, "t", "id").alias("u")).collect()
    assert [r["u"] for r in row] == [rng.uniform_value(3, "t", i) for i in range(5)]


@pytest.mark.parametrize("size,expected", [(0.3, 300), (0.1234, 124), (17, 17), (0, 0), (1000, 1000), (5000, 1000)])
def test_split_exact_sizes(spark, size, expected):
    df = sampling.split_exact(spark.range(1000), "id", size)
    assert df.where("is_test").count() == expected and df.count() == 1000


def test_split_exact_one_row(spark):
    assert sampling.split_exact(spark.range(1), "id", 0.5).where("is_test").count() == 1


def test_split_refines_ranges(spark, monkeypatch):
    monkeypatch.setattr(sampling, "SELECT_ROWS", 1)
    h = {r["id"]: r["h"] for r in spark.range(3000).select("id", rng.hash32(42, "split", "id").alias("h")).collect()}
    want = set(sorted(h, key=lambda i: (h[i], i))[:1111])
    got = {r["id"] for r in sampling.split_exact(spark.range(3000), "id", 1111).where("is_test").collect()}
    assert got == want


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_layout_does_not_matter(spark, parts):
    df = spark.range(500).repartition(parts)
    ranks = dict(collect(sampling.hash_rank(df, "id", 1, "x"), "id", "rank"))
    h = {i: (int(rng.uniform_value(1, "x", i) * rng.TWO32), i) for i in range(500)}
    assert [ranks[i] for i in sorted(h, key=h.get)] == list(range(500))
    m = gram.moments(df.withColumn("v", rng.uniform(2, "v", "id")), {"v": F.col("v"), "id": F.col("id")}, center=True)
    x = np.array([[rng.uniform_value(2, "v", i), i] for i in range(500)])
    assert np.allclose(m.covariance(), np.cov(x.T, bias=True))


def test_minibatch_short_last(spark):
    sizes = [r["count"] for r in sampling.minibatches(spark.range(103), "id", 10).groupBy("batch").count().orderBy("batch").collect()]
    assert sizes == [10] * 10 + [3]


def test_folds_are_even(spark):
    df = spark.range(100).withColumn("label", F.when(F.col("id") < 33, 0).otherwise(1))
    n = sampling.stratified_folds(df, "id", "label", 4).groupBy("label", "fold").count().collect()
    for label, total in ((0, 33), (1, 67)):
        c = [r["count"] for r in n if r["label"] == label]
        assert sum(c) == total and max(c) - min(c) <= 1


def test_quantiles_with_heavy_copies(spark):
    x = np.concatenate([np.full(400, 2.5), np.random.default_rng(0).normal(size=600).round(2)])
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    p = [0, 0.01, 0.3, 0.5, 0.777, 0.99, 1]
    for buckets in (4, 1024):
        assert np.allclose(sampling.exact_quantiles(df, "v", p, buckets=buckets), np.quantile(x, p))


def test_sorted_runs(spark):
    words = ["b", "a", "é", "Z", "a", "zz", "b", "a"]
    out = collect(sampling.sorted_runs(spark.createDataFrame([(w,) for w in words], "w string"), "w", buckets=2), "run_no", "value", "weight", "first_rank")
    want, at = [], 0
    for n, w in enumerate(sorted(set(words))):
        want.append((n, w, words.count(w), at))
        at += words.count(w)
    assert out == want


def test_bootstrap(spark):
    df = spark.range(400)
    n = [r["n"] for r in sampling.bootstrap_weights(df, "id", 10).groupBy("sample").agg(F.sum("times").alias("n")).collect()]
    assert len(n) == 10 and all(abs(v - 400) < 120 for v in n)
    exact = [r["n"] for r in sampling.bootstrap_exact(df, "id", 5).groupBy("sample").agg(F.sum("times").alias("n")).collect()]
    assert exact == [400] * 5


# ---- sources ------------------------------------------------------------------

def _file(content: bytes) -> str:
    path = os.path.join(tempfile.mkdtemp(prefix="run-"), "data.txt")
    with open(path, "wb") as f:
        f.write(content)
    return path


def test_lines_bom_and_trailing_newline(spark):
    df = spark.createDataFrame([(1, "﻿a\n\nb\n"), (2, "")], "doc_id int, text string")
    lines = tables.lines_of(df, "doc_id", "text")
    assert collect(lines, "doc_id", "line_no", "line") == [(1, 0, "a"), (1, 1, ""), (1, 2, "b"), (1, 3, ""), (2, 0, "")]
    assert collect(tables.join_lines(lines, "doc_id", "line_no", "line"), "doc_id", "text") == [(1, "a\n\nb\n"), (2, "")]
    assert [r["line"] for r in tables.read_lines(spark, _file("﻿á\nb\n".encode())).collect()] == ["á", "b"]


def test_tsv(spark):
    path = _file('1\tsay "hi"\n0\tno, thanks\n'.encode())
    assert collect(tables.read_labelled_tsv(spark, path), "label", "text") == [(0, "no, thanks"), (1, 'say "hi"')]
    for bad in (b"1\ta\tb\n", b"1 a\n", b"x\ta\n"):
        with pytest.raises(PySparkException):
            tables.read_labelled_tsv(spark, _file(bad)).collect()


def test_feature_scan_classes(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [3.0, 4.0], 5)], "k long, v array<float>, y int")
    assert collect(tables.read_features(df, "k", "v", "y", classes=3), "id", "features", "label") == [(1, [1.0, 2.0], 0)]


# ---- scalars --------------------------------------------------------------------

def test_log_loss_is_finite(spark):
    row = spark.range(1).select(scalars.log_loss_binary(F.lit(0.0), F.lit(1.0)).alias("a"),
                                scalars.log_loss_binary(F.lit(1.0), F.lit(1.0)).alias("b")).first()
    assert row["a"] == pytest.approx(-math.log(1e-15)) and row["b"] == pytest.approx(0, abs=1e-12)


def test_f_beta_and_pearson_nulls(spark):
    assert spark.range(1).select(scalars.f_beta(F.lit(0), F.lit(0), F.lit(0), F.lit(1.0))).first()[0] is None
    df = spark.range(5).withColumn("c", F.lit(0.1)).withColumn("y", F.col("id") * 2.0)
    row = df.agg(resampling.pearson("c", "y"), resampling.pearson("id", "y")).first()
    assert row[0] is None and row[1] == pytest.approx(1.0)


def test_unknown_label_fails(spark):
    df = spark.createDataFrame([("a",), ("q",)], "s string")
    with pytest.raises(PySparkException):
        df.select(scalars.label_index("s", ["a", "b"])).collect()


def test_accuracy_prob_half_counts(spark):
    df = spark.createDataFrame([(0.5, 0.0), (0.5, 1.0), (0.0, 1.0), (1.0, 1.0)], "p double, t double")
    assert df.agg(metrics.accuracy_prob("p", "t")).first()[0] == 0.75


def test_macro_f1_counts_predicted_only_class(spark):
    df = spark.createDataFrame([("a", "a"), ("b", "a"), ("c", "c")], "p string, t string")
    # a: 2/3, b: 0 (never true), c: 1
    assert metrics.macro_f1(df, "p", "t").first()[0] == pytest.approx((2 / 3 + 0 + 1) / 3)


def test_grids():
    assert scalars.linspace(0, 2, 201)[50] == pytest.approx(0.5)
    assert np.allclose(scalars.geomspace(0.01, 10, 500), np.geomspace(0.01, 10, 500))


def test_softmax_and_best_by(spark):
    df = spark.createDataFrame([(1, [1000.0, 1000.0]), (2, [0.0, math.log(3)])], "id int, z array<double>")
    got = [r[0] for r in df.orderBy("id").select(vectors.softmax("z")).collect()]
    assert np.allclose(got, [[0.5, 0.5], [0.25, 0.75]])
    t = spark.createDataFrame([("x", 3, 1.0), ("x", 1, 1.0), ("x", 2, 5.0)], "g string, k int, v double")
    assert metrics.best_by(t, "k", "v", ["g"]).first()["k"] == 1
    assert metrics.best_by(t, "k", "v", lowest=False).first()["k"] == 2


# ---- text -----------------------------------------------------------------------

def test_tokens_and_ngrams(spark):
    df = spark.createDataFrame([("Café naïve_1, x ÉTÉ",)], "t string")
    row = df.select(tx.tokens("t"), tx.long_tokens(F.lower("t")), tx.word_ngrams(tx.tokens("t"), 3), tx.word_ngrams(tx.tokens("t"), 5),
                    tx.char_ngrams(F.lit("ab"), 2), tx.char_ngrams(F.lit("a"), 5), tx.char_ngrams(F.lit("abc"), 5),
                    tx.words(F.lit(" a b   c\n")), tx.words(F.lit(""))).first()
    assert row[0] == ["Café", "naïve_1", "x", "ÉTÉ"]
    assert row[1] == ["café", "naïve_1", "été"]
    assert row[2] == ["Café naïve_1 x", "naïve_1 x ÉTÉ"] and row[3] == []
    assert row[4] == [" a", "ab", "b "] and row[5] == [] and row[6] == [" abc "]
    assert row[7] == ["a", "b", "c"] and row[8] == []


def test_strip_default_letters(spark):
    assert spark.range(1).select(tx.strip_diacritics(F.lit("Příliš ŽLUŤOUČKÝ"))).first()[0] == "Prilis ZLUTOUCKY"


def test_tfidf_edges(spark):
    train = spark.createDataFrame([(1, "aa aa bb common"), (2, "bb cc common common"), (3, "x ! y")], "doc_id long, text string")
    test = spark.createDataFrame([(9, "aa zz common aa aa"), (10, "nothing here")], "doc_id long, text string")
    vocab = collect(dc.vocabulary(train, "text"), "term", "cnt")
    assert vocab == [("aa", 2), ("bb", 2), ("common", 3)]
    _, out = dc.fit_transform(train, test, "doc_id", "text", True, True)
    got = {(r["doc_id"], r["term"]): r["weight"] for r in out.collect()}
    a, c = 3 / 2 * math.log(3 / 2), 1 / 2 * math.log(3 / 3)
    assert got == {(9, "aa"): pytest.approx(a / math.hypot(a, c)), (9, "common"): pytest.approx(0.0)}


def test_text_neighbours_match_brute_force(spark):
    g = np.random.default_rng(3)
    words = [f"w{i:02d}" for i in range(40)]
    docs = [" ".join(g.choice(words[(i % 3) * 10:(i % 3) * 10 + 20], size=12)) for i in range(90)]
    docs[20:50] = [docs[4]] * 30
    docs[60] = "?"
    df = spark.createDataFrame([(i, t, f"c{i % 3}") for i, t in enumerate(docs)], "doc_id long, text string, lang string")
    train, test = df.where("doc_id % 2 = 0"), df.where("doc_id % 2 = 1")
    a, b = dc.fit_transform(train, test, "doc_id", "text", True, True)
    terms = {w: i for i, w in enumerate(words)}
    x = np.zeros((90, 40))
    for r in a.unionByName(b).collect():
        x[r["doc_id"], terms[r["term"]]] = r["weight"]
    for pivots in (1, 6):
        got = collect(dc.knn(train, test, "doc_id", "text", "lang", k=2, pivots=pivots, block_rows=8), "query_id", "rank", "train_id")
        want = []
        for q in range(1, 90, 2):
            d = sorted((round(float(np.sqrt(max(round((x[q] @ x[q]) + (x[t] @ x[t]) - 2 * x[q] @ x[t], 12), 0))), 9), t) for t in range(0, 90, 2))
            want += [(q, n + 1, d[n][1]) for n in range(2)]
        assert got == sorted(want)


def test_restore(spark):
    train = spark.createDataFrame([("káva je káva kava",), ("být byt byt být",)], "line string")
    strip = lambda c: tx.strip_diacritics(c)
    forms = dc.variants(train, "line", strip)
    assert collect(forms, "plain", "word") == [("kava", "káva")]  # byt / být tie: the first in order stays plain
    lines = spark.createDataFrame([(1, 0, "kava  nova"), (1, 1, "")], "doc_id int, line_no int, t string")
    assert collect(dc.restore(lines, forms, ["doc_id", "line_no"], "t"), "line_no", "restored") == [(0, "káva nova"), (1, "")]


def test_word_accuracy_needs_equal_counts(spark):
    df = spark.createDataFrame([("a b", "a c"), ("x", "x")], "g string, s string")
    row = metrics.word_accuracy(df, "g", "s").first()
    assert (row["hits"], row["words"]) == (2, 3)
    with pytest.raises(PySparkException):
        metrics.word_accuracy(spark.createDataFrame([("a b", "a")], "g string, s string"), "g", "s").collect()


# ---- features ---------------------------------------------------------------------

@pytest.fixture(scope="module")
def mixed(spark):
    rows = [(i, i % 4, float(i) / 3, 7.0, "abc"[i % 3]) for i in range(40)]
    return spark.createDataFrame(rows, "id long, cat int, num double, const double, s string")


def test_infer_categorical(mixed):
    assert ft.infer_categorical(mixed, ["cat", "num", "const"]) == ["cat", "const"]


def test_column_transform(mixed):
    model = ft.ColumnTransform([("one_hot", ["cat", "s"]), ("standard", ["num", "const"]), ("min_max", ["num", "const"])]).fit(mixed.where("cat < 3"))
    out = {r["id"]: r["features"] for r in model.transform(mixed).collect()}
    kept = np.array([i / 3 for i in range(40) if i % 4 < 3])
    z = (5 / 3 - kept.mean()) / kept.std()
    assert np.allclose(out[5], [0, 1, 0, 0, 0, 1, z, 0, (5 / 3 - kept.min()) / (kept.max() - kept.min()), 0])
    assert out[3][:3] == [0, 0, 0]  # a category not seen in training


def test_quantile_values_flat_runs():
    marks = np.array([0.0, 1.0, 1.0, 1.0, 3.0])
    got = ft.quantile_values(np.array([-1.0, 0.0, 0.5, 1.0, 2.0, 3.0, 9.0]), marks)
    assert np.allclose(got, [0, 0, 0.125, 0.5, 0.875, 1, 1])


def test_monomial_order():
    x = np.array([[2.0, 3.0, 5.0]])
    assert ft.poly_values(x, 2, True).tolist() == [[1, 2, 3, 5, 4, 6, 10, 9, 15, 25]]


def test_pipeline_roundtrip(spark, mixed):
    df = mixed.withColumn("label", (F.col("num") > 5).cast("double"))
    pipe = Pipeline(stages=[ft.ColumnTransform([("one_hot", ["s"]), ("quantile", ["num"])], landmarks=5), ft.ScaleArray("features", "scaled", "min_max"),
                            ft.PcaProject("scaled", "projected", 2), ft.PolyExpand("projected", "poly", 2), ft.FourierFeatures("poly", "wide", 8),
                            ft.ToVector("wide", "vector"), ensembles.logistic(10.0, 40)])
    model = pipe.fit(df)
    path = models.new_path(spark, "pipe")
    models.save_pipeline(model, path)
    loaded = models.load_pipeline(path)
    assert isinstance(loaded, PipelineModel)
    assert collect(models.score(model, df), "id", "prediction") == collect(models.score(loaded, df), "id", "prediction")


# ---- least squares -----------------------------------------------------------------

@pytest.fixture(scope="module")
def regression(spark):
    g = np.random.default_rng(1)
    x = g.normal(size=(150, 3)) + 100
    y = x @ [1.0, -2.0, 0.5] + 4 + 0.1 * g.normal(size=150)
    rows = [(i, *map(float, x[i]), float(y[i])) for i in range(150)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, t double")
    cols = {n: F.col(n) for n in "abct"}
    return df, cols, x, y


def test_fits_match_numpy(regression):
    df, cols, x, y = regression
    m = linear.moments(df, cols, center=True)
    w = np.linalg.lstsq(np.column_stack([x, np.ones(150)]), y, rcond=None)[0]
    for model in (linear.fit_ols(m), linear.fit_normal(m), linear.fit_ridge(m, 0.0)):
        assert np.allclose([*model.weights, model.intercept], w, rtol=1e-6, atol=1e-4)
    xc, yc = x - x.mean(0), y - y.mean()
    ridge = np.linalg.solve(xc.T @ xc + 5 * np.eye(3), xc.T @ yc)
    fitted = linear.fit_ridge(m, 5.0)
    assert np.allclose(fitted.weights, ridge)
    assert fitted.rmse(m) == pytest.approx(np.sqrt(np.mean((x @ ridge + fitted.intercept - y) ** 2)))


def test_collinear_columns(regression):
    df, cols, x, y = regression
    m = linear.moments(df, {"a": F.col("a"), "a2": F.col("a"), "t": F.col("t")}, center=True)
    w = linear.fit_ols(m).weights
    assert w[0] == pytest.approx(w[1])


def test_vector_moments_equal_native(regression):
    df, cols, x, y = regression
    v = gram.vector_moments(df.withColumn("features", F.array("a", "b", "c")), 3, target="t", center=True)
    assert np.allclose(v.covariance(), gram.moments(df, cols, center=True).covariance())


def test_constant_column_has_no_correlation(regression):
    df, cols, *_ = regression
    c = gram.moments(df, {"a": F.col("a"), "k": F.lit(0.1)}, center=True).correlation()
    assert c[0, 0] == pytest.approx(1) and np.isnan(c[0, 1]) and np.isnan(c[1, 1])


def test_fold_grid(regression):
    df, cols, x, y = regression
    parts = linear.moments(df.withColumn("f", (F.col("id") % 3).cast("int")), cols, by="f", center=True)
    rows = linear.fold_grid(parts, [1.0])
    fold = np.arange(150) % 3
    for _, f, r in rows:
        xt, yt = x[fold != f], y[fold != f]
        xc, yc = xt - xt.mean(0), yt - yt.mean()
        w = np.linalg.solve(xc.T @ xc + np.eye(3), xc.T @ yc)
        e = (x[fold == f] - xt.mean(0)) @ w + yt.mean() - y[fold == f]
        assert r == pytest.approx(np.sqrt(np.mean(e ** 2)))


# ---- iterative fits ------------------------------------------------------------------

def test_linear_descent_reaches_the_closed_form(spark):
    df = spark.range(300).select("id", F.array(rng.uniform(1, "a", "id"), rng.uniform(1, "b", "id")).alias("features"))
    df = df.withColumn("label", F.expr("3 * features[0] - 2 * features[1] + 1")).withColumn("is_test", F.col("id") % 3 == 0)
    w, curve = gradient.fit(df, "linear", 2, 2000, 0.5)
    assert np.allclose(w[:, 0], [3, -2, 1], atol=1e-4) and curve[-1][2] < 1e-4


def test_local_descent_with_one_shard_is_the_plain_schedule(spark):
    rows = [(i, [rng.uniform_value(1, "a", i)], i % 2) for i in range(23)]
    df = spark.createDataFrame(rows, "id long, features array<double>, label int").repartition(5)
    w = gradient.fit_local(df, "logistic", 1, 3, 0.3, 5, shards=1, weights=np.zeros((2, 1)))
    want = np.zeros(2)
    for e in range(3):
        order = sorted(range(23), key=lambda i: (rng.uniform_value(42, f"epoch{e}", i), i))
        for s in range(0, 23, 5):
            x = np.array([[*rows[i][1], 1.0] for i in order[s:s + 5]])
            t = np.array([rows[i][2] for i in order[s:s + 5]])
            want = want - 0.3 * x.T @ (1 / (1 + np.exp(-x @ want)) - t) / len(x)
    assert np.allclose(w[:, 0], want)


@pytest.mark.parametrize("mode", ["first", "batch"])
def test_perceptron_stops(spark, mode):
    df = spark.createDataFrame([(1, 2.0, 1.0), (2, 3.0, 1.0), (3, -2.0, -1.0), (4, -1.0, -1.0)], "id long, x double, t double")
    w, _, done = gradient.perceptron(df, ["x"], "t", 50, mode=mode)
    assert done and gradient.misclassified(df, ["x"], "t", w).count() == 0
    clash = df.unionByName(spark.createDataFrame([(9, 2.0, -1.0)], df.schema))
    assert gradient.perceptron(clash, ["x"], "t", 4, mode=mode)[1:] == (4, False)


def test_kmeans_edges(spark):
    df = spark.createDataFrame([(1, [0.0]), (2, [1.0]), (3, [2.0]), (4, [9.0])], "id long, features array<double>")
    # Row 2 is as far from 0 as from 2: the lower index takes it. Centre 50 is empty and stays.
    out, centers, inertia = cluster.kmeans(df, np.array([[0.0], [2.0], [50.0]]), 1)
    assert collect(out, "id", "cluster") == [(1, 0), (2, 0), (3, 1), (4, 1)]
    assert centers.tolist() == [[0.5], [5.5], [50.0]]
    _, _, curve = cluster.kmeans(df, np.array([[0.0], [1.0]]), 6)
    assert all(b <= a + 1e-12 for a, b in zip(curve, curve[1:]))
    ids, points = cluster.plus_plus_init(df, 4)
    assert sorted(ids) == [1, 2, 3, 4]
    assert cluster.kmeans(df, points, 2)[2][-1] == 0
    assert cluster.kmeans(df, np.array([[5.0]]), 3, cache=False)[1].tolist() == [[3.0]]
    with pytest.raises(ValueError):
        cluster.plus_plus_init(df.withColumn("features", F.array(F.lit(1.0))), 2)


def test_pca(spark, points):
    df, x, _ = points
    v = project.spectral_components(np.cov(x.T, bias=True), 2)
    assert np.allclose(v.T @ v, np.eye(2), atol=1e-3)
    p = project.fit(df, 3, 1)
    assert abs(p[:, 0] @ v[:, 0]) == pytest.approx(1, abs=1e-3)
    got = project.transform(df, p).where("id = 3").first()["projected"][0]
    assert got == pytest.approx(float(x[3] @ p[:, 0]))  # not centred


def test_bayes_matches_numpy(spark, points):
    df, x, y = points
    y = np.array(y)
    s = bayes.class_sums(df, 3, threshold=4.0)
    for k, c in enumerate(s.classes):
        rows = x[y == c]
        assert np.allclose(s.means[k], rows.mean(0)) and np.allclose(s.variances(0.1)[k], rows.var(0) + 0.1)
        assert np.allclose(s.bernoulli(0.1)[k], ((rows >= 4).sum(0) + 0.1) / (len(rows) + 0.2))


# ---- neighbours ----------------------------------------------------------------------

@pytest.mark.parametrize("p", [1, 2, 3])
@pytest.mark.parametrize("pivots,block", [(1, 1000), (9, 7)])
def test_knn_matches_brute_force(points, p, pivots, block):
    df, x, _ = points
    train, test = df.where("id % 4 <> 0"), df.where("id % 4 = 0")
    got = collect(neighbors.knn_join(test, train, 5, neighbors.Dense(p), ["label"], pivots=pivots, block_rows=block), "query_id", "rank", "train_id")
    want = []
    for q in range(0, 200, 4):
        d = sorted((round(float((np.abs(x[q] - x[t]) ** p).sum() ** (1 / p)), 9), t) for t in range(200) if t % 4)
        want += [(q, n + 1, d[n][1]) for n in range(5)]
    assert got == sorted(want)


def test_knn_with_fewer_rows_than_k(spark):
    df = spark.createDataFrame([(1, [0.0]), (2, [1.0]), (3, [5.0])], "id long, features array<double>")
    out = neighbors.knn_join(df.where("id = 1"), df.where("id > 1"), 4, pivots=2)
    assert collect(out, "rank", "train_id") == [(1, 2), (2, 3)]


def test_votes(spark):
    rows = [(1, 0.0, 2), (1, 0.0, 1), (1, 0.1, 0), (2, 1.0, 5), (2, 1.0, 3), (3, 0.1, 7), (3, 1.0, 4), (3, 1.0, 4)]
    n = spark.createDataFrame(rows, "query_id int, distance double, label int")
    assert collect(neighbors.vote(n, "uniform"), "query_id", "prediction") == [(1, 0), (2, 3), (3, 4)]
    assert collect(neighbors.vote(n, "inverse"), "query_id", "prediction") == [(1, 1), (2, 3), (3, 7)]
    assert collect(neighbors.vote(n, "softmax"), "query_id", "prediction") == [(1, 1), (2, 3), (3, 7) if math.exp(-.1) > 2 * math.exp(-1) else (3, 4)]


# ---- kernels ---------------------------------------------------------------------------

@pytest.mark.parametrize("kind,dim", [("poly", 3), ("rbf", 1), ("rbf", 2)])
def test_feature_maps_are_exact(kind, dim):
    x = np.random.default_rng(0).uniform(-1, 1, size=(40, dim)) / math.sqrt(dim)
    fmap = kernels.FeatureMap.build(kind, dim, gamma=0.7, degree=3, radius=1.0)
    k = kernels.kernel_matrix(kind, x, x, 0.7, 3)
    assert np.allclose(fmap(x) @ fmap(x).T, k, atol=1e-12)
    if kind == "rbf":
        assert np.allclose(np.diag(k), 1)


def test_dual_regression_matches_the_direct_recursion(spark):
    g = np.random.default_rng(2)
    x = np.linspace(-1, 1, 30)
    t = np.sin(5 * x) + 1 + 0.2 * g.normal(size=30)
    batch, test = np.arange(30) % 3, np.arange(30) % 5 == 0
    rows = [(i, [float(x[i])], float(t[i]), int(batch[i]), bool(test[i])) for i in range(30)]
    df = spark.createDataFrame(rows, "id long, features array<double>, target double, batch int, is_test boolean")
    model, curve = kernels.fit_regression(df, kernels.FeatureMap.build("rbf", 1), 20, 0.1, 0.05)
    tr = ~test
    k = kernels.kernel_matrix("rbf", x[tr][:, None], x[tr][:, None])
    bias, beta, want = t[tr].mean(), np.zeros(tr.sum()), []
    for _ in range(20):
        for b in range(3):
            at = batch[tr] == b
            step = np.where(at, k @ beta - t[tr] + bias, 0) / at.sum()
            beta = beta - 0.1 * step - 0.1 * 0.05 * beta
        want.append(np.sqrt(np.mean((k @ beta + bias - t[tr]) ** 2)))
    assert np.allclose([c[2] for c in curve if not c[1]], want)
    got = [r["beta"] for r in model.betas(df.where("not is_test"), "target").orderBy("id").collect()]
    assert np.allclose(got, beta)


def test_support_rows_and_score(spark):
    df = spark.createDataFrame([(1, 0.0, 1.0), (2, 0.5, -1.0)], "id int, a double, t double")
    assert collect(kernels.support_rows(df, "a", "t"), "id", "coef") == [(2, -0.5)]
    q = spark.createDataFrame([(1, [1.0, 2.0])], "id int, features array<double>")
    out = kernels.kernel_score(q, np.array([[1.0, 0.0], [0.0, 1.0]]), np.array([1.0, -1.0]), 0.5, "poly", 1.0, 2).first()
    assert out["score"] == pytest.approx(4 - 9 + 0.5) and out["sign"] == -1


# ---- estimators --------------------------------------------------------------------------

def test_svm_separates(spark, points):
    df, x, _ = points
    df = df.withColumn("label", (F.col("features")[0] + F.col("features")[1] > 6).cast("int"))
    for kernel, floor in (("poly", 0.95), ("rbf", 0.8)):
        scored = ensembles.svm(df, kernel=kernel, gamma=0.5, width=32, max_iter=12).fit(df).transform(df)
        assert scored.agg(metrics.accuracy("prediction", "label")).first()[0] > floor
        assert 0 < ensembles.support_vectors(scored).count() < 200


def test_grid_search_scores_train_folds(spark, points):
    df, *_ = points
    folded = sampling.stratified_folds(df.withColumn("label", (F.col("label") > 0).cast("int")), "id", "label", 2)
    pipe = ensembles.scaled_logistic(folded, max_iter=10)
    grid = ensembles.ParamGridBuilder().addGrid(pipe.getStages()[-1].regParam, [0.0, 10.0]).build()
    model, rows = ensembles.grid_search(folded, pipe, grid, "fold", 2, train_scores=True)
    assert len(rows) == 2 and all(len(r) == 3 for r in rows) and model.bestModel is not None
