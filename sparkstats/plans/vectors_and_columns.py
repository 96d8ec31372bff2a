"""Joins, aggregates, scalar functions, scaling: queries over vectors and columns."""

import math

import numpy as np
from pyspark.sql import functions as F

from ..functions import rng, scalars, vectors
from ..operators import (bayes, cluster, features as ft, gram, gradient, kernels, metrics, neighbors, project, resampling)
from . import base as b
from .base import PARTS, PIX, PROSE, VEC, long_rows, query, r, rs, table
from .edits import EDITS, edits

DIM = 64
MEANS = VEC + ", means AS MATERIALIZED (SELECT label AS class, d, avg(x) AS m FROM vec WHERE NOT is_test GROUP BY label, d)"


def class_points(spark, sf):
    """Class numbers and the class means of the training rows: a model-sized set of points."""
    s = bayes.class_sums(b.vec(spark, sf).where("not is_test"), DIM)
    return s.classes, s.means


def per_point(df, column: str, classes: list, value: str, *keep):
    """One row per (row, point): the bounded second side of a distance or kernel table."""
    names = F.array(*[F.lit(int(c)) for c in classes])
    out = df.select("id", *keep, F.posexplode(column).alias("_i", "_v"))
    return out.select("id", *keep, F.get(names, F.col("_i")).alias("class"), r("_v").alias(value))


@query("pairwise_lp_distance", f"""WITH {MEANS} SELECT id, CAST(p AS INTEGER) AS p, class,
  {rs('pow(sum(pow(abs(x - m), p)), CAST(1 AS DOUBLE) / p)')} AS distance
  FROM vec JOIN means USING (d), (SELECT unnest([1, 2, 3]) AS p) GROUP BY id, p, class""")
def pairwise_lp_distance(spark, sf):
    classes, points = class_points(spark, sf)
    out = None
    for p in (1, 2, 3):
        one = per_point(cluster.distances_to(b.vec(spark, sf), points, p).withColumn("p", F.lit(p)), "distances", classes, "distance", "p")
        out = one if out is None else out.unionByName(one)
    return out


@query("nearest_center", f"""WITH {MEANS}, dist AS (SELECT id, class, sqrt(sum((x - m) * (x - m))) AS v FROM vec JOIN means USING (d) GROUP BY id, class)
  SELECT id, arg_min(class, struct_pack(v := round(v, 12), c := class)) AS class, {rs('min(v)')} AS distance FROM dist GROUP BY id""")
def nearest_center(spark, sf):
    classes, points = class_points(spark, sf)
    names = F.array(*[F.lit(int(c)) for c in classes])
    return cluster.nearest_center(b.vec(spark, sf), points).select(
        "id", F.get(names, F.col("cluster")).alias("class"), r("distance").alias("distance"))


def _kernel_sql(value: str) -> str:
    return f"""WITH {MEANS} SELECT id, class, {rs(value)} AS k FROM vec JOIN means USING (d) GROUP BY id, class"""


@query("kernel_poly", _kernel_sql("pow(0.5 * sum(x * m) + 1, 3)"))
def kernel_poly(spark, sf):
    classes, points = class_points(spark, sf)
    return per_point(kernels.kernel_values(b.vec(spark, sf), points, "poly", 0.5, 3), "kernel", classes, "k")


@query("kernel_rbf", _kernel_sql("exp(-0.5 * sum((x - m) * (x - m)))"))
def kernel_rbf(spark, sf):
    classes, points = class_points(spark, sf)
    return per_point(kernels.kernel_values(b.vec(spark, sf), points, "rbf", 0.5), "kernel", classes, "k")


@query("kernel_score", f"""WITH {MEANS}, k AS (SELECT id, class, exp(-0.5 * sum((x - m) * (x - m))) AS v FROM vec JOIN means USING (d) GROUP BY id, class)
  SELECT id, {rs('sum(v * (2 * (class % 2) - 1)) + 0.05')} AS score, CAST(sign(sum(v * (2 * (class % 2) - 1)) + 0.05) AS INTEGER) AS sign FROM k GROUP BY id""")
def kernel_score(spark, sf):
    classes, points = class_points(spark, sf)
    coef = np.array([2.0 * (c % 2) - 1 for c in classes])
    return kernels.kernel_score(b.vec(spark, sf), points, coef, 0.05, "rbf", 0.5).select("id", r("score").alias("score"), "sign")


@query("kernel_sums", f"""WITH {VEC}, k AS (SELECT q.id, t.id AS tid, t.label, pow(0.5 * sum(q.x * t.x) + 1, 2) AS v
    FROM vec q JOIN vec t ON q.d = t.d WHERE q.is_test AND NOT t.is_test GROUP BY q.id, t.id, t.label)
  SELECT id, {rs('sum(v * (2 * (label % 2) - 1)) - 0.25')} AS score FROM k GROUP BY id""")
def kernel_sums(spark, sf):
    """Scores against every training row, through the feature map."""
    v = b.vec(spark, sf).withColumn("coef", scalars.to_sign(scalars.parity("label")).cast("double"))
    fmap = kernels.FeatureMap.build("poly", DIM, gamma=0.5, degree=2)
    out = kernels.kernel_sums(v.where("is_test"), v.where("not is_test"), "coef", fmap, -0.25)
    return out.select("id", r("score").alias("score"))


@query("kernel_sums_blocks", f"""WITH {VEC}, k AS (SELECT q.id, t.id AS tid, t.label, pow(0.5 * sum(q.x * t.x) + 1, 3) AS v
    FROM vec q JOIN vec t ON q.d = t.d WHERE q.is_test AND NOT t.is_test GROUP BY q.id, t.id, t.label)
  SELECT id, {rs('sum(v * (2 * (label % 2) - 1)) - 0.25')} AS score FROM k GROUP BY id""")
def kernel_sums_blocks(spark, sf):
    """Degree 3 on 64 inputs: too wide for a feature map, so blocks of rows meet."""
    v = b.vec(spark, sf).withColumn("coef", scalars.to_sign(scalars.parity("label")).cast("double"))
    out = kernels.kernel_sums_in_blocks(v.where("is_test"), v.where("not is_test"), "coef", "poly", 0.5, 3, -0.25)
    return out.select("id", r("score").alias("score"))


@query("linear_score", f"""WITH {VEC} SELECT id, {rs(f"sum(x * ({b.u(42, 'weights', 'd', '0')} * 0.2 - 0.1))")} AS score FROM vec GROUP BY id""")
def linear_score(spark, sf):
    w = gradient.initial_weights(DIM)[:-1, 0]
    weights = F.array(*[F.lit(float(v)) for v in w])
    return b.vec(spark, sf).select("id", r(vectors.dot("features", weights)).alias("score"))


# ---- class sums ---------------------------------------------------------------

def _sums(spark, sf):
    return bayes.class_sums(b.pixels(spark, sf).where("not is_test"), DIM)


@query("class_priors", f"""WITH {VEC} SELECT label, {rs('count(*) / CAST(sum(count(*)) OVER () AS DOUBLE)')} AS prior FROM vec WHERE NOT is_test GROUP BY label""")
def class_priors(spark, sf):
    counts = b.vec(spark, sf).where("not is_test").groupBy("label").count().collect()
    total = sum(c["count"] for c in counts)
    return spark.createDataFrame([(c["label"], round(c["count"] / total, 6)) for c in counts], "label int, prior double")


def _class_sql(value: str, name: str) -> str:
    return f"WITH {PIX} SELECT label, d AS feature, {rs(value)} AS {name} FROM pix WHERE NOT is_test GROUP BY label, d"


@query("class_means", _class_sql("avg(x)", "mean"))
def class_means(spark, sf):
    s = _sums(spark, sf)
    return bayes.class_table(spark, s, s.means, "mean").withColumn("mean", r("mean"))


@query("class_variances", _class_sql("var_pop(x) + 0.1", "variance"))
def class_variances(spark, sf):
    s = _sums(spark, sf)
    return bayes.class_table(spark, s, s.variances(0.1), "variance").withColumn("variance", r("variance"))


@query("bernoulli_probs", _class_sql("(count(*) FILTER (x >= 8) + 0.1::DOUBLE) / (count(*) + 0.2::DOUBLE)", "p"))
def bernoulli_probs(spark, sf):
    s = _sums(spark, sf)
    return bayes.class_table(spark, s, s.bernoulli(0.1), "p").withColumn("p", r("p"))


@query("multinomial_probs", f"""WITH {PIX}, s AS (SELECT label, d, sum(x) AS n FROM pix WHERE NOT is_test GROUP BY label, d)
  SELECT label, d AS feature, {rs('(n + 0.1::DOUBLE) / (sum(n) OVER (PARTITION BY label) + 6.4::DOUBLE)')} AS p FROM s""")
def multinomial_probs(spark, sf):
    s = _sums(spark, sf)
    return bayes.class_table(spark, s, s.multinomial(0.1), "p").withColumn("p", r("p"))


# ---- moments ------------------------------------------------------------------

LINE_COLUMNS = {"quantity": "l_quantity / 50.0::DOUBLE", "discount": "l_discount * 10.0::DOUBLE", "tax": "l_tax * 10.0::DOUBLE",
                "price": "l_extendedprice / 100000.0::DOUBLE"}


def line_columns():
    return {"quantity": F.col("l_quantity") / 50.0, "discount": F.col("l_discount") * 10.0, "tax": F.col("l_tax") * 10.0,
            "price": F.col("l_extendedprice") / 100000.0}


def _pair_sql(value: str, columns: dict, name: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{c}' AS b, {rs(value.format(x='(' + columns[a] + ')', y='(' + columns[c] + ')'))} AS {name} FROM lineitem"
        for a in columns for c in columns)


@query("gram_matrix", _pair_sql("sum({x} * {y}) / count(*)", {**LINE_COLUMNS, "bias": "1.0::DOUBLE"}, "value"))
def gram_matrix(spark, sf):
    m = gram.moments(table(spark, sf, "lineitem"), {**line_columns(), "bias": F.lit(1.0)})
    return gram.matrix_table(spark, m.cross / m.n, m.names).withColumn("value", r("value"))


@query("covariance_matrix", f"""WITH {VEC}, c AS MATERIALIZED (SELECT id, d, x - avg(x) OVER (PARTITION BY d) AS x FROM vec)
  SELECT p.d AS i, q.d AS j, {rs('avg(p.x * q.x)', 8)} AS value FROM c p JOIN c q ON p.id = q.id GROUP BY p.d, q.d""")
def covariance_matrix(spark, sf):
    m = gram.vector_moments(b.vec(spark, sf), DIM, center=True)
    return gram.matrix_table(spark, m.covariance()).withColumn("value", r("value", 8))


@query("correlation_matrix", _pair_sql("corr({x}, {y})", LINE_COLUMNS, "correlation"))
def correlation_matrix(spark, sf):
    m = gram.moments(table(spark, sf, "lineitem"), line_columns(), center=True)
    return gram.matrix_table(spark, m.correlation(), m.names, "correlation").withColumn("correlation", r("correlation"))


@query("minmax_scale", f"""WITH {VEC}, s AS (SELECT d, min(x) AS lo, max(x) AS hi FROM vec WHERE NOT is_test GROUP BY d)
  SELECT id, d, {rs('(x - lo) / (hi - lo)')} AS x FROM vec JOIN s USING (d)""")
def minmax_scale(spark, sf):
    v = b.vec(spark, sf)
    return long_rows(ft.ScaleArray("features", "scaled", "min_max").fit(v.where("not is_test")).transform(v), "id", features="scaled")


@query("standard_scale", f"""WITH {VEC}, s AS (SELECT d, avg(x) AS m, stddev_pop(x) AS sd FROM vec WHERE NOT is_test GROUP BY d)
  SELECT id, d, {rs('(x - m) / sd')} AS x FROM vec JOIN s USING (d)""")
def standard_scale(spark, sf):
    v = b.vec(spark, sf)
    return long_rows(ft.ScaleArray("features", "scaled", "standard").fit(v.where("not is_test")).transform(v), "id", features="scaled")


def _landmark_sql(col: str, tab: str, n: int = 11) -> str:
    marks = ", ".join(f"{i / (n - 1)!r}::DOUBLE" for i in range(n))
    return f"SELECT '{col}' AS name, CAST(generate_subscripts(q, 1) - 1 AS INTEGER) AS i, unnest(q) AS v FROM (SELECT quantile_cont({col}, [{marks}]) AS q FROM {tab})"


@query("quantile_landmarks", f"""SELECT name, i, {rs('v', 4)} AS value FROM ({_landmark_sql('l_extendedprice', 'lineitem')}
  UNION ALL {_landmark_sql('c_acctbal', 'customer')})""")
def quantile_landmarks(spark, sf):
    rows = []
    for name, tab in (("l_extendedprice", "lineitem"), ("c_acctbal", "customer")):
        rows += [(name, i, float(v)) for i, v in enumerate(ft.quantile_landmarks(table(spark, sf, tab), name, 11))]
    return spark.createDataFrame(rows, "name string, i int, value double").withColumn("value", r("value", 4))


@query("quantile_transform", f"""WITH q AS MATERIALIZED ({_landmark_sql('o_totalprice', 'orders')}),
  f AS (SELECT o_orderkey, o_totalprice AS x, (SELECT min(v) FROM q) AS lo, (SELECT max(v) FROM q) AS hi,
        max(q.i) FILTER (q.v <= o_totalprice) AS up, min(q.i) FILTER (q.v >= o_totalprice) AS down
        FROM orders, q GROUP BY o_orderkey, o_totalprice)
  SELECT o_orderkey, {rs('''CASE WHEN x <= lo THEN 0.0::DOUBLE WHEN x >= hi THEN 1.0::DOUBLE ELSE 0.5 * (
      a.i / 10.0::DOUBLE + (x - a.v) / (a1.v - a.v) / 10.0::DOUBLE + d.i / 10.0::DOUBLE - (d.v - x) / (d.v - d1.v) / 10.0::DOUBLE) END''')} AS position
  FROM f LEFT JOIN q a ON a.i = up LEFT JOIN q a1 ON a1.i = up + 1 LEFT JOIN q d ON d.i = down LEFT JOIN q d1 ON d1.i = down - 1""")
def quantile_transform(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    model = ft.ColumnTransform([("quantile", ["o_totalprice"])], landmarks=11).fit(o)
    return model.transform(o).select("o_orderkey", r(F.element_at("features", 1)).alias("position"))


@query("edit_counts", f"""WITH {EDITS} SELECT lang, CAST(sum(correct) AS BIGINT) AS tp, CAST(sum(predicted - correct) AS BIGINT) AS fp,
  CAST(sum(gold - correct) AS BIGINT) AS fn, {rs('avg(rating)')} AS rating FROM edits GROUP BY lang""")
def edit_counts(spark, sf):
    out = resampling.edit_counts(edits(spark, sf), "lang", "gold", "predicted", "correct", "rating")
    return out.withColumn("rating", r("rating"))


@query("pearson", f"""WITH {EDITS} SELECT lang, CASE WHEN min(correct) < max(correct) AND min(rating) < max(rating) THEN {rs('corr(correct, rating)')} END AS correlation,
  CASE WHEN max(rating - rating) = min(rating - rating) THEN NULL ELSE corr(rating - rating, rating) END AS constant FROM edits GROUP BY lang""")
def pearson(spark, sf):
    e = edits(spark, sf).withColumn("zero", F.col("rating") - F.col("rating"))
    return e.groupBy("lang").agg(r(resampling.pearson("correct", "rating")).alias("correlation"),
                                       resampling.pearson("zero", "rating").alias("constant"))


@query("f_beta", f"""WITH {EDITS}, c AS (SELECT lang, CAST(sum(correct) AS DOUBLE) AS tp, CAST(sum(predicted - correct) AS DOUBLE) AS fp,
    CAST(sum(gold - correct) AS DOUBLE) AS fn FROM edits GROUP BY lang)
  SELECT lang, beta, {rs('(tp + beta * beta * tp) / nullif(tp + fp + beta * beta * (tp + fn), 0)')} AS f
  FROM c, (SELECT unnest([0.0::DOUBLE, 0.5::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE]) AS beta)""")
def f_beta(spark, sf):
    counts = resampling.edit_counts(edits(spark, sf), "lang", "gold", "predicted", "correct", "rating")
    grid = F.explode(F.array(*[F.lit(v) for v in (0.0, 0.5, 1.0, 2.0)]))
    return counts.withColumn("beta", grid).select("lang", "beta", r(scalars.f_beta("tp", "fp", "fn", "beta")).alias("f"))


@query("argbest", """WITH c AS (SELECT event_type, user_id, count(*) AS n FROM events GROUP BY ALL)
  SELECT 'most' AS kind, event_type, arg_min(user_id, struct_pack(a := -n, b := user_id)) AS user_id, max(n) AS n FROM c GROUP BY event_type
  UNION ALL SELECT 'least', event_type, arg_min(user_id, struct_pack(a := n, b := user_id)), min(n) FROM c GROUP BY event_type""")
def argbest(spark, sf):
    c = table(spark, sf, "events").groupBy("event_type", "user_id").agg(F.count("*").alias("n"))
    pick = lambda kind, lowest: metrics.best_by(c, "user_id", "n", ["event_type"], lowest).withColumn("kind", F.lit(kind))
    return pick("most", False).unionByName(pick("least", True))


@query("distinct_categories", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS n FROM part GROUP BY 1, 2" for c in ("p_brand", "p_type", "p_size")))
def distinct_categories(spark, sf):
    return ft.distinct_categories(table(spark, sf, "part"), ["p_brand", "p_type", "p_size"])


# ---- scalar functions -----------------------------------------------------------

@query("lp_norm", f"""WITH {VEC} SELECT id, CAST(p AS INTEGER) AS p, {rs('pow(sum(pow(abs(x), p)), CAST(1 AS DOUBLE) / p)')} AS norm
  FROM vec, (SELECT unnest([1, 2, 3]) AS p) GROUP BY id, p""")
def lp_norm(spark, sf):
    norms = F.explode(F.array(*[F.struct(F.lit(p).alias("p"), vectors.lp_norm("features", p).alias("n")) for p in (1, 2, 3)]))
    return b.vec(spark, sf).select("id", norms.alias("s")).select("id", "s.p", r("s.n").alias("norm"))


@query("softmax", f"WITH {VEC} SELECT id, d, {rs('exp(x) / sum(exp(x)) OVER (PARTITION BY id)')} AS x FROM vec")
def softmax(spark, sf):
    return long_rows(b.vec(spark, sf).withColumn("features", vectors.softmax("features")), "id")


CHANCE = "1 / (1 + exp(-(a + b - c)))"


@query("log_loss_binary", f"""WITH {PARTS}, s AS (SELECT id, CASE WHEN {b.u(3, 'sure', 'id')} < 0.01 THEN 0.0::DOUBLE ELSE {CHANCE} END AS p, CAST(id % 2 AS DOUBLE) AS t FROM parts)
  SELECT id, {rs('-t * ln(greatest(1e-15::DOUBLE, least(1 - 1e-15::DOUBLE, p))) - (1 - t) * ln(1 - greatest(1e-15::DOUBLE, least(1 - 1e-15::DOUBLE, p)))')} AS loss FROM s""")
def log_loss_binary(spark, sf):
    p = F.when(rng.uniform(3, "sure", "id") < 0.01, F.lit(0.0)).otherwise(scalars.sigmoid(F.col("a") + F.col("b") - F.col("c")))
    rows = b.parts(spark, sf).select("id", p.alias("p"), (F.col("id") % 2).cast("double").alias("t"))
    return rows.select("id", r(scalars.log_loss_binary("p", "t")).alias("loss"))


@query("log_loss_multi", f"WITH {VEC}, s AS (SELECT id, label, d, exp(x) / sum(exp(x)) OVER (PARTITION BY id) AS p FROM vec) SELECT id, {rs('-ln(p)')} AS loss FROM s WHERE d = label")
def log_loss_multi(spark, sf):
    v = b.vec(spark, sf).withColumn("p", vectors.softmax("features"))
    return v.select("id", r(scalars.log_loss_multi("p", "label")).alias("loss"))


@query("one_hot_label", "SELECT vec_id AS id, CAST(k AS INTEGER) AS class, CAST(label = k AS INTEGER) AS bit FROM embeddings, range(10) AS g(k)")
def one_hot_label(spark, sf):
    return b.vec(spark, sf).select("id", F.posexplode(vectors.one_hot("label", 10)).alias("class", "bit"))


@query("gaussian_logpdf", f"""WITH {VEC}, s AS (SELECT label, d, avg(x) AS m, var_pop(x) + 0.1 AS v FROM vec GROUP BY label, d)
  SELECT id, d, {rs('-0.5 * ln(2 * pi() * v) - pow(x - m, 2) / (2 * v)')} AS logpdf FROM vec JOIN s USING (label, d)""")
def gaussian_logpdf(spark, sf):
    x = vectors.long_form(b.vec(spark, sf), "id", "label")
    stats = x.groupBy("label", "d").agg(F.avg("x").alias("m"), (F.var_pop("x") + 0.1).alias("v"))
    return x.join(stats, ["label", "d"]).select("id", "d", r(scalars.gaussian_logpdf("x", "m", "v")).alias("logpdf"))


@query("accuracy", f"""WITH {VEC} SELECT {rs('avg(CAST(CAST(floor(' + b.u(1, 'guess', 'id') + ' * 3) AS INTEGER) = label % 3 AS INTEGER))')} AS accuracy FROM vec WHERE d = 0""")
def accuracy(spark, sf):
    guess = F.floor(rng.uniform(1, "guess", "id") * 3).cast("int")
    v = b.vec(spark, sf).select(guess.alias("prediction"), (F.col("label") % 3).alias("label"))
    return v.agg(r(metrics.accuracy("prediction", "label")).alias("accuracy"))


@query("accuracy_prob", f"""WITH {PARTS} SELECT {rs('avg(CAST(abs(CASE WHEN ' + b.u(3, 'half', 'id') + ' < 0.1 THEN 0.5 ELSE a END - id % 2) <= 0.5 AS INTEGER))')} AS accuracy FROM parts""")
def accuracy_prob(spark, sf):
    p = F.when(rng.uniform(3, "half", "id") < 0.1, F.lit(0.5)).otherwise(F.col("a"))
    rows = b.parts(spark, sf).select(p.alias("p"), (F.col("id") % 2).cast("double").alias("t"))
    return rows.agg(r(metrics.accuracy_prob("p", "t")).alias("accuracy"))


@query("rmse", f"WITH {PROSE} SELECT is_test, {rs('sqrt(avg(pow(6.0::DOUBLE * a - t, 2)))')} AS rmse FROM prose GROUP BY is_test")
def rmse(spark, sf):
    """The error of six characters a word."""
    return b.prose(spark, sf).groupBy("is_test").agg(r(metrics.rmse(F.lit(6.0) * F.col("a"), "t")).alias("rmse"))


# ---- transformers ---------------------------------------------------------------

@query("one_hot", f"""WITH cats AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS d FROM (
    SELECT DISTINCT p_brand AS v FROM part WHERE NOT {b.u(42, 'split', 'p_partkey')} < 0.5))
  SELECT p_partkey AS id, d, CAST(p_brand = v AS INTEGER)::DOUBLE AS x FROM part, cats""")
def one_hot(spark, sf):
    p = table(spark, sf, "part").withColumn("id", F.col("p_partkey"))
    model = ft.ColumnTransform([("one_hot", ["p_brand"])]).fit(p.where(~b.is_test()))
    return long_rows(model.transform(p), "id", digits=None)


def _monomial_sql(names: list[str], degree: int) -> list[str]:
    return [" * ".join(names[i] for i in t) for t in vectors.monomials(len(names), degree)]


@query("poly_features", f"WITH {PARTS} " + " UNION ALL ".join(
    f"SELECT id, {i} AS d, {rs(e, 12)} AS x FROM parts" for i, e in enumerate(_monomial_sql(["a", "b", "c"], 3))))
def poly_features(spark, sf):
    p = b.parts(spark, sf).withColumn("features", F.array(*vectors.poly_columns(["a", "b", "c"], 3)))
    return long_rows(p, "id", digits=12)


def _column_transform_sql() -> str:
    names = [f"h{i}" for i in range(6)] + ["s0", "s1"]
    monos = " UNION ALL ".join(f"SELECT id, {i} AS d, {rs(e)} AS x FROM w" for i, e in enumerate(_monomial_sql(names, 2)))
    hot = ", ".join(f"CAST(coalesce(p_type = (SELECT v FROM cats WHERE d = {i}), FALSE) AS INTEGER)::DOUBLE AS h{i}" for i in range(6))
    return f"""WITH p AS (SELECT *, p_partkey AS id, {b.u(42, 'split', 'p_partkey')} < 0.5 AS is_test FROM part),
  cats AS MATERIALIZED (SELECT v, row_number() OVER (ORDER BY v) - 1 AS d FROM (SELECT DISTINCT p_type AS v FROM p WHERE NOT is_test)),
  st AS MATERIALIZED (SELECT avg(p_size) AS m0, stddev_pop(p_size) AS v0, avg(p_retailprice) AS m1, stddev_pop(p_retailprice) AS v1 FROM p WHERE NOT is_test),
  w AS MATERIALIZED (SELECT id, {hot}, (p_size - m0) / v0 AS s0, (p_retailprice - m1) / v1 AS s1 FROM p, st) {monos}"""


@query("column_transform", _column_transform_sql())
def column_transform(spark, sf):
    """One-hot and standardised groups side by side, then products of degree 2."""
    p = table(spark, sf, "part").withColumn("id", F.col("p_partkey"))
    model = ft.ColumnTransform([("one_hot", ["p_type"]), ("standard", ["p_size", "p_retailprice"])]).fit(p.where(~b.is_test()))
    rows = ft.dealt(p, math.comb(model.width() + 2, 2) - 1)
    return long_rows(ft.PolyExpand("features", "poly", 2).transform(model.transform(rows)), "id", features="poly", by_udf=True)


def _power_sql(k: int = 2) -> str:
    ctes = [VEC, "c AS MATERIALIZED (SELECT id, d, x - avg(x) OVER (PARTITION BY d) AS x FROM vec)",
            "s0 AS MATERIALIZED (SELECT p.d AS i, q.d AS j, avg(p.x * q.x) AS v FROM c p JOIN c q ON p.id = q.id GROUP BY p.d, q.d)"]
    for c in range(k):
        prev = f"v{c}_0"
        ctes.append(f"{prev} AS MATERIALIZED (SELECT i, 2 * {b.u(42, 'pca', str(c), 'i')} - 1 AS v, 0.0::DOUBLE AS l FROM (SELECT DISTINCT i FROM s{c}))")
        for step in range(1, 11):
            ctes.append(f"""v{c}_{step} AS MATERIALIZED (SELECT i, y / sqrt(sum(y * y) OVER ()) AS v, sqrt(sum(y * y) OVER ()) AS l
              FROM (SELECT s{c}.i, sum(s{c}.v * w.v) AS y FROM s{c} JOIN {prev} w ON w.i = s{c}.j GROUP BY s{c}.i))""")
            prev = f"v{c}_{step}"
        ctes.append(f"s{c + 1} AS MATERIALIZED (SELECT s.i, s.j, s.v - a.l * a.v * z.v AS v FROM s{c} s JOIN {prev} a ON a.i = s.i JOIN {prev} z ON z.i = s.j)")
    union = " UNION ALL ".join(f"SELECT {c} AS component, i, round(v, 4) AS v FROM v{c}_10" for c in range(k))
    return "WITH " + ",\n".join(ctes) + f""", comps AS MATERIALIZED ({union})
  SELECT id, component, {rs('sum(x * v)', 5)} AS x FROM vec JOIN comps ON i = d GROUP BY id, component"""


@query("pca_power", _power_sql())
def pca_power(spark, sf):
    v = b.vec(spark, sf)
    out = project.transform(v, project.fit(v, DIM, 2))
    return out.select("id", F.posexplode("projected").alias("component", "x")).withColumn("x", r("x", 5))


@query("pca_project")
def pca_project(spark, sf):
    v = b.vec(spark, sf)
    out = project.transform(v, project.fit(v, DIM, 12))
    return out.select("id", F.posexplode("projected").alias("component", "x")).withColumn("x", r("x", 5))


# ---- neighbours -----------------------------------------------------------------

def neighbor_sql(p: int, k: int) -> str:
    return f"""{VEC}, dist AS (SELECT q.id AS query_id, t.id AS train_id, t.label,
      round(pow(sum(pow(abs(q.x - t.x), {p})), CAST(1 AS DOUBLE) / {p}), 9) AS distance
    FROM vec q JOIN vec t ON q.d = t.d WHERE q.is_test AND NOT t.is_test GROUP BY q.id, t.id, t.label),
  knn AS MATERIALIZED (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, train_id) AS INTEGER) AS rank FROM dist) WHERE rank <= {k})"""


def neighbor_rows(spark, sf, p: int, k: int):
    v = b.vec(spark, sf)
    return neighbors.knn_join(v.where("is_test"), v.where("not is_test"), k, neighbors.Dense(p), ["label"])


@query("knn_join", " UNION ALL ".join(
    f"(WITH {neighbor_sql(p, 3)} SELECT {p} AS p, query_id, rank, train_id, {rs('distance')} AS distance FROM knn)" for p in (1, 2, 3)))
def knn_join(spark, sf):
    out = None
    for p in (1, 2, 3):
        one = neighbor_rows(spark, sf, p, 3).select(F.lit(p).alias("p"), "query_id", "rank", "train_id", r("distance").alias("distance"))
        out = one if out is None else out.unionByName(one)
    return out


def vote_sql(weights: str, p: int = 2, k: int = 5) -> str:
    weight = {"uniform": "1.0::DOUBLE", "inverse": "CASE WHEN distance = 0 THEN 0 ELSE 1 / distance END", "softmax": "exp(-distance)"}[weights]
    zero = "max(CASE WHEN distance = 0 THEN 1 ELSE 0 END)" if weights == "inverse" else "0"
    scale = "sum(w) OVER (PARTITION BY query_id)" if weights == "softmax" else "1"
    return f"""{neighbor_sql(p, k)}, votes AS (SELECT query_id, label, sum({weight}) AS w, {zero} AS z FROM knn GROUP BY query_id, label),
  ranked AS (SELECT query_id, label, row_number() OVER (PARTITION BY query_id ORDER BY z DESC, CASE WHEN z = 1 THEN 0 ELSE round(w, 9) END DESC, label) AS n FROM votes),
  voted AS MATERIALIZED (SELECT query_id, label AS prediction FROM ranked WHERE n = 1)"""


def _register_votes(weights: str):
    @query(f"knn_vote_{weights}", f"WITH {vote_sql(weights)} SELECT * FROM voted")
    def votes(spark, sf):
        return neighbors.vote(neighbor_rows(spark, sf, 2, 5), weights)

    @query(f"knn_classify_{weights}", f"""WITH {vote_sql(weights, 1, 3)}
      SELECT query_id, prediction, label FROM voted JOIN (SELECT id AS query_id, label FROM vec WHERE d = 0) USING (query_id)""")
    def classified(spark, sf):
        v = b.vec(spark, sf)
        out = neighbors.classify(v.where("is_test"), v.where("not is_test"), 3, 1, weights)
        return out.join(v.select(F.col("id").alias("query_id"), "label"), "query_id")


for _weights in ("uniform", "inverse", "softmax"):
    _register_votes(_weights)


@query("first_error_per_class", f"""WITH {vote_sql('uniform', 2, 3)},
  wrong AS (SELECT v.label AS true_label, min(query_id) AS query_id FROM voted JOIN vec v ON v.id = query_id AND v.d = 0 WHERE prediction <> v.label GROUP BY v.label)
  SELECT query_id, rank, train_id, true_label, prediction FROM wrong JOIN voted USING (query_id) JOIN knn USING (query_id)""")
def first_error_per_class(spark, sf):
    v = b.vec(spark, sf)
    found = neighbor_rows(spark, sf, 2, 3)
    scored = neighbors.vote(found, "uniform").withColumnRenamed("query_id", "id").join(v.select("id", "label"), "id")
    return neighbors.first_error_per_class(scored, found)
