"""Model fits, iterative fits, model selection and resampling."""

from pyspark.sql import functions as F

from ..functions import rng, scalars, vectors
from ..operators import bayes, boosting, cluster, ensembles, features as ft, gradient, kernels, linear, metrics, newton, resampling, sampling
from . import base as b
from .base import CURVE, GRADED, PIX, PROSE, VEC, query, r, rs, table
from .edits import COLUMNS as EDIT_COLUMNS, EDITS, edits
from .scans import PROSE_SOLVE, PROSE_WEIGHTS, prose_columns
from .vectors_and_columns import DIM

# ---- least squares --------------------------------------------------------------

NAMES = "CASE i WHEN 0 THEN 'a' WHEN 1 THEN 'b' WHEN 2 THEN 'c' ELSE 'bias' END AS feature"


def prose_moments(spark, sf, **options):
    return linear.moments(b.prose(spark, sf), prose_columns("t"), by="is_test", **options)


@query("ols_fit", f"WITH {PROSE_SOLVE} SELECT {NAMES}, {rs('w')} AS weight FROM sol")
def ols_fit(spark, sf):
    return linear.fit_normal(prose_moments(spark, sf)[False]).table(spark).withColumn("weight", r("weight"))


@query("ols_rmse", f"""WITH {PROSE_SOLVE} SELECT is_test, {rs('sqrt(avg(pow(wa * a + wb * b + wc * c + w0 - t, 2)))')} AS rmse
  FROM prose, {PROSE_WEIGHTS} GROUP BY is_test""")
def ols_rmse(spark, sf):
    m = prose_moments(spark, sf, center=True)
    model = linear.fit_ols(m[False])
    return spark.createDataFrame([(k, model.rmse(v)) for k, v in m.items()], "is_test boolean, rmse double").withColumn("rmse", r("rmse"))


@query("ols_simple", f"SELECT {rs('regr_slope(l_extendedprice, l_quantity)', 4)} AS slope, {rs('regr_intercept(l_extendedprice, l_quantity)', 4)} AS intercept FROM lineitem")
def ols_simple(spark, sf):
    x, y = F.col("l_quantity"), F.col("l_extendedprice")
    return table(spark, sf, "lineitem").agg(r(F.regr_slope(y, x), 4).alias("slope"), r(F.regr_intercept(y, x), 4).alias("intercept"))


def ridge_sql(alphas: str, key: str = "al", fold: str = "0", folds: str = "SELECT 0 AS f") -> str:
    """Ridge weights for each alpha (table `al`), leaving out fold f (one that no row has: none)."""
    names = ["a", "b", "c", "t"]
    means = ", ".join(f"avg({n}) AS m{n}" for n in names)
    cent = ", ".join(f"{n} - m{n} AS {n}" for n in names)
    return f"""al AS MATERIALIZED ({alphas}), fo AS MATERIALIZED ({folds}),
  tr AS MATERIALIZED (SELECT fo.f, r.* FROM prose_in r, fo WHERE r.fold <> fo.f),
  mu AS MATERIALIZED (SELECT f, {means} FROM tr GROUP BY f),
  ce AS MATERIALIZED (SELECT f, {cent} FROM tr JOIN mu USING (f)), {b.moments_sql('ce', names, key='f')},
  aug AS MATERIALIZED (SELECT al.n * 1000 + m.k AS k, i, j, v + CASE WHEN i = j THEN al.alpha ELSE 0 END AS v FROM m, al WHERE i < 3),
  {b.solve_sql('aug', 3)},
  wts AS MATERIALIZED (SELECT k // 1000 AS n, k % 1000 AS f, max(w) FILTER (i = 0) AS wa, max(w) FILTER (i = 1) AS wb, max(w) FILTER (i = 2) AS wc FROM sol GROUP BY k),
  fits AS MATERIALIZED (SELECT wts.*, alpha, mt - wa * ma - wb * mb - wc * mc AS w0 FROM wts JOIN mu USING (f) JOIN al USING (n))"""


TRAIN_IN = f"{PROSE}, prose_in AS MATERIALIZED (SELECT *, -1 AS fold FROM prose WHERE NOT is_test)"


@query("ridge_fit", f"""WITH {TRAIN_IN}, {ridge_sql('SELECT 0 AS n, 10.0::DOUBLE AS alpha')}
  SELECT feature, {rs('weight')} AS weight FROM (SELECT 'a' AS feature, wa AS weight FROM fits UNION ALL SELECT 'b', wb FROM fits
    UNION ALL SELECT 'c', wc FROM fits UNION ALL SELECT 'bias', w0 FROM fits)""")
def ridge_fit(spark, sf):
    m = prose_moments(spark, sf, center=True)[False]
    return linear.fit_ridge(m, 10.0).table(spark).withColumn("weight", r("weight"))


LAMBDAS = scalars.geomspace(0.01, 10.0, 500)
PATH = f"""{TRAIN_IN}, {ridge_sql('SELECT n, 0.01 * pow(1000.0::DOUBLE, n / 499.0::DOUBLE) AS alpha FROM range(500) AS g(n)')},
  path AS MATERIALIZED (SELECT n, alpha, sqrt(avg(pow(wa * a + wb * b + wc * c + w0 - t, 2))) AS rmse FROM fits, prose WHERE is_test GROUP BY n, alpha)"""


@query("ridge_path", f"WITH {PATH} SELECT {rs('alpha', 8)} AS alpha, {rs('rmse', 8)} AS rmse FROM path")
def ridge_path(spark, sf):
    m = prose_moments(spark, sf, center=True)
    rows = linear.ridge_path(m[False], m[True], LAMBDAS)
    return spark.createDataFrame(rows, "alpha double, rmse double").select(r("alpha", 8).alias("alpha"), r("rmse", 8).alias("rmse"))


@query("ridge_best", f"WITH {PATH} SELECT {rs('alpha')} AS alpha, {rs('rmse')} AS rmse FROM path ORDER BY round(rmse, 12), n LIMIT 1")
def ridge_best(spark, sf):
    m = prose_moments(spark, sf, center=True)
    best = linear.first_best([(a, round(v, 12)) for a, v in linear.ridge_path(m[False], m[True], LAMBDAS)])
    return spark.createDataFrame([best], "alpha double, rmse double").select(r("alpha").alias("alpha"), r("rmse").alias("rmse"))


def _sweep_sql(orders: int = 9) -> str:
    cols = [f"pow(x, {k}) - (SELECT avg(pow(x, {k})) FROM curve WHERE NOT is_test)" for k in range(1, orders + 1)]
    wide = ", ".join(f"{c} AS x{k}" for k, c in enumerate(cols))
    names = [f"x{k}" for k in range(orders)] + ["t0"]
    pred = " + ".join(f"coalesce(max(w) FILTER (i = {k}), 0) * x{k}" for k in range(orders))
    return f"""WITH {CURVE}, w AS MATERIALIZED (SELECT *, {wide}, t - (SELECT avg(t) FROM curve WHERE NOT is_test) AS t0 FROM curve),
  {b.moments_sql('w', names, 'NOT is_test')},
  aug AS MATERIALIZED (SELECT CAST(o AS INTEGER) AS k, i, j,
      CASE WHEN i < o AND (j < o OR j = {orders}) THEN v WHEN i = j THEN 1 ELSE 0 END AS v FROM m, range(1, {orders + 1}) AS g(o) WHERE i < {orders}),
  {b.solve_sql('aug', orders)},
  p AS (SELECT k, id, t0, {pred} AS y FROM sol, w WHERE is_test GROUP BY k, id, t0, {', '.join(names[:-1])})
  SELECT k AS "order", {rs('sqrt(avg(pow(y - t0, 2)))')} AS rmse FROM p GROUP BY k"""


@query("poly_order_sweep", _sweep_sql())
def poly_order_sweep(spark, sf):
    c = b.curve(spark, sf)
    rows = linear.order_sweep(c, F.col("x"), F.col("t"), F.col("is_test"), 9)
    return spark.createDataFrame(rows, "order int, rmse double").withColumn("rmse", r("rmse"))


ALPHAS = [0.0, 0.1, 1.0, 10.0, 100.0]
FOLD_IN = f"""{PROSE}, prose_in AS MATERIALIZED (SELECT *, CAST(floor({b.u(42, 'fold', 'id')} * 5) AS INTEGER) AS fold FROM prose)"""


@query("grid_search_ridge", f"""WITH {FOLD_IN}, {ridge_sql('SELECT unnest([0, 1, 2, 3, 4]) AS n, unnest([0.0::DOUBLE, 0.1::DOUBLE, 1.0::DOUBLE, 10.0::DOUBLE, 100.0::DOUBLE]) AS alpha', folds='SELECT unnest([0, 1, 2, 3, 4]) AS f')}
  SELECT alpha, CAST(f AS INTEGER) AS fold, {rs('sqrt(avg(pow(wa * a + wb * b + wc * c + w0 - t, 2)))')} AS rmse
  FROM fits JOIN prose_in p ON p.fold = fits.f GROUP BY alpha, f""")
def grid_search_ridge(spark, sf):
    """All alphas on all folds from one grouped scan."""
    folds = b.prose(spark, sf).withColumn("fold", F.floor(rng.uniform(42, "fold", "id") * 5).cast("int"))
    parts = linear.moments(folds, prose_columns("t"), by="fold", center=True)
    return spark.createDataFrame(linear.fold_grid(parts, ALPHAS), "alpha double, fold int, rmse double").withColumn("rmse", r("rmse"))


TRAIN_FOLDS = f"""{PROSE}, prose_in AS MATERIALIZED (SELECT *, CAST(floor({b.u(42, 'fold', 'id')} * 5) AS INTEGER) AS fold FROM prose WHERE NOT is_test)"""


@query("grid_search_ridge_refit", f"""WITH {TRAIN_FOLDS}, {ridge_sql('SELECT unnest([0, 1, 2, 3, 4]) AS n, unnest([0.0::DOUBLE, 0.1::DOUBLE, 1.0::DOUBLE, 10.0::DOUBLE, 100.0::DOUBLE]) AS alpha', folds='SELECT unnest([0, 1, 2, 3, 4, 5]) AS f')},
  scores AS (SELECT n, f, sqrt(avg(pow(wa * a + wb * b + wc * c + w0 - t, 2))) AS rmse FROM fits JOIN prose_in p ON p.fold = fits.f GROUP BY n, f),
  best AS (SELECT n, avg(rmse) AS cv FROM scores GROUP BY n ORDER BY round(avg(rmse), 12), n LIMIT 1)
  SELECT {rs('any_value(alpha)')} AS alpha, {rs('any_value(cv)')} AS cv_rmse, {rs('sqrt(avg(pow(wa * a + wb * b + wc * c + w0 - t, 2)))')} AS test_rmse
  FROM fits JOIN best USING (n), prose WHERE f = 5 AND is_test""")
def grid_search_ridge_refit(spark, sf):
    """The best alpha over the folds of the training rows, refitted on all of them and scored on the test rows: one scan."""
    fold = F.when(F.col("is_test"), F.lit(-1)).otherwise(F.floor(rng.uniform(42, "fold", "id") * 5).cast("int"))
    parts = linear.moments(b.prose(spark, sf).withColumn("fold", fold), prose_columns("t"), by="fold", center=True)
    test = parts.pop(-1)
    out = spark.createDataFrame([linear.grid_refit(parts, test, ALPHAS)], "alpha double, cv_rmse double, test_rmse double")
    return out.select(*[r(c).alias(c) for c in out.columns])


# ---- gradient descent -----------------------------------------------------------

def w0_sql(d: str, k: str = "0") -> str:
    return f"({b.u(42, 'weights', d, k)} * 0.2 - 0.1)"


BIASED = f"""{VEC}, row_info AS MATERIALIZED (SELECT DISTINCT id, label, is_test FROM vec),
  xb AS MATERIALIZED (SELECT id, d, x FROM vec UNION ALL SELECT id, 64, 1.0::DOUBLE FROM row_info)"""


def start_sql(classes: int) -> str:
    return f"w_0 AS MATERIALIZED (SELECT CAST(d AS INTEGER) AS d, CAST(c AS INTEGER) AS c, {w0_sql('d', 'c')} AS w FROM range(65) AS a(d), range({classes}) AS z(c))"


def step_sql(kind: str, n: int, rows: str, rate: float = 0.0) -> str:
    """CTEs: gradient `g_n` at `w_n` over the given rows, and the next weights."""
    if kind == "softmax":
        out = f"""y_{n} AS MATERIALIZED (SELECT id, c, e / sum(e) OVER (PARTITION BY id) - CAST(c = label AS INTEGER) AS res, e / sum(e) OVER (PARTITION BY id) AS p, label
          FROM (SELECT xb.id, w.c, r.label, exp(sum(x * w)) AS e FROM xb JOIN w_{n} w ON w.d = xb.d JOIN row_info r ON r.id = xb.id GROUP BY xb.id, w.c, r.label))"""
    else:
        out = f"""y_{n} AS MATERIALIZED (SELECT id, c, p - label % 2 AS res, p, label % 2 AS label
          FROM (SELECT xb.id, w.c, r.label, 1 / (1 + exp(-sum(x * w))) AS p FROM xb JOIN w_{n} w ON w.d = xb.d JOIN row_info r ON r.id = xb.id GROUP BY xb.id, w.c, r.label))"""
    out += f""", g_{n} AS MATERIALIZED (SELECT xb.d, y.c, avg(res * x) AS g FROM y_{n} y JOIN xb ON xb.id = y.id JOIN row_info r ON r.id = y.id WHERE {rows} GROUP BY xb.d, y.c)"""
    if rate:
        out += f", w_{n + 1} AS MATERIALIZED (SELECT d, c, w - {rate}::DOUBLE * g AS w FROM w_{n} JOIN g_{n} USING (d, c))"
    return out


@query("logistic_gradient", f"""WITH {BIASED}, {start_sql(1)}, {step_sql('logistic', 0, 'NOT is_test')}
  SELECT d AS feature, c AS class, {rs('g')} AS gradient FROM g_0""")
def logistic_gradient(spark, sf):
    v = b.vec(spark, sf).where("not is_test").withColumn("label", scalars.parity("label"))
    return gradient.gradient_table(spark, gradient.gradient(v, "logistic", gradient.initial_weights(DIM))).withColumn("gradient", r("gradient"))


@query("softmax_gradient", f"""WITH {BIASED}, {start_sql(10)}, {step_sql('softmax', 0, 'NOT is_test')}
  SELECT d AS feature, c AS class, {rs('g')} AS gradient FROM g_0""")
def softmax_gradient(spark, sf):
    v = b.vec(spark, sf).where("not is_test")
    return gradient.gradient_table(spark, gradient.gradient(v, "softmax", gradient.initial_weights(DIM, 10))).withColumn("gradient", r("gradient"))


PART_W = ", ".join(f"{b.u(42, 'weights', str(d), '0')} * 0.2 - 0.1 AS {n}" for d, n in enumerate(["wa", "wb", "wc", "w0"]))


@query("linear_gradient", f"""WITH {PROSE}, y AS (SELECT *, wa * a + wb * b + wc * c + w0 - t AS res FROM prose, (SELECT {PART_W}) WHERE NOT is_test)
  SELECT CAST(i AS INTEGER) AS feature, 0 AS class, {rs('avg(res * CASE i WHEN 0 THEN a WHEN 1 THEN b WHEN 2 THEN c ELSE 1 END)')} AS gradient FROM y, range(4) AS g(i) GROUP BY i""")
def linear_gradient(spark, sf):
    p = b.prose(spark, sf).where("not is_test").withColumn("features", F.array("a", "b", "c"))
    g = gradient.gradient(p, "linear", gradient.initial_weights(3), target="t")
    return gradient.gradient_table(spark, g).withColumn("gradient", r("gradient"))


EPOCHS, BATCHES, RATE, L2 = 4, 2, 0.1, 0.01


def batch_sql(epoch: int, batches: int, key: str = "id") -> str:
    return f"CAST(floor({b.u(42, 'batch', str(epoch), key)} * {batches}) AS INTEGER)"


def _linear_gd_sql() -> str:
    ctes = [PROSE, f"w_0 AS MATERIALIZED (SELECT {PART_W})"]
    n, marks = 0, []
    for e in range(EPOCHS):
        for k in range(BATCHES):
            step = ", ".join(f"any_value({w}) - {RATE}::DOUBLE * (avg(res * {x}) + {L2}::DOUBLE * any_value({w})) AS {w}"
                             for w, x in (("wa", "a"), ("wb", "b"), ("wc", "c"), ("w0", "1")))
            ctes.append(f"""w_{n + 1} AS MATERIALIZED (SELECT {step} FROM (SELECT *, wa * a + wb * b + wc * c + w0 - t AS res
              FROM prose, w_{n} WHERE NOT is_test AND {batch_sql(e, BATCHES)} = {k}))""")
            n += 1
        marks.append(f"SELECT {e + 1} AS epoch, is_test, sqrt(avg(pow(wa * a + wb * b + wc * c + w0 - t, 2))) AS rmse FROM prose, w_{n} GROUP BY is_test")
    return "WITH " + ",\n".join(ctes) + f", curve AS MATERIALIZED ({' UNION ALL '.join(marks)}), final AS (SELECT * FROM w_{n}) "


def _linear_gd(spark, sf):
    p = b.prose(spark, sf).withColumn("features", F.array("a", "b", "c"))
    return gradient.fit(p, "linear", 3, EPOCHS, RATE, BATCHES, L2, target="t")


@query("linear_gd", _linear_gd_sql() + f"""SELECT CAST(i AS INTEGER) AS feature, 0 AS class,
  {rs('CASE i WHEN 0 THEN wa WHEN 1 THEN wb WHEN 2 THEN wc ELSE w0 END')} AS weight FROM final, range(4) AS g(i)""")
def linear_gd(spark, sf):
    w, _ = _linear_gd(spark, sf)
    return gradient.gradient_table(spark, w, "weight").withColumn("weight", r("weight"))


@query("learning_curve", _linear_gd_sql() + f"SELECT epoch, is_test, {rs('rmse')} AS loss FROM curve")
def learning_curve(spark, sf):
    _, curve = _linear_gd(spark, sf)
    return spark.createDataFrame([(e, t, v) for e, t, v, _ in curve], "epoch int, is_test boolean, loss double").withColumn("loss", r("loss"))


def _gd_sql(kind: str, classes: int, epochs: int, batches: int, rate: float) -> str:
    ctes, n, marks = [BIASED, start_sql(classes)], 0, []
    for e in range(epochs):
        for k in range(batches):
            rows = "NOT is_test" if batches == 1 else f"NOT is_test AND {batch_sql(e, batches, 'r.id')} = {k}"
            ctes.append(step_sql(kind, n, rows, rate))
            n += 1
        marks.append((e + 1, n))
    last = step_sql(kind, n, "FALSE")
    ctes.append(last)
    hits = "max(CAST(abs(p - label) <= 0.5 AS INTEGER))" if kind == "logistic" else "max(CASE WHEN p = m THEN CAST(c = label AS INTEGER) ELSE 0 END)"
    loss = "max(-label * ln(p) - (1 - label) * ln(1 - p))" if kind == "logistic" else "max(CASE WHEN c = label THEN -ln(p) END)"
    curve = " UNION ALL ".join(f"""SELECT {e} AS epoch, is_test, avg(loss) AS loss, avg(hit) AS accuracy FROM (
        SELECT id, {loss} AS loss, {hits} AS hit FROM (SELECT *, max(p) OVER (PARTITION BY id) AS m FROM y_{k}) GROUP BY id) JOIN row_info USING (id) GROUP BY is_test""" for e, k in marks)
    return "WITH " + ",\n".join(ctes) + f", curve AS ({curve}), final AS (SELECT * FROM w_{n}) "


def _weights_query(spark, w):
    return gradient.gradient_table(spark, w, "weight").withColumn("weight", r("weight"))


def _curve_query(spark, curve):
    out = spark.createDataFrame(curve, "epoch int, is_test boolean, loss double, accuracy double")
    return out.withColumn("loss", r("loss")).withColumn("accuracy", r("accuracy"))


def _logistic(spark, sf):
    v = b.vec(spark, sf).withColumn("label", scalars.parity("label"))
    return gradient.fit(v, "logistic", DIM, 2, 0.5, 2)


def _softmax(spark, sf):
    return gradient.fit(b.vec(spark, sf), "softmax", DIM, 3, 0.5, 1, classes=10)


FINAL = f"SELECT d AS feature, c AS class, {rs('w')} AS weight FROM final"
CURVE_ROWS = f"SELECT epoch, is_test, {rs('loss')} AS loss, {rs('accuracy')} AS accuracy FROM curve"


@query("logistic_gd", _gd_sql("logistic", 1, 2, 2, 0.5) + FINAL)
def logistic_gd(spark, sf):
    return _weights_query(spark, _logistic(spark, sf)[0])


@query("logistic_curve", _gd_sql("logistic", 1, 2, 2, 0.5) + CURVE_ROWS)
def logistic_curve(spark, sf):
    return _curve_query(spark, _logistic(spark, sf)[1])


@query("softmax_gd", _gd_sql("softmax", 10, 3, 1, 0.5) + FINAL)
def softmax_gd(spark, sf):
    return _weights_query(spark, _softmax(spark, sf)[0])


@query("softmax_curve", _gd_sql("softmax", 10, 3, 1, 0.5) + CURVE_ROWS)
def softmax_curve(spark, sf):
    return _curve_query(spark, _softmax(spark, sf)[1])


@query("softmax_local")
def softmax_local(spark, sf):
    """Tiny batches inside hash shards, weights averaged after each epoch."""
    v = b.vec(spark, sf)
    w = gradient.fit_local(v.where("not is_test"), "softmax", DIM, 2, 0.05, 5, shards=4, classes=10)
    return gradient.predict(v.where("is_test"), "softmax", w).select("id", "prediction")


ROUNDS = 30
PERCEPTRON = f"""WITH RECURSIVE {GRADED}, st(n, wa, wb, wc, w0) AS (
    SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE
    UNION ALL SELECT n + 1, wa + p.t * p.a, wb + p.t * p.b, wc + p.t * p.c, w0 + p.t FROM (
      SELECT n, wa, wb, wc, w0, arg_min(struct_pack(a := a, b := b, c := c, t := t), struct_pack(h := CAST('0x' || substr(md5('42:round' || n || ':' || id), 1, 8) AS BIGINT), id := id)) AS p
      FROM st JOIN graded ON t * (w0 + a * wa + b * wb + c * wc) <= 0 WHERE n < {ROUNDS} GROUP BY n, wa, wb, wc, w0)),
  final AS (SELECT * FROM st ORDER BY n DESC LIMIT 1)
  SELECT {NAMES}, {rs('CASE i WHEN 0 THEN wa WHEN 1 THEN wb WHEN 2 THEN wc ELSE w0 END')} AS weight, n AS rounds,
    NOT EXISTS (SELECT 1 FROM graded, final f WHERE t * (f.w0 + a * f.wa + b * f.wb + c * f.wc) <= 0) AS done
  FROM final, range(4) AS g(i)"""


@query("perceptron", PERCEPTRON)
def perceptron(spark, sf):
    """Rounds over the graded documents, which no plane need separate: `done` says whether one was found."""
    w, rounds, done = gradient.perceptron(b.graded(spark, sf), ["a", "b", "c"], "t", max_rounds=ROUNDS)
    rows = [(name, float(v), rounds, done) for name, v in zip(["a", "b", "c", "bias"], w)]
    return spark.createDataFrame(rows, "feature string, weight double, rounds int, done boolean").withColumn("weight", r("weight"))


# ---- naive Bayes ----------------------------------------------------------------

PRIOR = "prior AS (SELECT label AS class, ln(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE)) AS lp FROM pix WHERE NOT is_test AND d = 0 GROUP BY label)"


def _nb_sql(model: str, term: str) -> str:
    return f"""WITH {PIX}, {PRIOR}, model AS MATERIALIZED ({model}),
  s AS (SELECT id, class, sum({term}) AS v FROM pix JOIN model USING (d) WHERE is_test GROUP BY id, class)
  SELECT id, arg_max(class, struct_pack(a := v + lp, b := -class)) AS prediction, {rs('max(v + lp)')} AS score FROM s JOIN prior USING (class) GROUP BY id"""


def _register_bayes(kind: str, sql: str):
    @query(f"nb_{kind}", sql)
    def fitted(spark, sf):
        p = b.pixels(spark, sf)
        model = bayes.fit(p.where("not is_test"), DIM, kind, 0.1)
        return model.transform(p.where("is_test")).select("id", "prediction", r("score").alias("score"))


_register_bayes("gaussian", _nb_sql("SELECT label AS class, d, avg(x) AS m, var_pop(x) + 0.1 AS v FROM pix WHERE NOT is_test GROUP BY label, d",
                                    "-0.5 * ln(2 * pi() * model.v) - pow(x - m, 2) / (2 * model.v)"))
_register_bayes("bernoulli", _nb_sql("SELECT label AS class, d, (count(*) FILTER (x >= 8) + 0.1::DOUBLE) / (count(*) + 0.2::DOUBLE) AS p FROM pix WHERE NOT is_test GROUP BY label, d",
                                     "CASE WHEN x >= 8 THEN ln(p / (1 - p)) ELSE 0 END + ln(1 - p)"))
_register_bayes("multinomial", _nb_sql("SELECT class, d, (n + 0.1::DOUBLE) / (sum(n) OVER (PARTITION BY class) + 6.4::DOUBLE) AS p FROM (SELECT label AS class, d, sum(x) AS n FROM pix WHERE NOT is_test GROUP BY label, d)",
                                       "x * ln(p)"))


# ---- clusters -------------------------------------------------------------------

def _kmeans_sql(k: int, iterations: int) -> str:
    ctes = [VEC, f"""c_0 AS MATERIALIZED (SELECT CAST(n AS INTEGER) AS c, d, x AS m FROM vec JOIN (
        SELECT vec_id, row_number() OVER (ORDER BY {b.h32(42, 'init', 'vec_id')}, vec_id) - 1 AS n FROM embeddings) ON vec_id = id WHERE n < {k})"""]
    for i in range(iterations):
        ctes.append(f"""a_{i} AS MATERIALIZED (SELECT id, arg_min(c, struct_pack(v := v, c := c)) AS cluster, min(v) AS v FROM (
          SELECT id, c, round(sqrt(sum((x - m) * (x - m))), 12) AS v FROM vec JOIN c_{i} USING (d) GROUP BY id, c) GROUP BY id)""")
        ctes.append(f"""c_{i + 1} AS MATERIALIZED (SELECT o.c, o.d, coalesce(n.m, o.m) AS m FROM c_{i} o LEFT JOIN (
          SELECT cluster AS c, d, avg(x) AS m FROM vec JOIN a_{i} USING (id) GROUP BY cluster, d) n ON n.c = o.c AND n.d = o.d)""")
    return "WITH " + ",\n".join(ctes) + f" SELECT id, cluster, {rs('v')} AS distance FROM a_{iterations - 1}"


@query("kmeans", _kmeans_sql(5, 6))
def kmeans(spark, sf):
    v = b.vec(spark, sf)
    _, centers = cluster.random_init(v, 5)
    assigned, _, _ = cluster.kmeans(v, centers, 6)
    return assigned.select("id", "cluster", r("distance").alias("distance"))


def _pp_sql(k: int) -> str:
    ctes = [VEC, f"c_0 AS MATERIALIZED (SELECT vec_id AS id FROM embeddings ORDER BY {b.h32(42, 'init', 'vec_id')}, vec_id LIMIT 1)"]
    chosen = "SELECT 0 AS n, id FROM c_0"
    for n in range(1, k):
        ctes.append(f"""c_{n} AS MATERIALIZED (SELECT id FROM (SELECT id, pow(min(v), 2) AS d2 FROM (
            SELECT q.id, t.id AS tid, round(sqrt(sum((q.x - t.x) * (q.x - t.x))), 12) AS v FROM vec q JOIN vec t ON q.d = t.d
            WHERE t.id IN (SELECT id FROM ({chosen})) GROUP BY q.id, t.id) GROUP BY id) WHERE d2 > 0
          ORDER BY -ln(({b.h32(42, 'race', str(n), 'id')} + 0.5::DOUBLE) / 4294967296.0::DOUBLE) / d2, id LIMIT 1)""")
        chosen += f" UNION ALL SELECT {n}, id FROM c_{n}"
    return "WITH " + ",\n".join(ctes) + " " + chosen


@query("kmeans_pp_init", _pp_sql(5))
def kmeans_pp_init(spark, sf):
    ids, _ = cluster.plus_plus_init(b.vec(spark, sf), 5)
    return spark.createDataFrame(list(enumerate(ids)), "n int, id bigint")


# ---- kernel regression ------------------------------------------------------------

K_STEPS, K_RATE, K_L2 = 3, 0.5, 0.01


def _kernel_sql(steps: int) -> str:
    ctes = [CURVE, "bias AS MATERIALIZED (SELECT avg(t) AS b FROM curve WHERE NOT is_test)",
            "tr AS MATERIALIZED (SELECT id, x, t FROM curve WHERE NOT is_test)", "be_0 AS MATERIALIZED (SELECT id, 0.0::DOUBLE AS beta FROM tr)"]
    marks = []
    for n in range(steps + 1):
        # Training rows share few x values, so kernel sums group them by x first.
        ctes.append(f"s_{n} AS MATERIALIZED (SELECT x, sum(beta) AS beta FROM tr JOIN be_{n} USING (id) GROUP BY x)")
        ctes.append(f"y_{n} AS MATERIALIZED (SELECT q.x, sum(s.beta * exp(-pow(q.x - s.x, 2))) AS y FROM (SELECT DISTINCT x FROM curve) q, s_{n} s GROUP BY q.x)")
        if n:
            marks.append(f"SELECT {n} AS iteration, is_test, sqrt(avg(pow(y + b - t, 2))) AS rmse FROM curve JOIN y_{n} USING (x), bias GROUP BY is_test")
        if n < steps:
            ctes.append(f"""be_{n + 1} AS MATERIALIZED (SELECT tr.id, beta - {K_RATE}::DOUBLE / (SELECT count(*) FROM tr) * (y - t + b) - {K_RATE * K_L2}::DOUBLE * beta AS beta
              FROM tr JOIN be_{n} USING (id) JOIN y_{n} USING (x), bias)""")
    return "WITH " + ",\n".join(ctes) + f", marks AS ({' UNION ALL '.join(marks)}) "


def _kernel_regression(spark, sf):
    c = b.curve(spark, sf).withColumn("features", F.array("x")).withColumnRenamed("t", "target").withColumn("batch", F.lit(0))
    fmap = kernels.FeatureMap.build("rbf", 1, gamma=1.0, radius=1.0)
    return c, *kernels.fit_regression(c, fmap, K_STEPS, K_RATE, K_L2)


@query("kernel_regression", _kernel_sql(K_STEPS) + f"SELECT iteration, is_test, {rs('rmse')} AS rmse FROM marks")
def kernel_regression(spark, sf):
    _, _, curve = _kernel_regression(spark, sf)
    return spark.createDataFrame(curve, "iteration int, is_test boolean, rmse double").withColumn("rmse", r("rmse"))


@query("kernel_dual", _kernel_sql(K_STEPS) + f"SELECT id, {rs('beta', 9)} AS beta FROM be_{K_STEPS}")
def kernel_dual(spark, sf):
    c, model, _ = _kernel_regression(spark, sf)
    return model.betas(c.where("not is_test"), "target").select("id", r("beta", 9).alias("beta"))


# ---- pyspark.ml estimators ----------------------------------------------------------

def _parity(spark, sf):
    return b.vec(spark, sf).withColumn("label", scalars.parity("label"))


@query("svm_fit")
def svm_fit(spark, sf):
    v = _parity(spark, sf)
    train = v.where("not is_test")
    return ensembles.svm(train).fit(train).transform(v.where("is_test")).select("id", "prediction")


@query("svm_multiclass")
def svm_multiclass(spark, sf):
    v = b.vec(spark, sf)
    train = v.where("not is_test")
    return ensembles.svm_multiclass(train, 4, degree=3, max_iter=5).fit(train).transform(v.where("is_test")).select("id", "prediction")


@query("logistic_fit")
def logistic_fit(spark, sf):
    v = b.vec(spark, sf)
    train = v.where("not is_test")
    model = ensembles.scaled_logistic(train).fit(train)
    return model.transform(v.where("is_test")).select("id", "prediction")


GRID_C = scalars.geomspace(0.001, 1000.0, 12)


@query("grid_search_logistic")
def grid_search_logistic(spark, sf):
    """12 penalties x 5 folds on all columns, each refitted on all training rows and scored on the test rows."""
    v = _parity(spark, sf)
    folded = sampling.stratified_folds(v.where("not is_test").select("id", "features", "label"), "id", "label", 5)
    scaler = ft.ScaleArray("features", "scaled", "min_max").fit(folded)
    rows, best = newton.grid_search(scaler.transform(folded), scaler.transform(v.where("is_test")), DIM, GRID_C, 5, features="scaled")
    out = spark.createDataFrame([(i, *row, row is best) for i, row in enumerate(rows)],
                                "combination int, c double, accuracy double, loss double, test_accuracy double, best boolean")
    return out.select("combination", "best", *[r(c).alias(c) for c in ("c", "accuracy", "loss", "test_accuracy")])


PATH_C, PATH_FOLDS, PATH_DIM, PATH_STEPS = [0.01, 1.0, 100.0], 3, 4, 8


def _path_sql() -> str:
    """Newton steps for every (penalty, fold) at once; model k is penalty k // 10 without fold k % 10."""
    models = ", ".join(f"({n * 10 + f}, {c}::DOUBLE, {f})" for n, c in enumerate(PATH_C) for f in range(PATH_FOLDS + 1))
    ctes = [VEC, f"ma(k, c, f) AS (VALUES {models})",
            f"""ro AS MATERIALIZED (SELECT id, label % 2 AS t, CAST(floor({b.u(42, 'fold', 'id')} * {PATH_FOLDS}) AS INTEGER) AS fold FROM (SELECT DISTINCT id, label FROM vec))""",
            f"xs AS MATERIALIZED (SELECT id, d, x FROM vec WHERE d < {PATH_DIM} UNION ALL SELECT id, {PATH_DIM}, 1.0::DOUBLE FROM ro)",
            f"w_0 AS MATERIALIZED (SELECT k, CAST(d AS INTEGER) AS i, 0.0::DOUBLE AS w FROM ma, range({PATH_DIM + 1}) AS g(d))"]
    for n in range(PATH_STEPS):
        ctes.append(f"""p_{n} AS MATERIALIZED (SELECT k, c, id, t, 1 / (1 + exp(-z)) AS p FROM (
            SELECT ma.k, any_value(c) AS c, ro.id, any_value(t) AS t, sum(x * w) AS z FROM ma JOIN ro ON ro.fold <> ma.f
            JOIN xs ON xs.id = ro.id JOIN w_{n} w ON w.k = ma.k AND w.i = xs.d GROUP BY ma.k, ro.id))""")
        ctes.append(f"""h_{n} AS MATERIALIZED (SELECT k, i, j, v + CASE WHEN i = j AND i < {PATH_DIM} THEN 1 ELSE 0 END AS v FROM (
            SELECT k, a.d AS i, b.d AS j, any_value(c) * sum(p * (1 - p) * a.x * b.x) AS v FROM p_{n} JOIN xs a USING (id) JOIN xs b USING (id) GROUP BY k, a.d, b.d)
          UNION ALL SELECT k, i, {PATH_DIM + 1}, g + CASE WHEN i < {PATH_DIM} THEN w ELSE 0 END FROM (
            SELECT k, d AS i, any_value(c) * sum((p - t) * x) AS g FROM p_{n} JOIN xs USING (id) GROUP BY k, d) JOIN w_{n} USING (k, i))""")
        ctes.append(b.solve_sql(f"h_{n}", PATH_DIM + 1, f"d_{n}", f"e{n}_"))
        ctes.append(f"w_{n + 1} AS MATERIALIZED (SELECT k, i, o.w - d.w AS w FROM w_{n} o JOIN d_{n} d USING (k, i))")
    return "WITH " + ",\n".join(ctes) + f""" SELECT c, CAST(CASE f WHEN {PATH_FOLDS} THEN -1 ELSE f END AS INTEGER) AS fold, CAST(i AS INTEGER) AS feature,
      {rs('w')} AS weight FROM w_{PATH_STEPS} JOIN ma USING (k)"""


@query("logistic_path", _path_sql())
def logistic_path(spark, sf):
    """Penalties x (folds and the fit on all rows) on the first four columns: the optimum of each."""
    v = _parity(spark, sf).withColumn("features", vectors.prefix("features", PATH_DIM))
    v = v.withColumn("fold", F.floor(rng.uniform(42, "fold", "id") * PATH_FOLDS).cast("int"))
    models = newton.fit_many(v, PATH_DIM, PATH_C, [*range(PATH_FOLDS), newton.ALL])
    rows = [(m.c, m.fold, i, float(w)) for m in models for i, w in enumerate(m.w)]
    return spark.createDataFrame(rows, "c double, fold int, feature int, weight double").withColumn("weight", r("weight"))


@query("mlp_text")
def mlp_text(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").withColumn("is_test", b.is_test("doc_id"))
    model = ensembles.fit_text_mlp(d.where("not is_test").withColumn("label", F.col("toxic").cast("double")), max_iter=20)
    return model.transform(d.where("is_test")).select("doc_id", "prediction")


def event_rows(spark, sf):
    """(id, label, features[3], is_test): value, hour and part of the user's number of an event, its type."""
    return table(spark, sf, "events").select(
        F.col("event_id").alias("id"), scalars.label_index("event_type", b.EVENT_TYPES).alias("label"),
        F.array(F.col("value").cast("double"), F.hour("ts").cast("double"), (F.col("user_id") % 100).cast("double")).alias("features"),
        b.is_test("event_id").alias("is_test"))


BOOST_ROUNDS = 500


@query("gbt_multiclass")
def gbt_multiclass(spark, sf):
    e = event_rows(spark, sf)
    model = boosting.fit(e.where("not is_test"), 3, len(b.EVENT_TYPES), rounds=BOOST_ROUNDS)
    return model.transform(e.where("is_test")).select("id", F.col("prediction").cast("double").alias("prediction"))


STUMP_BINS = 16


@query("boosted_stump", f"""WITH e AS MATERIALIZED (SELECT {' '.join(['CASE event_type', *[f"WHEN '{t}' THEN {i}" for i, t in enumerate(b.EVENT_TYPES)], 'END'])} AS y,
    CAST(value AS DOUBLE) AS x0, CAST(hour(ts) AS DOUBLE) AS x1, CAST(user_id % 100 AS DOUBLE) AS x2 FROM events),
  x AS MATERIALIZED (SELECT y, 0 AS j, x0 AS x FROM e UNION ALL SELECT y, 1, x1 FROM e UNION ALL SELECT y, 2, x2 FROM e),
  edges AS MATERIALIZED (SELECT j, i, lo + (hi - lo) * i / {STUMP_BINS}.0::DOUBLE AS edge FROM (SELECT j, min(x) AS lo, max(x) AS hi FROM x GROUP BY j), range(1, {STUMP_BINS}) AS g(i)),
  n AS MATERIALIZED (SELECT y, count(*) AS n, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS p FROM e GROUP BY y),
  gh AS MATERIALIZED (SELECT k.y AS k, n.y AS y, n.n AS n, CAST(round((k.p - CASE WHEN k.y = n.y THEN 1 ELSE 0 END) * {boosting.SCALE}) AS BIGINT) AS g,
    CAST(round(k.p * (1 - k.p) * {boosting.SCALE}) AS BIGINT) AS h FROM n k, n),
  lefts AS MATERIALIZED (SELECT j, i, edge, y, count(*) AS c FROM x JOIN edges USING (j) WHERE x <= edge GROUP BY j, i, edge, y),
  sums AS MATERIALIZED (SELECT k, j, i, edge, CAST(sum(c * g) AS DOUBLE) / {boosting.SCALE} AS lg, CAST(sum(c * h) AS DOUBLE) / {boosting.SCALE} AS lh FROM lefts JOIN gh USING (y) GROUP BY k, j, i, edge),
  total AS (SELECT k, CAST(sum(n * g) AS DOUBLE) / {boosting.SCALE} AS g, CAST(sum(n * h) AS DOUBLE) / {boosting.SCALE} AS h FROM gh GROUP BY k),
  gains AS (SELECT k, j, i, edge, lg, lh, g - lg AS rg, h - lh AS rh, lg * lg / (lh + 1) + (g - lg) * (g - lg) / (h - lh + 1) - g * g / (h + 1) AS gain
    FROM sums JOIN total USING (k) WHERE lh > 0 AND h - lh > 0)
SELECT CAST(k AS INTEGER) AS class, CAST(j AS INTEGER) AS feature, {rs('edge')} AS threshold, {rs('-lg / (lh + 1)')} AS left_value, {rs('-rg / (rh + 1)')} AS right_value
  FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY gain DESC, j, i) AS place FROM gains WHERE gain > 1e-9) WHERE place = 1""")
def boosted_stump(spark, sf):
    e = event_rows(spark, sf)
    ends = e.agg(*[f(F.get("features", F.lit(j))).alias(f"{f.__name__}{j}") for j in range(3) for f in (F.min, F.max)]).first()
    edges = [[low + (high - low) * i / STUMP_BINS for i in range(1, STUMP_BINS)] for low, high in zip(ends[::2], ends[1::2])]
    found = boosting.fit(e, 3, len(b.EVENT_TYPES), rounds=1, depth=1, bins=STUMP_BINS, edges=edges).table(spark)
    value = lambda node: F.max(F.when(F.col("node") == node, F.col("value")))
    return (found.groupBy("class").agg(F.max("feature").alias("feature"), r(F.max("threshold")).alias("threshold"), r(value(1)).alias("left_value"),
                                       r(value(2)).alias("right_value")).where("feature is not null"))


# ---- resampling -----------------------------------------------------------------

SAMPLES = 100
BETAS = scalars.linspace(0.0, 2.0, 201)
_TIMES = " ".join(f"+ CAST(uu >= {t!r}::DOUBLE AS INTEGER)" for t in rng.poisson1_thresholds())
BOOT = f"""{EDITS}, lanes AS MATERIALIZED (SELECT edits.*, CAST(g AS INTEGER) AS g, md5(concat_ws(':', '42', 'bootstrap', CAST(g AS VARCHAR), CAST(doc_id AS VARCHAR))) AS h
    FROM edits, range({SAMPLES // 4}) AS r(g)),
  draws AS (SELECT *, CAST(g * 4 + l AS INTEGER) AS sample, CAST('0x' || substr(h, CAST(l * 8 + 1 AS INTEGER), 8) AS BIGINT) / 4294967296.0::DOUBLE AS uu FROM lanes, range(4) AS z(l)),
  boot AS MATERIALIZED (SELECT sample, CAST(sum(n * correct) AS BIGINT) AS tp, CAST(sum(n * (predicted - correct)) AS BIGINT) AS fp,
    CAST(sum(n * (gold - correct)) AS BIGINT) AS fn, CAST(sum(n * rating) AS DOUBLE) / sum(n) AS rating
    FROM (SELECT *, 0 {_TIMES} AS n FROM draws) WHERE n > 0 GROUP BY sample)"""
CORR = f"""{BOOT}, grid AS (SELECT CAST(i AS INTEGER) AS i, 2.0::DOUBLE * i / 200 AS beta FROM range(201) AS g(i)),
  corrs AS MATERIALIZED (SELECT i, beta, corr((tp + beta * beta * tp) / (tp + fp + beta * beta * (tp + fn)), rating) AS correlation FROM boot, grid GROUP BY i, beta)"""


def _samples(spark, sf):
    return resampling.bootstrap_counts(edits(spark, sf), "doc_id", SAMPLES, EDIT_COLUMNS)


@query("bootstrap_counts", f"WITH {BOOT} SELECT sample, tp, fp, fn, {rs('rating')} AS rating FROM boot")
def bootstrap_counts(spark, sf):
    return _samples(spark, sf).withColumn("rating", r("rating"))


@query("bootstrap_exact", f"""WITH {EDITS}, ranked AS (SELECT *, row_number() OVER (ORDER BY {b.h32(42, 'bootstrap-rank', 'doc_id')}, doc_id) - 1 AS k FROM edits),
  n AS (SELECT count(*) AS n FROM edits),
  draws AS (SELECT CAST(i // n AS INTEGER) AS sample, CAST(floor({b.u(42, 'draw', 'i')} * n) AS BIGINT) AS k FROM n, (SELECT unnest(range(10 * (SELECT n FROM n))) AS i))
  SELECT sample, CAST(sum(correct) AS BIGINT) AS tp, CAST(sum(predicted - correct) AS BIGINT) AS fp, CAST(sum(gold - correct) AS BIGINT) AS fn,
    {rs('avg(rating)')} AS rating FROM draws JOIN ranked USING (k) GROUP BY sample""")
def bootstrap_exact(spark, sf):
    out = resampling.bootstrap_counts(edits(spark, sf), "doc_id", 10, EDIT_COLUMNS, exact=True)
    return out.withColumn("rating", r("rating"))


@query("fbeta_correlation", f"WITH {CORR} SELECT {rs('beta')} AS beta, {rs('correlation')} AS correlation FROM corrs")
def fbeta_correlation(spark, sf):
    out = resampling.f_beta_correlations(_samples(spark, sf), BETAS)
    return out.select(r("beta").alias("beta"), r("correlation").alias("correlation"))


@query("fbeta_best", f"WITH {CORR} SELECT {rs('beta')} AS beta, {rs('correlation')} AS correlation FROM corrs ORDER BY round(correlation, 9) DESC, i LIMIT 1")
def fbeta_best(spark, sf):
    scores = resampling.f_beta_correlations(_samples(spark, sf), BETAS).withColumn("correlation", r("correlation", 9))
    best = metrics.best_by(scores, "beta", "correlation", lowest=False)
    return best.select(r("beta").alias("beta"), r("correlation").alias("correlation"))
