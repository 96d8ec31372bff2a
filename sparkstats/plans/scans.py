"""Scans, sinks, model storage and column logic."""

from pyspark.ml import Pipeline
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from ..functions import scalars, vectors
from ..operators import cluster, features as ft, gradient, linear, sampling
from ..sources import models, tables
from . import base as b
from .base import GRADED, PARTS, PIX, PROSE, VEC, long_rows, query, r, rs, table

ONE_LINE = "translate({}, chr(10) || chr(13) || chr(9), '   ')"


@query("scan_lines", r"""SELECT doc_id, CAST(n - 1 AS INTEGER) AS line_no, line FROM (
  SELECT doc_id, generate_subscripts(l, 1) AS n, unnest(l) AS line
  FROM (SELECT doc_id, string_split(regexp_replace(text, '^\x{FEFF}', ''), chr(10)) AS l FROM documents))""")
def scan_lines(spark, sf):
    return tables.lines_of(table(spark, sf, "documents"), "doc_id", "text")


@query("join_lines", r"SELECT doc_id, regexp_replace(text, '^\x{FEFF}', '') AS text FROM documents")
def join_lines(spark, sf):
    lines = tables.lines_of(table(spark, sf, "documents"), "doc_id", "text")
    return tables.join_lines(lines, "doc_id", "line_no", "line")


@query("scan_tsv", f"SELECT quality AS label, {ONE_LINE.format('text')} AS text FROM documents JOIN labels USING (doc_id)")
def scan_tsv(spark, sf):
    flat = F.translate("text", "\n\r\t", "   ")
    rows = tables.corpus(table(spark, sf, "documents"), table(spark, sf, "labels"))
    path = models.new_path(spark, "tsv")
    rows.select(F.concat_ws("\t", F.col("quality").cast("string"), flat).alias("value")).write.text(path)
    return tables.read_labelled_tsv(spark, path)


@query("scan_csv", "SELECT p_partkey, p_name, p_brand, p_size, p_retailprice FROM part")
def scan_csv(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice")
    path = models.new_path(spark, "csv")
    rows.write.csv(path, header=True)
    return tables.read_csv(spark, path, "p_partkey bigint, p_name string, p_brand string, p_size int, p_retailprice double")


@query("scan_features", f"WITH {VEC} SELECT id, label, d, x FROM vec")
def scan_features(spark, sf):
    return long_rows(b.vec(spark, sf), "id", "label", digits=None)


@query("scan_corpus", """SELECT doc_id, text, lang, quality, toxic, CASE quality WHEN 1 THEN 'good' ELSE 'poor' END AS name
  FROM documents JOIN labels USING (doc_id)""")
def scan_corpus(spark, sf):
    names = spark.createDataFrame([(0, "poor"), (1, "good")], "quality int, name string")
    out = tables.corpus(table(spark, sf, "documents"), table(spark, sf, "labels"), names, label="quality")
    return out.select("doc_id", "text", "lang", "quality", "toxic", "name")


@query("optional_target", """SELECT 'labelled' AS source, event_id, value, event_type AS target FROM events
  UNION ALL SELECT 'unlabelled', event_id, value, NULL FROM events""")
def optional_target(spark, sf):
    events = table(spark, sf, "events").select("event_id", "value", "event_type")
    parts = []
    for name, df in (("labelled", events), ("unlabelled", events.drop("event_type"))):
        data, target = tables.split_target(df, "event_type")
        target = F.lit(None).cast("string") if target is None else target
        parts.append(df.select(F.lit(name).alias("source"), "event_id", "value", target.alias("target")))
    return parts[0].unionAll(parts[1])


def prose_columns(target: str | None = None) -> dict:
    return {n: F.col(n) for n in ["a", "b", "c"] + ([target] if target else [])}


PROSE_SOLVE = (PROSE + ", " + b.moments_sql("prose", ["a", "b", "c", "1.0", "t"], "NOT is_test")
              + ", aug AS MATERIALIZED (SELECT * FROM m WHERE i < 4), " + b.solve_sql("aug", 4))
PROSE_WEIGHTS = "(SELECT max(w) FILTER (i = 0) AS wa, max(w) FILTER (i = 1) AS wb, max(w) FILTER (i = 2) AS wc, max(w) FILTER (i = 3) AS w0 FROM sol)"


@query("batch_score", f"WITH {PROSE_SOLVE} SELECT id, {rs('wa * a + wb * b + wc * c + w0')} AS prediction FROM prose, {PROSE_WEIGHTS} WHERE is_test")
def batch_score(spark, sf):
    """Fit, store the model as a table, load it and score rows without a label."""
    p = b.prose(spark, sf)
    fitted = linear.fit_normal(linear.moments(p.where("not is_test"), prose_columns("t")))
    path = models.new_path(spark, "linear")
    models.save_table(fitted.table(spark), path)
    loaded = linear.LinearModel.from_table(models.load_table(spark, path))
    rows = p.where("is_test").drop("t")
    return rows.select("id", r(loaded.predict(prose_columns())).alias("prediction"))


@query("model_roundtrip")
def model_roundtrip(spark, sf):
    """Feature steps and estimator saved as one artefact, loaded, scored."""
    p = b.prose(spark, sf, "lang")
    steps = [ft.ColumnTransform([("one_hot", ["lang"]), ("standard", ["a", "b"])], "features"),
             ft.PolyExpand("features", "poly", 2), ft.ToVector("poly", "vector"),
             LinearRegression(featuresCol="vector", labelCol="t", regParam=0.01, maxIter=50)]
    path = models.new_path(spark, "pipeline")
    models.save_pipeline(Pipeline(stages=steps).fit(p.where("not is_test")), path)
    return models.score(models.load_pipeline(path), p.where("is_test"), "id").withColumn("prediction", r("prediction"))


@query("column_groups", """SELECT p_partkey AS id, CAST(d AS INTEGER) AS d, x FROM (
  SELECT p_partkey, 0 AS d, CAST(p_size AS DOUBLE) AS x FROM part UNION ALL
  SELECT p_partkey, 1, p_retailprice FROM part UNION ALL SELECT p_partkey, 2, CAST(p_size AS DOUBLE) FROM part)""")
def column_groups(spark, sf):
    model = ft.ColumnTransform([("pass", ["p_size"]), ("pass", ["p_retailprice", "p_size"])]).fit(table(spark, sf, "part"))
    out = model.transform(table(spark, sf, "part"))
    return long_rows(out.select(F.col("p_partkey").alias("id"), "features"), "id", digits=None)


@query("label_encode", """SELECT event_id, CAST(list_position(['click','error','purchase','signup','view'], event_type) - 1 AS INTEGER) AS code FROM events""")
def label_encode(spark, sf):
    return table(spark, sf, "events").select("event_id", scalars.label_index("event_type", b.EVENT_TYPES).alias("code"))


@query("target_recode", "SELECT vec_id AS id, label % 2 AS parity, 2 * (label % 2) - 1 AS sign FROM embeddings")
def target_recode(spark, sf):
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), scalars.parity("label").alias("parity"),
        scalars.to_sign(scalars.parity("label")).alias("sign"))


@query("bias_feature", f"WITH {VEC} SELECT id, d, x FROM vec UNION ALL SELECT DISTINCT id, 64, CAST(1 AS DOUBLE) FROM vec")
def bias_feature(spark, sf):
    return long_rows(b.vec(spark, sf).withColumn("features", vectors.with_bias("features")), "id", digits=None)


@query("infer_categorical", """SELECT 'p_retailprice' AS name, bool_and(p_retailprice % 1 = 0) AS categorical FROM part
  UNION ALL SELECT 'p_size', bool_and(p_size % 1 = 0) FROM part
  UNION ALL SELECT 'p_partkey', bool_and(p_partkey % 1 = 0) FROM part""")
def infer_categorical(spark, sf):
    names = ["p_size", "p_retailprice", "p_partkey"]
    found = ft.infer_categorical(table(spark, sf, "part"), names)
    return spark.createDataFrame([(n, n in found) for n in names], "name string, categorical boolean")


@query("binarize", f"WITH {PIX} SELECT id, d, CASE WHEN x >= 8 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS bit FROM pix")
def binarize(spark, sf):
    return vectors.long_form(b.pixels(spark, sf), "id").select("id", "d", scalars.binarize("x", 8).alias("bit"))


@query("misclassified", f"""WITH {GRADED} SELECT id, t FROM graded
  WHERE t * (-0.8 + 1.0 * a + 0.1 * b - 0.2 * c) <= 0""")
def misclassified(spark, sf):
    return gradient.misclassified(b.graded(spark, sf), ["a", "b", "c"], "t", [1.0, 0.1, -0.2, -0.8]).select("id", "t")


@query("feature_prefix", f"WITH {VEC} SELECT id, d, x FROM vec WHERE d < 4")
def feature_prefix(spark, sf):
    return long_rows(b.vec(spark, sf).withColumn("features", vectors.prefix("features", 4)), "id", digits=None)


@query("power_features", f"""WITH {PARTS} SELECT id, CAST(k AS INTEGER) - 1 AS d, {rs('pow(a, k)', 10)} AS x FROM parts, range(1, 6) AS g(k)""")
def power_features(spark, sf):
    return long_rows(b.parts(spark, sf).withColumn("features", vectors.powers("a", 5)), "id", digits=10)


@query("first_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10")
def first_n(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy("o_orderkey").limit(10)


@query("seeded_permutation", f"""SELECT o_orderkey, row_number() OVER (ORDER BY {b.h32(42, 'epoch0', 'o_orderkey')}, o_orderkey) - 1 AS position FROM orders""")
def seeded_permutation(spark, sf):
    return sampling.hash_rank(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 42, "epoch0", name="position")


@query("minibatch_assign", f"""SELECT o_orderkey, (row_number() OVER (ORDER BY {b.h32(42, 'epoch0', 'o_orderkey')}, o_orderkey) - 1) // 64 AS batch FROM orders""")
def minibatch_assign(spark, sf):
    return sampling.minibatches(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 64).select("o_orderkey", "batch")


@query("split_fraction", f"SELECT o_orderkey, {b.u(42, 'split', 'o_orderkey')} < 0.3 AS is_test FROM orders")
def split_fraction(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", sampling.split_fraction("o_orderkey", 0.3).alias("is_test"))


@query("split_exact", f"""SELECT o_orderkey, row_number() OVER (ORDER BY {b.h32(42, 'split', 'o_orderkey')}, o_orderkey)
  <= (SELECT ceil(CAST(0.15 AS DOUBLE) * count(*)) FROM orders) AS is_test FROM orders""")
def split_exact(spark, sf):
    return sampling.split_exact(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 0.15)


@query("stratified_folds", f"""SELECT vec_id AS id, label, CAST((row_number() OVER (PARTITION BY label ORDER BY {b.h32(42, 'fold', 'vec_id')}, vec_id) - 1) % 5 AS INTEGER) AS fold
  FROM embeddings""")
def stratified_folds(spark, sf):
    df = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "label")
    return sampling.stratified_folds(df, "id", "label", 5)


@query("kmeans_random_init", f"""SELECT vec_id AS id FROM embeddings ORDER BY {b.h32(42, 'init', 'vec_id')}, vec_id LIMIT 5""")
def kmeans_random_init(spark, sf):
    ids, _ = cluster.random_init(b.vec(spark, sf), 5)
    return spark.createDataFrame([(i,) for i in ids], "id bigint")
