"""Rows are dealt evenly before they grow, whatever their files and keys, and each row's features are made once."""

from pyspark.sql import functions as F

from sparkstats.functions import vectors
from sparkstats.operators import features as ft
from sparkstats.plans import QUERIES


def uneven(spark, tmp_path):
    """A table of parts: nine tenths of the rows in one file, half of them with the same key, some without key, type or size."""
    part = spark.range(4000).select(
        F.when(F.col("id") % 97 != 0, F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id"))).alias("p_partkey"), F.lit("x").alias("p_brand"),
        F.when(F.col("id") % 13 != 0, F.concat(F.lit("t"), F.col("id") % 3)).alias("p_type"), F.when(F.col("id") % 11 != 0, (F.col("id") % 50).cast("int")).alias("p_size"),
        (F.col("id") / 10.0).alias("p_retailprice"))
    for rows, name in ((part.where("p_retailprice < 360"), "a"), (part.where("p_retailprice >= 360 and p_retailprice < 399.8"), "b"), (part.where("p_retailprice >= 399.8"), "c")):
        rows.coalesce(1).write.parquet(f"{tmp_path}/part.parquet/file={name}")
    return str(tmp_path)


def sizes(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def result(spark, sf):
    return QUERIES["column_transform"](spark, sf)


def test_dealt_rows_are_even_whatever_their_keys(spark, tmp_path, monkeypatch):
    df = spark.read.parquet(uneven(spark, tmp_path) + "/part.parquet")
    monkeypatch.setattr(ft, "DEALT_BYTES", 4000 * 8 * 10 // 20)
    got = ft.dealt(df, 10)
    assert len(sizes(got)) == 20 and max(sizes(got)) < 1.4 * 200
    assert got.exceptAll(df).count() == df.exceptAll(got).count() == 0
    assert len(sizes(ft.dealt(df, 100))) == min(200, ft.FAN * df.rdd.getNumPartitions())


def test_few_rows_stay_where_they_are(spark, tmp_path):
    df = spark.read.parquet(uneven(spark, tmp_path) + "/part.parquet")
    assert ft.dealt(df, 10) is df and ft.dealt(df.limit(0), 10).count() == 0


def test_column_transform_grows_rows_in_even_tasks(spark, tmp_path, monkeypatch):
    sf = uneven(spark, tmp_path)
    as_read = result(spark, sf)
    assert "Exchange" not in as_read._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(ft, "DEALT_BYTES", 4000 * 8 * 20 // 20)
    dealt = result(spark, sf)
    assert max(sizes(dealt)) < 2 * sum(sizes(dealt)) / len(sizes(dealt)) and len(sizes(dealt)) > 10
    assert dealt.exceptAll(as_read).count() == as_read.exceptAll(dealt).count() == 0


def test_column_transform_makes_features_once(spark, tmp_path):
    plan = result(spark, uneven(spark, tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_long_form_of_udf_features_has_the_same_rows(spark):
    df = spark.createDataFrame([(1, [1.0, None, 3.0]), (2, []), (3, None), (1, [1.0, None, 3.0]), (None, [0.0])], "id long, features array<double>")
    key = lambda f: sorted((str(r["id"]), r["d"], str(r["x"])) for r in f.collect())
    assert key(vectors.long_form(df, "id", by_udf=True)) == key(vectors.long_form(df, "id")) and vectors.long_form(df, "id", by_udf=True).count() == 7


def test_width_is_that_of_a_row(spark, tmp_path):
    df = spark.read.parquet(uneven(spark, tmp_path) + "/part.parquet")
    model = ft.ColumnTransform([("one_hot", ["p_type"]), ("standard", ["p_size", "p_retailprice"]), ("pass", ["p_size"])]).fit(df)
    assert model.width() == model.transform(df).select(F.size("features").alias("n")).first()["n"] == 6
