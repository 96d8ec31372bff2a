import pytest
from corpus_rows import FIELDS, messy_rows
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def messy(spark):
    return spark.createDataFrame(messy_rows(), FIELDS).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], FIELDS)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(1, 1, 0), (12, 1, 0), (13, 0, 1), (10, 0, 1), (9, 1, None), (None, 1, 1), (99, 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int").withColumn("id", F.lit(1))
