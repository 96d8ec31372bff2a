"""Helpers shared by the corpus operators."""

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

#: The separators of words: space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or one in the warehouse where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir") + "/checkpoints"
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """The same rows from files in the shared folder: they are computed once and survive lost executors."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library wrote."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def small(df: DataFrame, rows: int, row_bytes: int, most: int = 32 << 20) -> DataFrame:
    """A hint to broadcast where rows * row_bytes is at most `most`; beyond it Spark joins by a shuffle."""
    return F.broadcast(df) if rows * row_bytes <= most else df


def packed(df: DataFrame) -> DataFrame:
    """One struct column `row` of all columns, beside which an operator can use any names; `unpacked` undoes it."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def unpacked(df: DataFrame) -> DataFrame:
    return df.select("row.*")


def numbered(df: DataFrame, by: list[str], order: list[str], name: str, bucket_rows: int = 20_000) -> DataFrame:
    """`name`: 0, 1, 2, ... without gaps within each `by`, in a pseudo-random order fixed by `order`.

    Rows go to buckets by a hash of `order`; the buckets' counts give offsets, so no task holds a whole
    group. Rows that agree in `order` get consecutive numbers. `df` is read three times: cut it before.
    """
    n = max(1, df.count() // bucket_rows)
    keyed = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(n)))
    counts = keyed.groupBy(*by, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("_bucket").alias("_b"),
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    within = F.row_number().over(Window.partitionBy(*by, "_bucket").orderBy(*order))
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by] + [F.col("_bucket") == F.col("_b")]
    return (keyed.withColumn("_within", within).join(offsets, on)
            .withColumn(name, F.col("_offset") + F.col("_within") - 1)
            .select(*df.columns, name))


class Tokens:
    """The words of a batch of texts: `codes` numbers them into `words`, `doc` gives their row."""

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        lists = pc.ascii_split_whitespace(texts)
        flat, doc = lists.flatten(), pc.list_parent_indices(lists).to_numpy()
        full = pc.greater(pc.binary_length(flat), 0)
        coded = flat.filter(full).dictionary_encode()
        self.rows = len(texts)
        self.doc = doc[full.to_numpy(zero_copy_only=False)]
        self.codes = coded.indices.to_numpy()
        self.words = coded.dictionary
        #: Words per row, and where each row's words begin.
        self.count = np.bincount(self.doc, minlength=self.rows)
        self.start = np.concatenate(([0], np.cumsum(self.count)))


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow array of strings laid end to end, and the rows' ends after a leading 0. Null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = texts.buffers()[2]
    return np.frombuffer(raw, np.uint8)[at[0]:at[-1]] if raw is not None else np.empty(0, np.uint8), at - at[0]


def lower_utf8(texts: pa.Array) -> pa.Array:
    """A-Z of an Arrow array of strings in lower case; other bytes are as before."""
    raw, at = utf8(texts)
    low = raw + ((raw >= 65) & (raw <= 90)).astype(np.uint8) * np.uint8(32)
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(at.astype(np.int64)), pa.py_buffer(low))
