"""From raw documents to token ids: five stages, each written as Parquet and read again by the next.

Every stage works on all that its predecessor kept. All but the last return the columns of `documents`.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkstats.llm import common, mixing, pieces, quality, secrets, simhash


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules; the others go."""
    return quality.kept(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the least doc_id.

    Near copies share 80 % of their shingles of five words, and more.
    """
    return simhash.deduplicated(docs, words=5, similarity=0.8)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked."""
    return secrets.redacted(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, to the nearest whole number."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return pieces.encoded(docs, pieces.MODEL).select("doc_id", "source", "n_chars", "n_pieces", "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules), ("near_dedup", near_dedup), ("secret_scan", secret_scan), ("mixing", mix), ("sentencepiece", encode)]

#: Hashes and fitted models cannot be written as SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents of sf_dir. The table that the last stage reads stays in the shared folder."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = common.new_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            common.delete(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
