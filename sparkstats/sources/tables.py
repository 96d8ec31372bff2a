"""Scans: lines, labelled text, headered CSV, feature matrices, labelled corpora."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BOM = "﻿"


def strip_bom(text) -> Column:
    return F.regexp_replace(text, f"^{BOM}", "")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line of UTF-8 text files, with the byte order mark removed."""
    return spark.read.text(path).select(strip_bom("value").alias("line"))


def lines_of(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, line_no, line); a trailing newline gives a trailing empty line."""
    return df.select(id_col, F.posexplode(F.split(strip_bom(text), "\n")).alias("line_no", "line"))


def join_lines(df: DataFrame, id_col: str, line_no: str, line: str, name: str = "text") -> DataFrame:
    """Put the lines of each document back together, in order."""
    ordered = F.sort_array(F.collect_list(F.struct(line_no, line)))
    return df.groupBy(id_col).agg(F.array_join(F.transform(ordered, lambda s: s[line]), "\n").alias(name))


def read_labelled_tsv(spark: SparkSession, path: str) -> DataFrame:
    """`label <tab> text` lines. Any other number of fields is an error."""
    parts = F.split("line", "\t")
    label = F.when(F.size(parts) == 2, parts[0]).otherwise(
        F.raise_error(F.concat(F.lit("expected two tab-separated fields: "), F.col("line"))))
    return read_lines(spark, path).where(F.col("line") != "").select(
        label.cast("int").alias("label"), parts[1].alias("text"))


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV file with a header line and a declared schema."""
    return spark.read.csv(path, header=True, schema=schema, mode="FAILFAST")


def read_features(df: DataFrame, id_col: str, vector: str, label: str | None = None,
                  classes: int | None = None) -> DataFrame:
    """(id, features array<double>, label) from any table holding a numeric array."""
    out = df.select(F.col(id_col).alias("id"),
                    F.transform(vector, lambda x: x.cast("double")).alias("features"),
                    *([F.col(label).alias("label")] if label else []))
    return out.where(F.col("label") < classes) if label and classes is not None else out


def split_target(df: DataFrame, label: str) -> tuple[DataFrame, Column | None]:
    """The features, and the label column if the table has one (it may not at scoring time)."""
    return (df.drop(label), F.col(label)) if label in df.columns else (df, None)


def corpus(documents: DataFrame, labels: DataFrame, names: DataFrame | None = None,
           id_col: str = "doc_id", label: str = "label") -> DataFrame:
    """Documents with their class, and the class name if a name table is given."""
    out = documents.join(labels, id_col)
    return out.join(names, label) if names is not None else out
