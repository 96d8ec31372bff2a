"""Edit counts of the diacritics restorer, document by document: what it had to change, changed, and got right."""

from pyspark.sql import DataFrame, functions as F

from ..operators import documents as dc
from ..sources import models
from . import base as b
from .base import DOCS, table
from .texts import strip, strip_sql, words_sql

COLUMNS = {"gold": "gold", "predicted": "predicted", "correct": "correct", "rating": "rating"}


def edits(spark, sf) -> DataFrame:
    """(doc_id, lang, gold, predicted, correct, rating) of every labelled document.

    gold: words that lose diacritics when stripped. predicted: stripped words that the restorer, trained on the
    training documents, changes. correct: gold words that it gives back. rating: 100 for good quality, else 0.
    """
    docs = b.docs(spark, sf)
    forms = models.materialize(dc.variants(docs.where("not is_test"), "text", strip), "forms")
    labels = table(spark, sf, "labels").select("doc_id", (F.col("quality") * 100).cast("int").alias("rating"))
    labelled = docs.join(labels, "doc_id")
    words = dc.word_counts(labelled, "doc_id", "text").withColumn("plain", strip(F.col("word")))
    known = words.join(forms.select("plain", F.col("word").alias("form")), "plain", "left")
    gold, changed = F.col("word") != F.col("plain"), F.col("form").isNotNull()
    times = lambda test: F.sum(F.when(test, F.col("cnt")).otherwise(0))
    sums = (known.where(gold | changed).groupBy("doc_id")
            .agg(times(gold).alias("gold"), times(changed).alias("predicted"), times(gold & (F.coalesce("form", "plain") == F.col("word"))).alias("correct")))
    return (labelled.join(sums, "doc_id", "left")
            .select("doc_id", "lang", *[F.coalesce(c, F.lit(0)).cast("int").alias(c) for c in ("gold", "predicted", "correct")], "rating"))


EDITS = f"""{DOCS}, forms AS MATERIALIZED (SELECT plain, word FROM (
    SELECT plain, word, row_number() OVER (PARTITION BY plain ORDER BY c DESC, word) AS n FROM (
      SELECT {strip_sql('w')} AS plain, w AS word, count(*) AS c FROM (SELECT unnest({words_sql('text')}) AS w FROM docs WHERE NOT is_test) GROUP BY 1, 2)) WHERE n = 1),
  spelled AS (SELECT doc_id, w, {strip_sql('w')} AS plain FROM (SELECT doc_id, unnest({words_sql('text')}) AS w FROM docs)),
  sums AS (SELECT doc_id, sum(CAST(w <> plain AS INTEGER)) AS gold, sum(CAST(coalesce(word, plain) <> plain AS INTEGER)) AS predicted,
      sum(CAST(w <> plain AND coalesce(word, plain) = w AS INTEGER)) AS correct FROM spelled LEFT JOIN forms USING (plain) GROUP BY doc_id),
  edits AS MATERIALIZED (SELECT doc_id, lang, CAST(coalesce(gold, 0) AS INTEGER) AS gold, CAST(coalesce(predicted, 0) AS INTEGER) AS predicted,
      CAST(coalesce(correct, 0) AS INTEGER) AS correct, 100 * quality AS rating FROM docs JOIN labels USING (doc_id) LEFT JOIN sums USING (doc_id))"""
