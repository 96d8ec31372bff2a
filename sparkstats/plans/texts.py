"""Text queries: tokens, n-grams, vocabularies, TF-IDF, diacritics."""

from pyspark.sql import Column, functions as F

from ..functions import text as tx
from ..operators import documents as dc, metrics
from ..sources import models, tables
from . import base as b
from .base import DOCS, SPACE, WORD, query, r, rs

FROM, TO = b.ACCENTED + b.ACCENTED.upper(), b.PLAIN + b.PLAIN.upper()


def strip(c) -> Column:
    return tx.strip_diacritics(c, b.ACCENTED, b.PLAIN)


def strip_sql(c: str) -> str:
    return f"translate({c}, '{FROM}', '{TO}')"


def words_sql(c: str) -> str:
    return f"list_filter(regexp_split_to_array({c}, '{SPACE}'), lambda w: w <> '')"


COUNTS = f"""{DOCS}, {b.tokens_sql()},
  counts AS MATERIALIZED (SELECT doc_id, is_test, term, count(*) AS cnt FROM toks WHERE length(term) >= 2 GROUP BY ALL),
  vocab AS MATERIALIZED (SELECT term, CAST(sum(cnt) AS BIGINT) AS total, count(*) AS df FROM counts WHERE NOT is_test GROUP BY term HAVING sum(cnt) >= 2),
  idx AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx FROM vocab)"""
N_TRAIN = "(SELECT count(*) FROM docs WHERE NOT is_test)"


@query("strip_diacritics", f"SELECT doc_id, {strip_sql('text')} AS text FROM documents")
def strip_diacritics(spark, sf):
    return b.texts(spark, sf).select("doc_id", strip(F.col("text")).alias("text"))


@query("tokenize", f"""SELECT doc_id, CAST(len(t) AS INTEGER) AS n, md5(array_to_string(t, ' ')) AS digest
  FROM (SELECT doc_id, regexp_extract_all(text, '{WORD}') AS t FROM documents)""")
def tokenize(spark, sf):
    t = b.texts(spark, sf).select("doc_id", tx.tokens("text").alias("t"))
    return t.select("doc_id", F.size("t").alias("n"), F.md5(F.array_join("t", " ")).alias("digest"))


@query("word_ngrams", f"""WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS t FROM documents),
  w AS MATERIALIZED (SELECT doc_id, generate_subscripts(t, 1) AS p, unnest(t) AS w FROM d),
  x AS MATERIALIZED (SELECT w AS a, lead(w) OVER (PARTITION BY doc_id ORDER BY p) AS b, lead(w, 2) OVER (PARTITION BY doc_id ORDER BY p) AS c FROM w)
  SELECT ngram, count(*) AS cnt FROM (SELECT a AS ngram FROM x UNION ALL SELECT a || ' ' || b FROM x WHERE b IS NOT NULL
    UNION ALL SELECT a || ' ' || b || ' ' || c FROM x WHERE c IS NOT NULL) GROUP BY ngram""")
def word_ngrams(spark, sf):
    return dc.corpus_word_ngrams(b.texts(spark, sf), "text")


@query("ngram_counts", f"""WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS t FROM documents),
  w AS MATERIALIZED (SELECT doc_id, generate_subscripts(t, 1) AS p, unnest(t) AS w FROM d),
  x AS MATERIALIZED (SELECT doc_id, w AS a, lead(w) OVER (PARTITION BY doc_id ORDER BY p) AS b, lead(w, 2) OVER (PARTITION BY doc_id ORDER BY p) AS c FROM w)
  SELECT doc_id, ngram, count(*) AS cnt FROM (SELECT doc_id, a AS ngram FROM x UNION ALL SELECT doc_id, a || ' ' || b FROM x WHERE b IS NOT NULL
    UNION ALL SELECT doc_id, a || ' ' || b || ' ' || c FROM x WHERE c IS NOT NULL) GROUP BY ALL""")
def ngram_counts(spark, sf):
    """Word 1- to 3-grams of every document."""
    return dc.word_ngram_counts(b.texts(spark, sf), "doc_id", "text", 1, 3)


@query("char_ngrams", f"""WITH w AS (SELECT ' ' || w || ' ' AS w, count(*) AS c FROM (SELECT unnest({words_sql('text')}) AS w FROM documents) GROUP BY 1)
  SELECT CAST(n AS INTEGER) AS n, ngram, CAST(sum(c) AS BIGINT) AS cnt FROM (
    SELECT n, substr(w, i, n) AS ngram, c FROM (SELECT w, c, n, unnest(range(1, length(w) - n + 2)) AS i FROM w, range(1, 6) AS g(n) WHERE length(w) >= n))
  GROUP BY n, ngram""")
def char_ngrams(spark, sf):
    return dc.corpus_char_ngrams(b.texts(spark, sf), "text")


@query("vocabulary", f"WITH {COUNTS} SELECT term, total AS cnt, idx FROM vocab JOIN idx USING (term)")
def vocabulary(spark, sf):
    v = models.materialize(dc.vocabulary(b.docs(spark, sf).where("not is_test"), "text"), "vocabulary")
    return v.join(dc.vocabulary_index(v), "term")


def split_counts(spark, sf):
    """(doc_id, term, cnt) of all documents, and of the training part."""
    docs = b.docs(spark, sf)
    return dc.token_counts(docs, "doc_id", "text"), dc.token_counts(docs.where("not is_test"), "doc_id", "text")


@query("term_counts", f"WITH {COUNTS} SELECT doc_id, term, cnt FROM counts JOIN vocab USING (term)")
def term_counts(spark, sf):
    counts, train = split_counts(spark, sf)
    return dc.in_vocabulary(counts, dc.vocabulary_of(train).select("term")).select("doc_id", "term", "cnt")


@query("vocab_join", f"WITH {COUNTS} SELECT doc_id, idx, cnt FROM counts JOIN idx USING (term) WHERE is_test")
def vocab_join(spark, sf):
    counts, train = split_counts(spark, sf)
    index = dc.vocabulary_index(dc.vocabulary_of(train))
    return dc.in_vocabulary(counts.where(b.is_test("doc_id")), index).select("doc_id", "idx", "cnt")


@query("idf", f"WITH {COUNTS} SELECT term, df, {rs(f'ln({N_TRAIN} / (df + 1.0::DOUBLE))')} AS idf FROM vocab")
def idf(spark, sf):
    _, train = split_counts(spark, sf)
    kept = dc.in_vocabulary(train, dc.vocabulary_of(train).select("term"))
    return dc.idf(kept, b.docs(spark, sf).where("not is_test").count()).withColumn("idf", r("idf"))


def weight_sql(tf: bool, use_idf: bool) -> str:
    w = "cnt / CAST(count(*) OVER (PARTITION BY doc_id) AS DOUBLE)" if tf else "1.0::DOUBLE"
    if use_idf:
        w += f" * ln({N_TRAIN} / (df + 1.0::DOUBLE))"
    return f"""{COUNTS}, raw AS (SELECT doc_id, is_test, term, {w} AS w FROM counts JOIN vocab USING (term)),
  weights AS MATERIALIZED (SELECT doc_id, is_test, term, coalesce(w / nullif(sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 0), 0) AS weight FROM raw)"""


def _register_weights(name: str, tf: bool, use_idf: bool):
    @query(f"tfidf_{name}", f"WITH {weight_sql(tf, use_idf)} SELECT doc_id, term, {rs('weight')} AS weight FROM weights WHERE is_test")
    def weighted(spark, sf):
        d = b.docs(spark, sf)
        _, test = dc.fit_transform(d.where("not is_test"), d.where("is_test"), "doc_id", "text", tf, use_idf)
        return test.select("doc_id", "term", r("weight").alias("weight"))


for _name, _tf, _idf in (("binary", False, False), ("tf", True, False), ("idf", False, True), ("tfidf", True, True)):
    _register_weights(_name, _tf, _idf)


KNN = f"""{weight_sql(True, True)},
  size AS MATERIALIZED (SELECT doc_id, is_test, lang, coalesce(s, 0) AS s FROM docs LEFT JOIN (SELECT doc_id, sum(weight * weight) AS s FROM weights GROUP BY doc_id) USING (doc_id)),
  dots AS MATERIALIZED (SELECT q.doc_id AS query_id, t.doc_id AS train_id, sum(q.weight * t.weight) AS dot
    FROM weights q JOIN weights t ON q.term = t.term WHERE q.is_test AND NOT t.is_test GROUP BY 1, 2),
  dist AS (SELECT q.doc_id AS query_id, t.doc_id AS train_id, t.lang,
      round(sqrt(greatest(0, round(q.s + t.s - 2 * coalesce(dot, 0), 12))), 9) AS distance
    FROM size q JOIN size t ON q.is_test AND NOT t.is_test LEFT JOIN dots ON dots.query_id = q.doc_id AND dots.train_id = t.doc_id),
  knn AS MATERIALIZED (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, train_id) AS rank FROM dist) WHERE rank = 1)"""


@query("tfidf_knn", f"WITH {KNN} SELECT query_id, train_id, lang AS prediction, {rs('distance')} AS distance FROM knn")
def tfidf_knn(spark, sf):
    d = b.docs(spark, sf)
    out = dc.knn(d.where("not is_test"), d.where("is_test"), "doc_id", "text", "lang", k=1)
    return out.select("query_id", "train_id", F.col("lang").alias("prediction"), r("distance").alias("distance"))


@query("macro_f1", f"""WITH {KNN}, s AS (SELECT knn.lang AS p, docs.lang AS a FROM knn JOIN docs ON doc_id = query_id),
  c AS (SELECT class, sum(tp) AS tp, sum(p) AS p, sum(a) AS a FROM (
    SELECT p AS class, CAST(p = a AS INTEGER) AS tp, 1 AS p, 0 AS a FROM s UNION ALL SELECT a, 0, 0, 1 FROM s) GROUP BY class)
  SELECT {rs('avg(coalesce(2.0::DOUBLE * tp / nullif(p + a, 0), 0))')} AS macro_f1 FROM c""")
def macro_f1(spark, sf):
    scored = tfidf_knn(spark, sf).join(b.docs(spark, sf).select(F.col("doc_id").alias("query_id"), "lang"), "query_id")
    return metrics.macro_f1(scored, "prediction", "lang").select(r("macro_f1").alias("macro_f1"))


LINES = f"""{DOCS}, lines AS MATERIALIZED (SELECT doc_id, is_test, CAST(n - 1 AS INTEGER) AS line_no, line FROM (
    SELECT doc_id, is_test, generate_subscripts(l, 1) AS n, unnest(l) AS line FROM (
      SELECT doc_id, is_test, string_split(regexp_replace(text, '^\\x{{FEFF}}', ''), chr(10)) AS l FROM docs)))"""
FORMS = f"""{LINES}, forms AS MATERIALIZED (SELECT plain, word FROM (
    SELECT plain, word, row_number() OVER (PARTITION BY plain ORDER BY c DESC, word) AS n FROM (
      SELECT {strip_sql('w')} AS plain, w AS word, count(*) AS c FROM (SELECT unnest({words_sql('line')}) AS w FROM lines WHERE NOT is_test) GROUP BY 1, 2)) WHERE n = 1),
  pieces AS (SELECT doc_id, line_no, generate_subscripts(p, 1) AS n, unnest(p) AS plain FROM (
    SELECT doc_id, line_no, {words_sql(strip_sql('line'))} AS p FROM lines WHERE is_test)),
  rebuilt AS (SELECT doc_id, line_no, string_agg(coalesce(word, plain), ' ' ORDER BY n) AS restored FROM pieces LEFT JOIN forms USING (plain) GROUP BY 1, 2),
  restored AS MATERIALIZED (SELECT l.doc_id, l.line_no, l.line, coalesce(r.restored, '') AS restored
    FROM lines l LEFT JOIN rebuilt r ON r.doc_id = l.doc_id AND r.line_no = l.line_no WHERE l.is_test)"""


def restored_lines(spark, sf):
    """Test lines: original, and restored from the text without diacritics."""
    lines = tables.lines_of(b.docs(spark, sf), "doc_id", "text").withColumn("is_test", b.is_test("doc_id"))
    forms = models.materialize(dc.variants(lines.where("not is_test"), "line", strip), "forms")
    test = lines.where("is_test").withColumn("plain_line", strip(F.col("line")))
    out = dc.restore(test.select("doc_id", "line_no", "plain_line"), forms, ["doc_id", "line_no"], "plain_line")
    return out, test.select("doc_id", "line_no", "line")


@query("restore_diacritics", f"WITH {FORMS} SELECT doc_id, line_no, restored FROM restored")
def restore_diacritics(spark, sf):
    return restored_lines(spark, sf)[0]


@query("word_accuracy", f"""WITH {FORMS}, p AS (SELECT unnest({words_sql('line')}) AS a, unnest({words_sql('restored')}) AS b FROM restored)
  SELECT CAST(sum(CAST(a = b AS INTEGER)) AS BIGINT) AS hits, count(*) AS words, {rs('sum(CAST(a = b AS INTEGER)) / CAST(count(*) AS DOUBLE)')} AS word_accuracy FROM p""")
def word_accuracy(spark, sf):
    restored, gold = restored_lines(spark, sf)
    both = restored.join(gold, ["doc_id", "line_no"])
    return metrics.word_accuracy(both, "line", "restored").withColumn("word_accuracy", r("word_accuracy"))


@query("line_accuracy", f"WITH {FORMS} SELECT {rs('avg(CAST(line = restored AS INTEGER))')} AS accuracy FROM restored")
def line_accuracy(spark, sf):
    restored, gold = restored_lines(spark, sf)
    return restored.join(gold, ["doc_id", "line_no"]).agg(r(metrics.accuracy("restored", "line")).alias("accuracy"))
