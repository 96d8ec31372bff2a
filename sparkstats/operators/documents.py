"""Vocabularies, term weights, n-gram counts and diacritics restoration."""

from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions import arrow_text as at, text as tx, vectors
from ..sources.models import materialize
from . import inverted, neighbors, sampling

BROADCAST_TERMS = 1_000_000
FORM_BYTES = 32 << 20
#: Bytes of text whose n-grams one task adds up, about.
NGRAM_BYTES = 8 << 20
#: Words that are replaced at once, but for a longer line.
WORDS_AT_ONCE = 1 << 17


def _small(table: DataFrame, rows: int) -> DataFrame:
    """Broadcast a lookup table whose counted size allows it; else leave the join to AQE."""
    return F.broadcast(table) if rows <= BROADCAST_TERMS else table


def _counted(df: DataFrame, id_col: str, text: Column, name: str, items) -> DataFrame:
    """(id, name, cnt): how often each item is in a text, row by row: one row is one document.

    `items` makes the lists of items of an Arrow batch of texts. They are numbered and counted where they are, some bytes at a time; nothing is shuffled.
    """
    def count(batches):
        for batch in batches:
            for first, texts in at.parts(batch.column("_text")):
                for found in items(texts):
                    row, names, n = found.by_row()
                    yield pa.RecordBatch.from_arrays([batch.column(id_col).take(pa.array(row + first)), names, pa.array(n, pa.int64())], names=[id_col, name, "cnt"])
    fields = [df.schema[id_col], T.StructField(name, T.StringType()), T.StructField("cnt", T.LongType())]
    return df.select(id_col, text.alias("_text")).mapInArrow(count, T.StructType(fields))


def _part_totals(df: DataFrame, text: Column, name: str, items) -> DataFrame:
    """(name, cnt): how often each item is in a part of a batch; a row for each part that has it."""
    def count(batches):
        for batch in batches:
            for _, texts in at.parts(batch.column(0)):
                for found in items(texts):
                    names, n = found.totals()
                    yield pa.RecordBatch.from_arrays([names, pa.array(n, pa.int64())], names=[name, "cnt"])
    return df.select(text.alias("_text")).mapInArrow(count, f"{name} string, cnt long")


def _totals(df: DataFrame, text: Column, name: str, items) -> DataFrame:
    """(name, cnt): how often each item is in all texts. Parts of batches are counted in the scan, and their counts added up."""
    return _part_totals(df, text, name, items).groupBy(name).agg(F.sum("cnt").alias("cnt"))


def token_counts(df: DataFrame, id_col: str, text: str, min_len: int = 2) -> DataFrame:
    """(id, term, cnt) over the whole text."""
    return _counted(df, id_col, F.col(text), "term", lambda t: [at.Items(t, at.NO_WORD, min_len)])


def vocabulary(df: DataFrame, text: str, min_count: int = 2, min_len: int = 2) -> DataFrame:
    """(term, cnt): terms by total occurrences, case-sensitive."""
    return _totals(df, F.col(text), "term", lambda t: [at.Items(t, at.NO_WORD, min_len)]).where(F.col("cnt") >= min_count)


def vocabulary_of(counts: DataFrame, min_count: int = 2) -> DataFrame:
    """The same (term, cnt) from per-document counts that are already at hand."""
    return counts.groupBy("term").agg(F.sum("cnt").alias("cnt")).where(F.col("cnt") >= min_count)


def vocabulary_index(vocab: DataFrame) -> DataFrame:
    """(term, idx): place of each term in sorted order, by a distributed rank."""
    return sampling.sorted_runs(vocab.select("term"), "term").select(F.col("value").alias("term"), F.col("run_no").alias("idx"))


def in_vocabulary(counts: DataFrame, vocab: DataFrame, rows: int | None = None) -> DataFrame:
    """Keep the terms of the vocabulary, with its other columns.

    With a counted vocabulary the choice of a broadcast is made here; without,
    adaptive execution makes it from the size it has measured.
    """
    return counts.join(vocab if rows is None else _small(vocab, rows), "term")


def idf(counts: DataFrame, documents: int) -> DataFrame:
    """(term, df, idf) with idf = ln(N / (df + 1)); it may be negative."""
    return (counts.groupBy("term").agg(F.count("*").alias("df"))
            .withColumn("idf", F.ln(F.lit(float(documents)) / (F.col("df") + 1))))


def weights(counts: DataFrame, id_col: str, tf: bool, idf_column: str | None = None) -> DataFrame:
    """(id, term, weight), each document scaled to unit length.

    tf: count over the number of distinct in-vocabulary terms of the document;
    else 1. A document whose weights are all zero keeps zeros.
    """
    per_doc = Window.partitionBy(id_col)
    w = F.col("cnt") / F.count("*").over(per_doc) if tf else F.lit(1.0)
    if idf_column:
        w = w * F.col(idf_column)
    raw = counts.withColumn("_w", w)
    size = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(per_doc))
    return raw.withColumn("weight", F.coalesce(F.try_divide(F.col("_w"), size), F.lit(0.0))).drop("_w")


def fit_vocabulary(train: DataFrame, counts: DataFrame, use_idf: bool, min_count: int = 2, numbered: bool = False):
    """(vocabulary table, its size) from training counts; with IDF and term numbers if asked for."""
    vocab = (counts.groupBy("term").agg(F.sum("cnt").alias("total"), F.count("*").alias("df"))
             .where(F.col("total") >= min_count))
    if use_idf:
        vocab = vocab.withColumn("idf", F.ln(F.lit(float(train.count())) / (F.col("df") + 1)))
    vocab = materialize(vocab.drop("total"), "vocabulary")
    rows = vocab.count()
    if numbered:
        # A 64-bit hash numbers the terms; should two terms ever share one, ranks do.
        hashed = vocab.withColumn("idx", F.xxhash64("term"))
        clash = hashed.select("idx").distinct().count() < rows
        vocab = materialize(vocab.join(vocabulary_index(vocab), "term"), "vocabulary") if clash else hashed
    return vocab, rows


def fit_transform(train: DataFrame, test: DataFrame | None, id_col: str, text: str, tf: bool, use_idf: bool,
                  min_count: int = 2, min_len: int = 2):
    """Vocabulary and IDF from `train`; unit-length term weights of both tables.

    Term counts are made in the scan, each time they are read; no copy of them is stored.
    """
    counts = token_counts(train, id_col, text, min_len)
    vocab, rows = fit_vocabulary(train, counts, use_idf, min_count)

    def transform(c):
        return weights(in_vocabulary(c, vocab, rows), id_col, tf, "idf" if use_idf else None)

    return transform(counts), (transform(token_counts(test, id_col, text, min_len)) if test is not None else None)


def sparse_rows(counts: DataFrame, base: DataFrame, id_col: str, tf: bool, idf_column: str | None = None) -> DataFrame:
    """(id, terms, weights, head, base columns...): unit-length rows, one per document, also for empty ones.

    head is the term of most documents (column df of counts). A document's count of terms scales all its weights
    alike, so it drops out here. The terms of a document are brought together by one shuffle and a sort.
    """
    w = F.col("cnt").cast("double") if tf else F.lit(1.0)
    w = w * F.col(idf_column) if idf_column else w
    sorted_ = counts.select(F.col(id_col).alias("id"), "idx", w.alias("w"), "df").repartition("id").sortWithinPartitions("id", "idx")

    def rows_of(ids, idx, w, df):
        start = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
        size = np.diff(np.append(start, len(ids)))
        norm = np.repeat(np.sqrt(np.add.reduceat(w * w, start)), size)
        unit = np.divide(w, norm, out=np.zeros_like(w), where=norm > 0)
        most = np.flatnonzero(df == np.repeat(np.maximum.reduceat(df, start), size))
        head = idx[most[np.searchsorted(most, start)]]
        ends = pa.array(np.append(start, len(ids)).astype(np.int32))
        return start, [pa.ListArray.from_arrays(ends, pa.array(idx)), pa.ListArray.from_arrays(ends, pa.array(unit)), pa.array(head)]

    def pack(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, table]).combine_chunks() if held is not None else table
            ids = held["id"].combine_chunks().dictionary_encode().indices.to_numpy()
            last = int(np.searchsorted(ids, ids[-1])) if len(ids) else 0  # a row may go on in the next batch
            if last:
                yield made(held.slice(0, last).combine_chunks(), ids[:last])
                held = held.slice(last)
        if held is not None and len(held):
            yield made(held.combine_chunks(), np.zeros(len(held), int))

    def made(table, ids):
        start, columns = rows_of(ids, *[table[c].to_numpy() for c in ("idx", "w", "df")])
        return pa.RecordBatch.from_arrays([table["id"].combine_chunks().take(pa.array(start)), *columns], names=["_id", "terms", "weights", "head"])

    packed = sorted_.mapInArrow(pack, T.StructType([T.StructField("_id", counts.schema[id_col].dataType), T.StructField("terms", T.ArrayType(T.LongType())),
                                                    T.StructField("weights", T.ArrayType(T.DoubleType())), T.StructField("head", T.LongType())]))
    empty = lambda kind: F.array().cast(f"array<{kind}>")
    return (base.join(packed, F.col(id_col) == F.col("_id"), "left").drop("_id")
            .withColumn("terms", F.coalesce("terms", empty("bigint"))).withColumn("weights", F.coalesce("weights", empty("double"))))


def knn(train: DataFrame, test: DataFrame, id_col: str, text: str, label: str, k: int = 1, tf: bool = True,
        use_idf: bool = True, min_count: int = 2, min_len: int = 2, pivots: int = 1, **options) -> DataFrame:
    """Nearest training documents by Euclidean distance of unit rows (the order of cosine similarity).

    A document without vocabulary terms is a zero row: equally far from all
    non-zero rows, so the lowest id wins. The search is one by inverted lists; with `pivots` above 1, one by cells
    around so many rows.
    """
    def pack(counts, base, name):
        return materialize(sparse_rows(in_vocabulary(counts, vocab, rows), base, id_col, tf, "idf" if use_idf else None), name)

    with ThreadPoolExecutor(2) as jobs:  # both tables at once
        counted = [jobs.submit(materialize, token_counts(df, id_col, text, min_len), name) for df, name in ((train, "train-counts"), (test, "test-counts"))]
        vocab, rows = fit_vocabulary(train, counted[0].result(), use_idf, min_count, numbered=True)
        packed = [jobs.submit(pack, c.result(), *rest) for c, *rest in zip(counted, (train.select(id_col, label), test.select(id_col)), ("train-rows", "test-rows"))]
        known, asked = (p.result() for p in packed)
    if pivots > 1:
        return neighbors.knn_join(asked, known, k, neighbors.Sparse(), [label], id_col, pivots=pivots, **options)
    return inverted.knn_join(asked, known, k, [label], id_col, group="head", **options)


def _grams(low: int, high: int):
    """Word n-grams of tokens of two characters and more."""
    def items(texts):
        tokens = at.Items(texts, at.NO_WORD, 2)
        for n in range(low, high + 1):
            yield tokens.ngrams(n)
    return items


def word_ngram_counts(df: DataFrame, id_col: str, text: str, low: int = 1, high: int = 3, lower: bool = True) -> DataFrame:
    """(id, ngram, cnt) of word n-grams."""
    return _counted(df, id_col, F.lower(text) if lower else F.col(text), "ngram", _grams(low, high))


def _windows(low: int, high: int):
    """The word n-grams from which the rest follows: those of `high` words, the next shorter ones that end a text, and all that are shorter still."""
    def items(texts):
        tokens = at.Items(texts, at.NO_WORD, 2)
        for n in range(low, high - 1):
            yield tokens.ngrams(n)
        yield tokens.ngrams(high - 1).ends()
        yield tokens.ngrams(high)
    return items


def corpus_word_ngrams(df: DataFrame, text: str, low: int = 1, high: int = 3, lower: bool = True) -> DataFrame:
    """(ngram, cnt) over the whole corpus.

    Most n-grams of a corpus are rare, so adding up a task's before they are shuffled would hold nearly all of them for little.
    Parts' counts go straight to the task of the n-gram's head, its first high - 1 words. An n-gram of high - 1 words is
    followed by a word or ends its text, so its count is the sum of its head's and needs no rows of its own.
    """
    words = F.lower(text) if lower else F.col(text)
    if low >= high:
        return _totals(df, words, "ngram", _grams(low, high))
    size = df.agg(F.sum(F.octet_length(text)).alias("b")).first()["b"] or 0
    head = F.substring_index("ngram", " ", high - 1)
    dealt = _part_totals(df, words, "ngram", _windows(low, high)).repartition(1 + size // NGRAM_BYTES, head)
    counted = dealt.groupBy(head.alias("head"), "ngram").agg(F.sum("cnt").alias("cnt"))
    of_head = Window.partitionBy("head").orderBy("ngram")
    summed = counted.select("*", F.row_number().over(of_head).alias("place"),
                            F.sum("cnt").over(of_head.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"))
    both = F.stack(F.lit(2), F.when(F.col("place") == 1, F.col("head")), F.col("total"), F.when(F.col("ngram") != F.col("head"), F.col("ngram")), F.col("cnt"))
    return summed.select(both.alias("ngram", "cnt")).where(F.col("ngram").isNotNull())


def word_counts(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, word, cnt) of the words between whitespace, row by row."""
    return _counted(df, id_col, F.col(text), "word", lambda t: [at.Items(t, at.BLANK)])


def word_totals(df: DataFrame, text: str, name: str = "word") -> DataFrame:
    """(word, cnt) of the words between whitespace."""
    return _totals(df, F.col(text), name, lambda t: [at.Items(t, at.BLANK)])


def corpus_char_ngrams(df: DataFrame, text: str, low: int = 1, high: int = 5) -> DataFrame:
    """(n, ngram, cnt) of character n-grams within word boundaries.

    Words are counted first, so n-grams are cut once per distinct word. A padded
    word shorter than `low` counts once, whole, under `low`.
    """
    words = word_totals(df, text).withColumnRenamed("cnt", "c")
    padded = words.select(F.concat(F.lit(" "), "word", F.lit(" ")).alias("w"), "c")
    sized = padded.select("w", "c", F.explode(F.sequence(F.lit(low), F.greatest(F.lit(low), F.least(F.length("w"), F.lit(high))))).alias("n"))
    placed = sized.select("w", "c", "n", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length("w") - F.col("n") + 1))).alias("i"))
    return (placed.select("n", F.substring("w", F.col("i"), F.col("n")).alias("ngram"), "c")
            .groupBy("n", "ngram").agg(F.sum("c").alias("cnt")))


def variants(train: DataFrame, text: str, strip) -> DataFrame:
    """(plain, word): the most frequent form of each plain word, where it differs from it.

    Among equally frequent forms the first in sorted order wins.
    """
    counted = word_totals(train, text).withColumnRenamed("cnt", "c").withColumn("plain", strip(F.col("word")))
    best = counted.groupBy("plain").agg(F.min_by("word", F.struct(-F.col("c"), F.col("word"))).alias("word"))
    return best.where(F.col("word") != F.col("plain"))


def restore(lines: DataFrame, forms: DataFrame, keys: list[str], text: str, name: str = "restored", most: int = FORM_BYTES) -> DataFrame:
    """Replace each plain word by its form; unseen words stay, and so does the word count. The keys tell lines apart.

    Forms of at most `most` bytes are sent to all tasks, which replace words
    where they stand. Larger ones meet the words in a join.
    """
    size = forms.agg(F.coalesce(F.sum(F.octet_length("plain") + F.octet_length("word")), F.lit(0)).alias("b"), F.count("*").alias("n")).first()
    if size["b"] <= most:
        known = lines.sparkSession.sparkContext.broadcast({r["plain"]: r["word"] for r in forms.select("plain", "word").collect()})

        def replaced(lists: pa.Array) -> pa.Array:
            cuts = np.searchsorted(lists.offsets.to_numpy(), np.arange(lists.offsets[0].as_py(), lists.offsets[-1].as_py(), WORDS_AT_ONCE), side="right") - 1 if len(lists) else []
            cuts = np.unique(np.append(cuts, [0, len(lists)])).astype(int).tolist()
            return pa.concat_arrays([some(lists.slice(a, z - a)) for a, z in zip(cuts, cuts[1:])] or [some(lists)])

        def some(lists: pa.Array) -> pa.Array:
            coded = lists.flatten().dictionary_encode()
            form = known.value
            words = pa.array([form.get(w, w) for w in coded.dictionary.to_pylist()], pa.string()).take(coded.indices)
            ends = lists.offsets.to_numpy()
            return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends - ends[0]), words), " ")
        here = F.coalesce(tx.words(text), F.array().cast("array<string>"))
        return lines.select(*keys, F.arrow_udf(replaced, "string")(here).alias(name))
    rows = size["n"]
    words = lines.select(*keys, F.posexplode_outer(tx.words(text)).alias("_p", "plain"))
    joined = words.join(_small(forms, rows), "plain", "left")
    piece = F.struct("_p", F.coalesce("word", "plain").alias("w"))
    ordered = F.sort_array(F.collect_list(F.when(F.col("_p").isNotNull(), piece)))
    return joined.groupBy(*keys).agg(F.array_join(F.transform(ordered, lambda s: s["w"]), " ").alias(name))
