"""Document fingerprints: a homomorphic multiset hash of paragraphs, as columns of DataFrame functions.

A fingerprint is the sum of wide vectors hashed from the paragraphs (lines) of a text: 16 lanes modulo 2^32
that tell multisets of paragraphs apart, and 256 sign lanes modulo 2^32 summed over the paragraphs' sentences,
from which the likeness of two texts can be read. The sum does not depend on the order of the paragraphs, and
paragraphs can be put in or taken out without the text: `plus` and `minus`.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import small

#: 64-bit hashes per paragraph, each two lanes; 64-bit hashes per sentence, each 64 sign lanes. Hashes have seeds of their own.
WIDE, SIGNS = 8, 4
#: Lanes lie two to a number.
FIELD = 32
ONES = 1 | 1 << FIELD
MASK32 = 0xFFFFFFFF
#: Documents of a bucket when neighbours are looked up, about; ranges of ids that are told apart exactly.
BUCKET_ROWS, RANGES = 2048, 64


def _lanes_added(a: Column, b: Column) -> Column:
    """Two lanes of 32 bits in a number, each added modulo 2^32."""
    low = (a.bitwiseAND(F.lit(MASK32)) + b.bitwiseAND(F.lit(MASK32))).bitwiseAND(F.lit(MASK32))
    high = (F.shiftrightunsigned(a, 32) + F.shiftrightunsigned(b, 32)).bitwiseAND(F.lit(MASK32))
    return F.shiftleft(high, 32).bitwiseOR(low)


def _lanes_taken(a: Column, b: Column) -> Column:
    low = (a.bitwiseAND(F.lit(MASK32)) - b.bitwiseAND(F.lit(MASK32))).bitwiseAND(F.lit(MASK32))
    high = (F.shiftrightunsigned(a, 32) - F.shiftrightunsigned(b, 32)).bitwiseAND(F.lit(MASK32))
    return F.shiftleft(high, 32).bitwiseOR(low)


def paragraphs(text: Column) -> Column:
    """The lines of a text; null and the empty text have none."""
    return F.when(F.coalesce(F.length(text), F.lit(0)) == 0, F.array().cast("array<string>")).otherwise(F.split(text, "\n", -1))


def sentences(text: Column) -> Column:
    """The pieces of the paragraphs between full stops, those without a character left out."""
    return F.when(F.coalesce(F.length(text), F.lit(0)) == 0, F.array().cast("array<string>")).otherwise(
        F.filter(F.split(text, "[.\n]", -1), lambda s: s != ""))


def fingerprint(text: Column) -> Column:
    """struct(lanes array<long>, signs array<long>). The last of `signs` is the number of sentences.

    Null and empty texts have all zeros.
    """
    zero = F.lit(0).cast("long")

    def wide(lines: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(WIDE - 1)), lambda i: F.aggregate(F.transform(lines, lambda p: F.xxhash64(i, p)), zero, _lanes_added))

    def hashed(parts: Column, seed: int) -> Column:
        return F.transform(parts, lambda s: F.xxhash64(F.lit(seed), s))

    def two(hashes: Column, k: int) -> Column:  # a text has fewer sentences than a lane can count
        return F.aggregate(hashes, zero, lambda a, h: a + F.shiftrightunsigned(h, k).bitwiseAND(F.lit(ONES)))

    # A lambda over an array of one value computes that value once for all lanes.
    lanes = F.transform(F.array(paragraphs(text)), wide)[0]
    signs = F.transform(F.array(sentences(text)), lambda parts: F.concat(
        F.flatten(F.transform(F.array(*[hashed(parts, seed) for seed in range(SIGNS)]), lambda h: F.array(*[two(h, k) for k in range(FIELD)]))),
        F.array(F.size(parts).cast("long"))))[0]
    return F.struct(lanes.alias("lanes"), signs.alias("signs"))


def plus(a: Column, b: Column) -> Column:
    """The fingerprint of all paragraphs of both."""
    return F.struct(*[F.zip_with(a[c], b[c], _lanes_added).alias(c) for c in ("lanes", "signs")])


def minus(a: Column, b: Column) -> Column:
    """The fingerprint of a without the paragraphs of b, which are all among those of a."""
    return F.struct(*[F.zip_with(a[c], b[c], _lanes_taken).alias(c) for c in ("lanes", "signs")])


def equal(a: Column, b: Column) -> Column:
    return (a["lanes"] == b["lanes"]) & (a["signs"] == b["signs"])


def n_sentences(a: Column) -> Column:
    return F.element_at(a["signs"], SIGNS * FIELD + 1)


def _product(a: Column, b: Column) -> Column:
    """The inner product of the sign sums: a lane that counted c of n sentences stands for 2c - n."""
    n, m, low = n_sentences(a), n_sentences(b), F.lit(MASK32)

    def two(x: Column, y: Column) -> Column:
        def one(k: int) -> Column:
            x_k, y_k = (F.shiftrightunsigned(v, k).bitwiseAND(low) for v in (x, y))
            return (2 * x_k - n).cast("double") * (2 * y_k - m).cast("double")
        return one(0) + one(FIELD)
    return F.aggregate(F.zip_with(F.slice(a["signs"], 1, SIGNS * FIELD), F.slice(b["signs"], 1, SIGNS * FIELD), two), F.lit(0.0), lambda s, v: s + v)


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: the cosine of the two multisets of sentences, as the sign lanes estimate it (error about 0.06).

    Equal fingerprints have 1; of a text and no text it is 0.
    """
    size = F.sqrt(_product(a, a) * _product(b, b))
    return (F.when(equal(a, b), F.lit(1.0)).when((n_sentences(a) == 0) | (n_sentences(b) == 0), F.lit(0.0))
            .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.try_divide(_product(a, b), size), F.lit(0.0))))))


def written(f: Column) -> Column:
    """The fingerprint in hexadecimal: 16 lanes of 8 digits, then the sign lanes of 8 digits, and the number of sentences."""
    return F.lower(F.array_join(F.transform(F.concat(f["lanes"], f["signs"]), lambda v: F.lpad(F.hex(v), 16, "0")), ""))


# ---- neighbours ------------------------------------------------------------------

def _bucketed(docs: DataFrame, id_col: str) -> DataFrame:
    """docs with `_bucket`, a number that grows with the id; null ids come first.

    Quantiles cut the ids into ranges, each range evenly into buckets. Where ids are uneven inside a range,
    buckets are uneven: a matter of speed only.
    """
    edges = docs.agg(F.count("*").alias("n"), F.percentile_approx(id_col, [i / RANGES for i in range(RANGES + 1)], 10_000).alias("q")).first()
    marks = sorted(set(edges["q"] or [0]))
    each = max(1, -(-edges["n"] // (RANGES * BUCKET_ROWS)))
    i = F.col(id_col)
    at = reduce(lambda a, b: a + b, [F.when(i >= m, 1).otherwise(0) for m in marks[1:]], F.lit(0))
    low = F.element_at(F.array(*[F.lit(m) for m in marks]), at + 1)
    high = F.element_at(F.array(*[F.lit(m) for m in marks[1:] + [marks[-1] + 1]]), at + 1)
    place = F.floor((i - low).cast("double") / (high - low) * each)
    bucket = at.cast("long") * each + F.greatest(F.lit(0), F.least(F.lit(each - 1), place)).cast("long")
    return docs.withColumn("_bucket", F.when(i.isNull(), F.lit(-1)).otherwise(bucket).cast("long"))


def with_next(docs: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
    """docs with a struct `next`: `columns` of the document that follows in descending order of id.

    After the last comes the first. Null ids come last; documents of one id are in order of `_hash`, a column
    that docs must have. Documents lie in buckets by id, and the first of a bucket is also put at the end of
    the bucket before, so each bucket is a window of its own.
    """
    rows = _bucketed(docs, id_col)
    tops = rows.groupBy("_bucket").agg(F.max(F.struct(F.col(id_col), F.bitwise_not(F.col("_hash")).alias("h"))).alias("t"))
    # The bucket of larger ids that comes before this one; before the first comes the last.
    around = Window.orderBy(F.desc("_bucket"))
    tops = (tops.withColumn("_before", F.coalesce(F.lag("_bucket").over(around), F.min("_bucket").over(Window.partitionBy())))
            .select(F.col("t")[id_col].alias("_id"), F.bitwise_not(F.col("t.h")).alias("_h"), "_before"))
    n = rows.select("_bucket").distinct().count()
    marked = rows.join(small(tops, n, 64), F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_h")), "left")
    here = F.struct(F.col("_bucket").alias("b"), F.lit(False).alias("ghost"))
    there = F.struct(F.col("_before").alias("b"), F.lit(True).alias("ghost"))
    placed = marked.withColumn("_at", F.explode(F.when(F.col("_before").isNull(), F.array(here)).otherwise(F.array(here, there))))
    order = Window.partitionBy("_at.b").orderBy("_at.ghost", F.desc_nulls_last(id_col), "_hash")
    followed = placed.withColumn("next", F.struct(*[F.lead(c).over(order).alias(c) for c in columns]))
    return followed.where(~F.col("_at.ghost")).select(*docs.columns, "next")


def edited(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next): one row per row of docs.

    edited: the last floor(n_chars / 2) code points replaced by the first as many, or all, of the next document
    in descending order of id. Null texts count as empty ones. A table of one document is followed by itself.
    Repeated rows stay; an empty table gives an empty result; other columns are not read.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(F.col(id_col).alias("id"), whole.alias("text"), F.xxhash64(whole).alias("_hash"), fingerprint(whole).alias("fp"))
    both = with_next(base, "id", ["text", "fp"]).withColumn("n_chars", F.char_length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    new = both.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - half), F.substring(F.col("next.text"), F.lit(1), half)))
    new = new.withColumn("edited_fp", fingerprint(F.col("edited")))
    return new.select("id", "n_chars", "edited", F.col("fp").alias("fingerprint"), F.col("edited_fp").alias("edited_fingerprint"),
                      likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next.fp")).alias("near_next"))
