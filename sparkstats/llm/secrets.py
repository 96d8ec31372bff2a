"""Secret scans: credentials by pattern, and weak parts that are reported only beside complementary ones.

Every text is searched by regular expressions for strong spans (assignments, access identifiers, long
hexadecimal strings) and for weak parts (account names, random-looking keys, endpoints). An interval join
then looks, within a scope of one document, for parts that complete each other: a weak part is reported only
where its complement lies at most `reach` code points away. DataFrame functions only.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import packed

#: kind, pattern, the group that is measured, its least length. Fixed values.
BASE = [
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
]
#: Weak parts: an identifier, a key and an endpoint.
WEAK = [
    ("account", r"""(?i)\b(?:access_?key_?id|client_?id|account|user(?:name)?|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@+-]{3,})""", 1, 3),
    ("key", r"(?<![A-Za-z0-9+/])(?=[A-Za-z+/]*[0-9])(?=[a-z0-9+/]*[A-Z])(?=[A-Z0-9+/]*[a-z])[A-Za-z0-9+/]{32,}={0,2}", 0, 32),
    ("endpoint", r"""(?i)\b(?:https?|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|s3|amqp)://[^\x20\x09-\x0D"'<>]+""", 0, 8),
]
KINDS = [k for k, *_ in BASE + WEAK]
#: What a kind offers to others: an identifier, a secret or an endpoint; and what completes it.
PART = {"assign": "secret", "access": "id", "hex": "secret", "account": "id", "key": "secret", "endpoint": "endpoint"}
NEEDS = {"account": ["secret"], "key": ["id", "endpoint"], "endpoint": ["secret"]}
REACH = 300


#: Texts that hold none of these have no match of the kind; a cheap test before the expression.
HINTS = {"assign": [":", "="], "access": ["AKIA"], "account": [":", "="], "key": ["AKIA", "://", ":", "="], "endpoint": ["://"]}
MATCH = "array<struct<k:int,gap:int,size:int,counts:boolean>>"


def matches(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """Leftmost non-overlapping matches in order, as (k, code points since the match before, code points, long enough).

    `split` leaves the pieces between the matches; `regexp_extract_all` gives the matches.
    """
    none = F.array().cast(MATCH)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    sizes = F.transform(found, lambda m: F.char_length(m))
    measured = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), lambda m: F.char_length(m)) if group else sizes
    gaps = F.transform(F.split(text, pattern, -1), lambda p: F.char_length(p))
    zipped = F.transform(
        F.filter(F.arrays_zip(gaps.alias("gap"), sizes.alias("size"), measured.alias("measured")), lambda z: z["size"].isNotNull()),
        lambda z: F.struct(F.lit(KINDS.index(kind)).alias("k"), z["gap"].alias("gap"), z["size"].alias("size"), (z["measured"] >= least).alias("counts")))
    there = F.regexp_like(text, F.lit(pattern))
    hint = F.lit(False)
    for part in HINTS.get(kind, [""]):
        hint = hint | F.contains(text, F.lit(part))
    return F.when(hint, F.when(there, zipped.cast(MATCH)).otherwise(none)).otherwise(none)


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text", reach: int = REACH) -> DataFrame:
    """(id, hash1, hash2, spans): one row per row of docs, spans an array of (start, k, end) by start.

    k numbers KINDS. Base spans are all there; of the weak parts, those with a complement within `reach`
    code points in the same document. Null counts as the empty text. hash1 and hash2 are hashes of the text.
    Repeated rows each get their own result; an empty table gives an empty one. Other columns are not read.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    found = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text).alias("hash1"), F.xxhash64(F.lit(1), text).alias("hash2"),
        F.monotonically_increasing_id().alias("row"),
        F.concat(*[matches(whole, *kind) for kind in BASE + WEAK]).alias("parts"))
    # Documents without parts stay as one row without a span.
    rows = found.select("id", "hash1", "hash2", "row", F.posexplode_outer("parts").alias("pos", "p")).select("id", "hash1", "hash2", "row", "pos", "p.*")
    so_far = Window.partitionBy("row", "k").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    placed = (rows.repartition(F.col("row")).withColumn("end", F.sum(F.col("gap") + F.col("size")).over(so_far).cast("int"))
              .withColumn("start", F.col("end") - F.col("size"))
              .withColumn("k", F.when(F.col("counts"), F.col("k"))))
    reported = linked(placed.drop("pos", "gap", "size", "counts"), ["row"], reach)
    return (reported.groupBy("row", "id", "hash1", "hash2")
            .agg(F.sort_array(F.collect_list(F.when(F.col("reported"), F.struct("start", "k", "end")))).alias("spans"))
            .drop("row"))


def linked(parts: DataFrame, scope: list[str], reach: int = REACH) -> DataFrame:
    """Rows (start, k, end) of a scope with `reported`: true for strong kinds, and for weak ones near a complement.

    Rows whose k is null count for nothing.

    An interval join by sorting: the nearest complement before a part is the one with the largest end among
    those that start no later, the nearest after it the one with the least start. Linear in the parts.
    """
    def is_part(role: str) -> Column:
        return F.col("k").isin([i for i, kind in enumerate(KINDS) if PART[kind] == role])

    order = Window.partitionBy(*scope).orderBy("start", "k", "end")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*scope).orderBy(F.desc("start"), F.desc("k"), F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    near = {}
    for role in ("id", "secret", "endpoint"):
        ends = F.max(F.when(is_part(role), F.col("end"))).over(before)
        starts = F.min(F.when(is_part(role), F.col("start"))).over(after)
        near[role] = F.coalesce(F.col("start") - ends <= reach, F.lit(False)) | F.coalesce(starts - F.col("end") <= reach, F.lit(False))
    reported = F.col("k") < len(BASE)
    for kind, needs in NEEDS.items():
        any_near = near[needs[0]]
        for role in needs[1:]:
            any_near = any_near | near[role]
        reported = reported | ((F.col("k") == KINDS.index(kind)) & any_near)
    return parts.withColumn("reported", F.coalesce(reported, F.lit(False)))


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined; spans are in order of start, then kind as listed."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["k"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def base_spans(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["k"] < len(BASE))


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["k"] == KINDS.index(kind))).cast("long")


def redacted(docs: DataFrame, id_col: str = "doc_id", text: str = "text", mask: str = "[SECRET]", reach: int = REACH) -> DataFrame:
    """docs with every reported span replaced by the mask (touching spans by one); all columns are kept.

    n_chars, where there is one, counts the new text. Null texts stay null.
    """
    found = (scan(docs, id_col, text, reach).where(F.size("spans") > 0)
             .groupBy(F.col("id").alias("_id"), F.col("hash1").alias("_hash1"), F.col("hash2").alias("_hash2")).agg(F.first("spans").alias("_spans")))
    row, whole = F.col("row"), F.col("row")[text]
    key = row[id_col].eqNullSafe(F.col("_id")) & (F.xxhash64(whole) == F.col("_hash1")) & (F.xxhash64(F.lit(1), whole) == F.col("_hash2"))
    pieces = F.aggregate(
        F.col("_spans"), F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")),
        lambda acc, s: F.when(s["start"] < acc["at"], F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out")))
        .otherwise(F.struct(s["end"].alias("at"), F.concat(acc["out"], F.array(F.substring(whole, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mask))).alias("out"))),
        lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(whole, acc["at"] + 1, F.lit(2147483647))))
    new = packed(docs).join(found, key, "left").withColumn("_new", F.when(F.col("_spans").isNull(), whole).otherwise(pieces))
    changed = {text: F.col("_new")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("_spans").isNull(), row["n_chars"]).otherwise(F.char_length("_new").cast(dict(docs.dtypes)["n_chars"]))
    return new.select(*[changed.get(c, row[c]).alias(c) for c in docs.columns])
