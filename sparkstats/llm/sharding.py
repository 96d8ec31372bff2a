"""K-d tree partitioning: documents in shards of nearly equal bytes, near in their metadata.

The tree splits its heaviest boxes at weighted medians along their widest metadata dimension until every leaf
has the target bytes. Medians come from distributed histograms that are refined round by round, all boxes of a
level at once; the driver holds the tree and a histogram of it, never rows. Equal texts are one point with the
weight of all copies, so they share a shard. A point that alone outweighs an equal share of what is left is
weighed out first and gets a shard to itself; the tree then cuts the rest into the remaining shards.
"""

import math

from pyspark.sql import Column, DataFrame, functions as F

from .common import cut, numbered

SHARDS = 24
#: Bytes that a document has besides its text.
OVERHEAD = 8
#: Histogram buckets of a box, and rounds: the median is found to BUCKETS ** -ROUNDS of the box's width.
BUCKETS, ROUNDS = 256, 3


def size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(OVERHEAD)


def _groups(rows: DataFrame) -> DataFrame:
    """(h1, h2, weight, c0..c3): a point in [0, 1]^4 per distinct text: source, language, size and id of its first document.

    Every coordinate also has a share of the text's hash, so that points of one value can be told apart.
    """
    found = rows.groupBy("h1", "h2").agg(F.sum("size").alias("weight"), F.max("size").alias("each"),
                                         F.min(F.struct(F.col("id").isNull().alias("none"), "id", "source", "lang")).alias("first"))
    found = found.select("h1", "h2", "weight", "each", "first.id", "first.source", "first.lang")
    span = rows.agg(F.min("id").alias("a"), F.max("id").alias("b")).first()
    a, b = float(span["a"] or 0), float(span["b"] or 0)
    u = F.shiftrightunsigned("h1", 11).cast("double") / F.lit(float(1 << 53))

    def named(c: str) -> Column:
        return (F.pmod(F.xxhash64(c), F.lit(1024)).cast("double") + u) / 1024

    return found.select("h1", "h2", "weight", named("source").alias("c0"), named("lang").alias("c1"),
                        (F.log2(F.col("each") + u) / 40).alias("c2"),
                        ((F.coalesce(F.col("id").cast("double"), F.lit(a)) - a + u) / (b - a + 1)).alias("c3"))


DIMENSIONS = ["c0", "c1", "c2", "c3"]


def _chosen(dim: Column) -> Column:
    return F.array(*DIMENSIONS)[dim]


def _heavy(placed: DataFrame, leaves: int, total: int) -> list[tuple]:
    """(h1, h2) of the points that get a shard to themselves, heaviest first: fewer than `leaves`."""
    out, left = [], total
    for r in placed.orderBy(F.desc("weight"), "h1", "h2").limit(leaves - 1).collect():
        if r["weight"] * (leaves - len(out)) <= left:
            break
        out.append((r["h1"], r["h2"]))
        left -= r["weight"]
    return out


def tree(groups: DataFrame, shards: int | None = SHARDS, target: int | None = None) -> DataFrame:
    """groups with `shard`. The number of leaves is `shards`, or the total weight by `target` bytes."""
    spark = groups.sparkSession
    placed = cut(groups.withColumn("node", F.lit(0)))  # a stored column: the joins below are on values, not on a constant
    total = placed.agg(F.sum("weight")).first()[0] or 0
    leaves = shards or max(1, math.ceil(total / target))
    heavy = _heavy(placed, leaves, total) if leaves > 1 else []
    done = {-1 - i: i for i in range(len(heavy))}
    if heavy:
        own = spark.createDataFrame([(*key, -1 - i) for i, key in enumerate(heavy)], "_h1 long, _h2 long, _own int")
        met = placed.join(F.broadcast(own), (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2")), "left")
        placed = cut(met.withColumn("node", F.coalesce("_own", "node")).select(*groups.columns, "node"))
    open_, names = {0: (len(heavy), leaves - len(heavy))}, 1  # node: (first shard, number of shards)
    level = 0
    while open_:
        for node in [n for n, (_, k) in open_.items() if k == 1]:
            done[node] = open_.pop(node)[0]
        if not open_:
            break
        live = placed.where(F.col("node").isin([*open_])) if len(open_) < 64 else placed
        boxes = live.groupBy("node").agg(F.sum("weight").alias("w"), F.count("*").alias("n"), *[f(c).alias(f"{n}_{c}") for c in DIMENSIONS for n, f in (("lo", F.min), ("hi", F.max))]).collect()
        search = {}
        for b in boxes:
            if b["node"] in open_:
                dim = max(range(len(DIMENSIONS)), key=lambda i: b[f"hi_{DIMENSIONS[i]}"] - b[f"lo_{DIMENSIONS[i]}"])
                lo, hi = b[f"lo_{DIMENSIONS[dim]}"], b[f"hi_{DIMENSIONS[dim]}"]
                first, k = open_[b["node"]]
                k = min(k, b["n"])  # every shard gets a point, where there are enough
                if k == 1 or lo == hi:
                    done[b["node"]] = first
                    del open_[b["node"]]
                    continue
                open_[b["node"]] = first, k
                search[b["node"]] = {"dim": dim, "lo": lo, "hi": hi + (hi - lo) * 1e-9 + 1e-15, "below": 0, "n_below": 0, "w": b["w"], "n": b["n"], "goal": b["w"] * (k // 2) / k}
        for node in set(open_) - set(search):  # a box without points: its shards stay empty
            done[node] = open_.pop(node)[0]
        if not search:
            continue
        for _ in range(ROUNDS):
            table = spark.createDataFrame([(n, s["dim"], s["lo"], s["hi"]) for n, s in search.items()], "_node int, dim int, lo double, hi double")
            value = _chosen(F.col("dim"))
            near = live.join(F.broadcast(table), F.col("node") == F.col("_node")).where((value >= F.col("lo")) & (value < F.col("hi")))
            bucket = F.least(F.lit(BUCKETS - 1), F.floor((value - F.col("lo")) / (F.col("hi") - F.col("lo")) * BUCKETS).cast("int"))
            counts: dict[int, dict[int, tuple]] = {}
            for r in near.groupBy("node", bucket.alias("bucket")).agg(F.sum("weight").alias("w"), F.count("*").alias("n")).collect():
                counts.setdefault(r["node"], {})[r["bucket"]] = r["w"], r["n"]
            for node, s in search.items():
                width = (s["hi"] - s["lo"]) / BUCKETS
                below, n_below = s["below"], s["n_below"]
                for at in range(BUCKETS):
                    more, n_more = counts.get(node, {}).get(at, (0, 0))
                    if below + more >= s["goal"] or at == BUCKETS - 1:
                        break
                    below, n_below = below + more, n_below + n_more
                s["after"], s["n_after"] = below + more, n_below + n_more
                s["lo"], s["hi"], s["below"], s["n_below"] = s["lo"] + width * at, s["lo"] + width * (at + 1), below, n_below
        splits = []
        for node, s in search.items():
            first, k = open_.pop(node)
            # The last bucket goes to the nearer side that leaves points on both, and the shards by what both sides
            # really weigh, as far as they have points for them.
            low = s["n_below"] and (s["n_after"] == s["n"] or s["goal"] - s["below"] <= s["after"] - s["goal"])
            left, n_left, at = (s["below"], s["n_below"], s["lo"]) if low else (s["after"], s["n_after"], s["hi"])
            share = round(k * left / s["w"]) if s["w"] else k // 2
            mine = min(k - 1, max(1, min(max(share, k - (s["n"] - n_left)), n_left)))
            splits.append((node, s["dim"], float(at), names, names + 1))
            open_ |= {names: (first, mine), names + 1: (first + mine, k - mine)}
            names += 2
        cuts = spark.createDataFrame(splits, "_node int, dim int, at double, low int, high int")
        after = placed.join(F.broadcast(cuts), F.col("node") == F.col("_node"), "left")
        placed = after.withColumn("node", F.when(F.col("_node").isNull(), F.col("node")).when(_chosen(F.col("dim")) < F.col("at"), F.col("low")).otherwise(F.col("high"))).select(*groups.columns, "node")
        level += 1
        if level % 4 == 0:
            placed = cut(placed)
    names_ = spark.createDataFrame([*done.items()], "_node int, shard int")
    return placed.join(F.broadcast(names_), F.col("node") == F.col("_node")).select(*groups.columns, "shard")


def shard(docs: DataFrame, shards: int | None = SHARDS, target: int | None = None, id_col: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang") -> DataFrame:
    """(id, size, text_crc32, shard, slot): one row per row of docs.

    size: UTF-8 bytes of the text plus 8. Null texts count as empty and as equal. slot: 0, 1, 2, ... within each
    shard. Nulls in the id, source or language have a place of their own; repeated rows share a shard and get
    different slots; an empty table gives an empty result; other columns are not read.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = cut(docs.select(F.col(id_col).alias("id"), size(F.col(text)).alias("size"), F.crc32(whole.cast("binary")).alias("text_crc32"),
                           F.xxhash64(whole).alias("h1"), F.xxhash64(F.lit(1), whole).alias("h2"), F.col(source).alias("source"), F.col(lang).alias("lang")))
    leaves = tree(_groups(rows), shards, target).select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), "shard")
    named = rows.join(leaves, (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2"))).select("id", "size", "text_crc32", "h1", "shard")
    return numbered(cut(named), ["shard"], ["id", "h1"], "slot").drop("h1")
