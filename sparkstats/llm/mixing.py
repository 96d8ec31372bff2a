"""Mixing sources to target weights: integer quotas of equal-token blocks by Sainte-Lague, then block selection.

A source's target is its share by weight, at most `most` times its own words; what is over goes to the others.
The targets are paid out in full, in blocks of equal size: the shards of a source get the blocks that fit into
its target and into them by highest quotients. What is less than a block, of a source or of its shards, is paid
in single words by the same rule, to the shards that are short of their share. A shard lies in a seeded order of
its documents as one stream of words; its words are taken from the front, and again from the front where a
stream is used up.
"""

import heapq

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import WORD, cut, packed, unpacked

#: Weights of the sources by code point, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: A source gives its words so many times at most.
MOST = 3
#: Blocks that the whole mix has, about.
BLOCKS = 20_000
#: Documents of a shard, about, and shards at most.
SHARD_ROWS, SHARDS = 20_000, 4096
SEED = 42


def words(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def targets(sizes: np.ndarray, weights: np.ndarray, most: float = MOST) -> np.ndarray:
    """Shares of the total by weight; a share stops at `most` times the size, the rest is shared anew."""
    out, free, left = np.zeros(len(sizes)), np.ones(len(sizes), dtype=bool), float(sizes.sum())
    while free.any():
        share = left * weights * free / weights[free].sum()
        over = free & (share > most * sizes)
        if not over.any():
            out[free] = share[free]
            break
        out[over] = most * sizes[over]
        free &= ~over
        left = float(sizes.sum()) - out[~free].sum()
    return out


def quotas(goals: np.ndarray, blocks: int, limits: np.ndarray | None = None) -> np.ndarray:
    """Sainte-Lague: `blocks` blocks, one after the other to the highest quotient goal / (2 * blocks so far + 1).

    Of equal quotients the first comes first; nobody gets more than the limit. Whole parts below the final
    divisor are given at once, so the loop runs only over the last few blocks of each.
    """
    goals = np.asarray(goals, dtype=float)
    limits = np.full(len(goals), blocks) if limits is None else np.asarray(limits)
    got = np.zeros(len(goals), dtype=np.int64)
    if goals.sum() <= 0 or blocks <= 0:
        return got
    got = np.minimum(np.maximum(np.floor(goals / goals.sum() * blocks).astype(np.int64) - 1, 0), limits)
    heap = [(-g / (2 * n + 1), i) for i, (g, n, most) in enumerate(zip(goals, got, limits)) if g > 0 and n < most]
    heapq.heapify(heap)
    for _ in range(blocks - int(got.sum())):
        if not heap:
            break
        _, i = heapq.heappop(heap)
        got[i] += 1
        if got[i] < limits[i]:
            heapq.heappush(heap, (-goals[i] / (2 * got[i] + 1), i))
    return got


def dues(held: np.ndarray, goal: np.ndarray, blocks: int = BLOCKS, most: int = MOST) -> np.ndarray:
    """Words that each (source, shard) gives; a source's add up to its target, rounded. held: its words.

    Nobody gives more than `most` times its words, and no source or shard is too small to give its share.
    """
    sizes, out = held.sum(axis=1), np.zeros_like(held)
    per_source = quotas(goal, int(round(goal.sum())), most * sizes)
    block = max(1, int(goal.sum() // blocks))
    for i, due in enumerate(per_source):
        if due:
            out[i] = block * quotas(held[i], int(due // block), most * held[i] // block)
            short = np.maximum(held[i] * (due / sizes[i]) - out[i], 0)
            out[i] += quotas(short, int(due - out[i].sum()), most * held[i] - out[i])
    return out


def mix(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", weights: tuple = WEIGHTS, blocks: int = BLOCKS, seed: int = SEED) -> DataFrame:
    """(id, hash, source, size, source_size, target, taken, nth): one row per row of docs.

    size: words; null and empty texts have none and give none. taken: words that the mix takes, repeats
    counted, 3 * size at most. Sources in order of code points, null last as a source of its own; sources are
    taken to be few, as one row per source and shard reaches the driver. Rows that agree in id and text are
    told apart by `nth` only. `hash` is a hash of the text. Equal inputs give equal results in any partitioning.
    """
    sized = cut(docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("hash"), F.col(source).alias("source"), words(F.col(text)).alias("size")))
    shards = int(min(SHARDS, max(1, sized.count() // SHARD_ROWS)))
    dealt = sized.withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), F.col("id"), F.col("hash")), F.lit(shards)).cast("int"))
    counted = dealt.groupBy("source", "shard").agg(F.sum("size").alias("n")).collect()
    names = sorted({r["source"] for r in counted if r["source"] is not None}) + [None] * any(r["source"] is None for r in counted)
    at = {name: i for i, name in enumerate(names)}
    held = np.zeros((len(names), shards), dtype=np.int64)
    for r in counted:
        held[at[r["source"]], r["shard"]] = r["n"]
    sizes = held.sum(axis=1)
    goal = targets(sizes.astype(float), np.array([weights[i % len(weights)] for i in range(len(names))]))
    due = dues(held, goal, blocks)
    rows = [(name, s, int(sizes[i]), float(goal[i]), int(due[i, s]), int(held[i, s])) for i, name in enumerate(names) for s in range(shards)]
    plan = docs.sparkSession.createDataFrame(rows, "_source string, _shard int, source_size long, target double, due long, held long")
    stream = Window.partitionBy("source", "shard").orderBy(F.xxhash64(F.lit(seed), F.col("hash"), F.col("id")), "id", "hash", "size")
    placed = (dealt.withColumn("end", F.sum("size").over(stream.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("nth", F.row_number().over(Window.partitionBy("source", "shard", "id", "hash").orderBy("size"))))
    rounds = F.when(F.col("held") > 0, F.floor(F.col("due") / F.col("held"))).otherwise(F.lit(0))
    rest = F.col("due") - F.col("rounds") * F.col("held")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - (F.col("end") - F.col("size"))))
    return (placed.join(F.broadcast(plan), F.col("source").eqNullSafe(F.col("_source")) & (F.col("shard") == F.col("_shard")))
            .withColumn("rounds", rounds)
            .select("id", "hash", "source", "size", "source_size", "target", (F.col("rounds") * F.col("size") + part).cast("long").alias("taken"), "nth"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """docs, each as often as the mix takes it, to the nearest whole number; all columns are kept.

    A document without words has no share: it stays once.
    """
    copies = F.when(F.col("size") == 0, F.lit(1)).otherwise(F.floor(F.col("taken") / F.col("size") + F.lit(0.5)).cast("int"))
    plan = (mix(docs, id_col, text, source).withColumn("copies", copies)
            .groupBy(F.col("id").alias("_id"), F.col("hash").alias("_hash"), F.col("source").alias("_source"))
            .agg(F.array_sort(F.collect_list(F.struct("nth", "copies"))).alias("_copies")))
    row = F.col("row")
    keyed = packed(docs).withColumn("_text", F.xxhash64(row[text]))
    key = row[id_col].eqNullSafe(F.col("_id")) & F.col("_text").eqNullSafe(F.col("_hash")) & row[source].eqNullSafe(F.col("_source"))
    joined = keyed.join(plan, key).withColumn("_nth", F.row_number().over(Window.partitionBy(row[id_col], "_text", row[source]).orderBy(F.lit(0))))
    times = F.element_at("_copies", F.col("_nth"))["copies"]
    return unpacked(joined.withColumn("_times", F.explode(F.array_repeat(F.lit(1), times))))
