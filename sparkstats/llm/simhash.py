"""SimHash near-duplicates: 64-bit fingerprints, and all links within a Hamming radius by bit-sliced comparison.

Fingerprints that differ in at most `radius` bits agree in two of `radius` + 2 blocks of bits, so only rows
of equal blocks meet. There the fingerprints lie in blocks of 64 rows as 64 vertical bit planes: one XOR
compares a query's bit with 64 rows, carry-save counters add up 64 distances at once, and a block is given
up as soon as all its distances exceed the radius.
"""

from itertools import accumulate, combinations
from math import ceil, comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import cut, packed, unpacked

BITS = 64
#: A bucket of more rows is cut into chunks, and each pair of chunks is a bucket.
BUCKET_ROWS = 8192
#: Pairs of a query and a block of 64 rows that are compared at once.
PAIRS_AT_ONCE = 1 << 16


def fingerprint_of(text: str | None, words: int = 3, seed: int = 42) -> int:
    """The unsigned fingerprint: a bit is 1 if it is set in over half of the shingles' hashes; no words give 0."""
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) < words:
        hashes = np.array([xxhash.xxh64_intdigest(joined, seed)], dtype=">u8")
    else:
        after = [0, *accumulate(len(w) + 1 for w in found)]
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(joined[s:e - 1], seed) for s, e in zip(after, after[words:])], dtype=">u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[at:at + (1 << 16)].view(np.uint8)).reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprint(text: Column, words: int = 3, seed: int = 42) -> Column:
    """The fingerprint of a text column as a signed 64-bit number; null counts as the empty text."""
    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint_of(t, words, seed) for t in texts], dtype=np.uint64).view(np.int64))
    return simhash(text)


def hex16(fp: Column) -> Column:
    """A signed 64-bit number as 16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# ---- comparison ---------------------------------------------------------------

def bit_planes(fps: np.ndarray) -> np.ndarray:
    """(blocks, bits) words: bit j of word [k, b] is bit b of fingerprint 64 k + j. fps: (rows, words). The last block is filled with zeros."""
    blocks, width = -(-len(fps) // 64), fps.shape[1] * 64
    padded = np.zeros((blocks * 64, fps.shape[1]), dtype=np.uint64)
    padded[:len(fps)] = fps
    bits = np.unpackbits(padded.view(np.uint8), axis=1, bitorder="little").reshape(blocks, 64, width)
    return np.packbits(bits.transpose(0, 2, 1), axis=2, bitorder="little").reshape(blocks, width * 8).view(np.uint64)


def within(query: np.ndarray, block: np.ndarray, planes: np.ndarray, allowed: np.ndarray, radius: int) -> np.ndarray:
    """For each (query fingerprint, block number): the rows of the block within the radius, as 64 bits. query: (pairs, words).

    `allowed` masks the rows that count. Distances are held in bit-sliced counters; `over` collects the rows
    whose count has passed the radius. Pairs whose rows are all over leave the comparison.
    """
    out, at = np.zeros(len(query), dtype=np.uint64), np.arange(len(query))
    digits = max(1, int(radius).bit_length())
    # The counters begin so high that a carry out of the last digit means: more than radius.
    begin, ones = (1 << digits) - 1 - radius, np.uint64(0xFFFFFFFFFFFFFFFF)
    count = [np.full(len(query), ones if begin >> d & 1 else 0, dtype=np.uint64) for d in range(digits)]
    over = ~allowed
    for b in range(planes.shape[1]):
        carry = planes[block, b] ^ (np.uint64(0) - (query[:, b // 64] >> np.uint64(b % 64) & np.uint64(1)))
        for d in range(digits):
            count[d], carry = count[d] ^ carry, count[d] & carry
        over = over | carry
        if b % 8 == 7:
            live = over != ones
            if not live.all():
                query, block, over, at = query[live], block[live], over[live], at[live]
                count = [c[live] for c in count]
            if not len(at):
                return out
    out[at] = ~over
    return out


def joined(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the classes of linked rows in place; a class is named by its first row."""
    while len(a):
        x, y = labels[a], labels[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while True:
            deeper = labels[labels]
            if (deeper == labels).all():
                break
            labels[:] = deeper


def joined_if(labels: np.ndarray, a: np.ndarray, b: np.ndarray, alike) -> None:
    """As `joined`, for those of the hits that `alike(row, row)` confirms.

    In each round a class asks about one of its hits at most, and hits inside a class are dropped unasked: n rows
    that are all alike take about n questions.
    """
    while True:
        apart = labels[a] != labels[b]
        a, b = a[apart], b[apart]
        if not len(a):
            return
        _, asked = np.unique(np.maximum(labels[a], labels[b]), return_index=True)
        yes = asked[[alike(i, j) for i, j in zip(a[asked].tolist(), b[asked].tolist())]]
        rest = np.ones(len(a), dtype=bool)
        rest[asked] = False
        joined(labels, a[yes], b[yes])
        a, b = a[rest], b[rest]


def classes(fps: np.ndarray, first: np.ndarray, end: np.ndarray, radius: int, alike=None) -> np.ndarray:
    """For sorted buckets: the first row that each row is connected to by links inside its bucket.

    first, end: the bucket of each row. Every row meets all later rows of its bucket. alike: see `joined_if`.
    """
    labels = np.arange(len(fps))
    rows = np.flatnonzero(end - labels > 1)
    if not len(rows):
        return labels
    planes = bit_planes(fps)
    blocks = (end[rows] - 1) // 64 - rows // 64 + 1
    for low, high in chunks(blocks, PAIRS_AT_ONCE):
        n = blocks[low:high]
        row = np.repeat(rows[low:high], n)
        block = row // 64 + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        base = block * 64
        above = np.clip(row + 1 - base, 0, 64)
        below = np.clip(end[row] - base, 0, 64)
        allowed = low_bits(below) & ~low_bits(above)
        hit = within(fps[row], block, planes, allowed, radius)
        some = np.flatnonzero(hit)
        bits = np.unpackbits(hit[some].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        k, j = np.nonzero(bits)
        a, b = row[some[k]], base[some[k]] + j
        joined(labels, a, b) if alike is None else joined_if(labels, a, b, alike)
    return labels


def low_bits(n: np.ndarray) -> np.ndarray:
    """Words whose n lowest bits are set, n from 0 to 64."""
    shift = np.minimum(n, 63).astype(np.uint64)
    return np.where(n >= 64, np.uint64(0xFFFFFFFFFFFFFFFF), (np.uint64(1) << shift) - np.uint64(1))


def chunks(sizes: np.ndarray, most: int):
    """Ranges of rows whose sizes add up to about `most`."""
    ends = np.cumsum(sizes)
    low = 0
    while low < len(sizes):
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield low, high
        low = high


def as_words(fps: pa.Array) -> np.ndarray:
    """(rows, words) of a column of 64-bit numbers, or of binary values of equal length."""
    if pa.types.is_int64(fps.type):
        return fps.to_numpy().view(np.uint64)[:, None]
    rows = fps.to_pylist()
    return np.frombuffer(b"".join(rows), np.uint64).reshape(len(rows), -1)


def as_column(fps: np.ndarray) -> pa.Array:
    return pa.array(fps[:, 0].view(np.int64)) if fps.shape[1] == 1 else pa.array([f.tobytes() for f in fps], pa.binary())


def whole_buckets(batches):
    """Sorted (k, ...) rows as tables of whole buckets."""
    held = []
    for batch in batches:
        if not batch.num_rows:
            continue
        k = batch.column("k").to_numpy()
        last = int(np.searchsorted(-(k != k[-1]).astype(np.int8), 0))  # where the last bucket, perhaps not ended, begins
        if last or held and held[-1].column("k")[-1].as_py() != k[0]:
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = [batch.slice(last)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _labelled(table: pa.Table, radius: int, words: int, alike=None) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of whole buckets and the first row that each is connected to. Bits past `words` words are not compared."""
    k, f = table["k"].to_numpy(), as_words(table["fp"])
    starts = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
    sizes = np.diff(np.concatenate((starts, [len(k)])))
    first = np.repeat(starts, sizes)
    return f, classes(f[:, :words], first, first + np.repeat(sizes, sizes), radius, alike)


def _links_of(f: np.ndarray, label: np.ndarray) -> pa.RecordBatch:
    apart = np.flatnonzero(label != np.arange(len(f)))
    return pa.RecordBatch.from_arrays([as_column(f[apart]), as_column(f[label[apart]])], names=["a", "b"])


def _bucket_links(radius: int, words: int):
    def run(batches):
        """Sorted (k, fp) rows in; (a, b) links out that connect what is connected within each bucket."""
        for table in whole_buckets(batches):
            yield _links_of(*_labelled(table, radius, words))
    return run


def _bucket_classes(radius: int, words: int):
    def run(batches):
        """Sorted (k, fp) rows in; (k, fp) rows out of the classes of two rows and more, k being a hash of all rows of the class."""
        for table in whole_buckets(batches):
            f, label = _labelled(table, radius, words)
            rows = np.flatnonzero(np.bincount(label, minlength=len(f))[label] > 1)
            rows = rows[np.argsort(label[rows], kind="stable")]
            ends = np.flatnonzero(np.concatenate((label[rows][1:] != label[rows][:-1], [True]))) + 1 if len(rows) else []
            names = [xxhash.xxh64_intdigest(f[rows[s:e]].tobytes()) - (1 << 63) for s, e in zip([0, *ends], ends)]
            k = np.repeat(np.array(names, dtype=np.int64), np.diff([0, *ends]))
            yield pa.RecordBatch.from_arrays([pa.array(k), as_column(f[rows])], names=["k", "fp"])
    return run


def _checked_links(radius: int, words: int, similarity: float):
    def run(batches):
        """Sorted (k, fp, shingles) rows in; (a, b) links out of rows within the radius whose shingles have the similarity."""
        for table in whole_buckets(batches):
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["shingles"]]
            yield _links_of(*_labelled(table, radius, words, lambda i, j: jaccard(sets[i], sets[j], similarity) >= similarity))
    return run


def jaccard(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Similarity of two sorted arrays of distinct numbers; 0 where their sizes alone put it below `least`."""
    low, high = sorted((len(a), len(b)))
    if not high:
        return 1.0
    if low < least * high:
        return 0.0
    both = np.concatenate((a, b))
    both.sort(kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return shared / (low + high - shared)


def links(fps: DataFrame, radius: int = 3) -> DataFrame:
    """(a, b) links among distinct fingerprints (column `fp`), enough to connect all that links connect.

    Buckets of more than BUCKET_ROWS rows are cut into pairs of chunks, so no task holds a whole bucket.
    """
    m = radius + 2
    edges = [BITS * i // m for i in range(m + 1)]

    def block(i: int) -> Column:
        return F.shiftrightunsigned("fp", edges[i]).bitwiseAND(F.lit((1 << edges[i + 1] - edges[i]) - 1))

    keys = [F.xxhash64(F.lit(i * m + j), block(i), block(j)) for i, j in combinations(range(m), 2)]
    return linked_in(fps.select("fp", F.explode(F.array(*keys)).alias("k")), radius)


def linked_in(rows: DataFrame, radius: int, words: int = 1) -> DataFrame:
    """(a, b) links of the fingerprints `fp` within the radius that share a bucket `k`, enough to connect what links connect."""
    kind = dict(rows.dtypes)["fp"]
    return _dealt(rows).mapInArrow(_bucket_links(radius, words), f"a {kind}, b {kind}")


def _dealt(rows: DataFrame) -> DataFrame:
    """(k, fp) rows sorted by buckets; a bucket of more than BUCKET_ROWS rows is cut into pairs of chunks."""
    hot = (rows.groupBy("k").count().where(F.col("count") > BUCKET_ROWS)
           .select(F.col("k").alias("_k"), F.ceil(F.col("count") / BUCKET_ROWS).cast("int").alias("chunks")))
    chunk = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1),
                        lambda other: F.xxhash64("k", F.least(chunk, other), F.greatest(chunk, other)))
    cold = rows.join(hot, F.col("k") == F.col("_k"), "left")
    split = cold.select("fp", F.explode(F.when(F.col("chunks").isNull(), F.array("k")).otherwise(pairs)).alias("k"))
    return split.repartition(F.col("k")).sortWithinPartitions("k", "fp")


# ---- connected components -------------------------------------------------------

def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected (a, b) edges; the root is the least node connected.

    Large-star and small-star steps in turn: each hangs a node's neighbours on the least of them. All that is
    kept between steps is one row per edge, written to the shared folder.
    """
    def sides(e):
        return e.select(F.col("u"), F.col("v")).union(e.select(F.col("v"), F.col("u"))).toDF("u", "v")

    def sign(e):
        row = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        return row["n"], row["s"]

    e = cut(edges.where(F.col("a") != F.col("b"))
            .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = sign(e)
    while before[0]:
        both = sides(e)
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(least, "u")
        e = cut(hung.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                .union(least).distinct())
        after = sign(e)
        if after == before:
            break
        before = after
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select("v", "v").distinct())


def _named(marked: DataFrame, found: DataFrame, distinct: DataFrame) -> DataFrame:
    """marked with the root of each fingerprint's component and the component's least id; found: the links."""
    rooted = components(found)
    firsts = distinct.join(rooted, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = firsts.groupBy("root").agg(F.min("least").alias("component_id"))
    named = firsts.select("fp", "root").join(lowest, "root").select(F.col("fp").alias("_fp"), "root", "component_id")
    return marked.join(named, F.col("fp") == F.col("_fp"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = 3, radius: int = 3) -> DataFrame:
    """(id, fp, component_id): one row per row of docs, with the least id reachable over links of fingerprints.

    Equal fingerprints are linked; a chain of links is one component. Null and empty texts have fingerprint 0
    and are linked like any other. A null id takes part and is the least only where no other id is reachable.
    Repeated rows stay. An empty table gives an empty result. Other columns are not read.
    """
    marked = cut(docs.select(F.col(id_col).alias("id"), fingerprint(F.col(text), words).alias("fp")))
    distinct = cut(marked.groupBy("fp").agg(F.min("id").alias("least")))
    return _named(marked, links(distinct.select("fp"), radius), distinct).select("id", "fp", "component_id")


# ---- near-dedup by similarity ---------------------------------------------------------

#: 64-bit words of a long fingerprint; bands of minimum hashes, and hashes in a band.
WORDS, BANDS, ROWS = 8, 16, 4
_MULTIPLY = np.random.default_rng(20).integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
_ADD = np.random.default_rng(21).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def differing(a: int, b: int, shared: int) -> float:
    """Probability that a bit differs between the fingerprints of `a` and `b` random shingles, `shared` of them common."""
    def ones(n, own, c):  # over half of n bits set, c of them in the common part
        return sum(comb(own, x) for x in range(own + 1) if 2 * (c + x) > n) / 2**own
    out = 0.0
    for c in range(shared + 1):
        x, y = ones(a, a - shared, c), ones(b, b - shared, c)
        out += comb(shared, c) / 2**shared * (x * (1 - y) + y * (1 - x))
    return out


def radius_of(similarity: float, bits: int = WORDS * 64, deviations: float = 4.0) -> int:
    """Bits that differ at a Jaccard similarity, and some standard deviations more: for long texts, or for short ones where more differ."""
    p = np.arccos(2 * similarity / (1 + similarity)) / np.pi
    sizes = [(a, b, ceil(similarity * (a + b) / (1 + similarity) - 1e-9)) for b in range(1, 25) for a in range(1, b + 1)]
    p = max([p, *(differing(a, b, s) for a, b, s in sizes if s <= a)])
    return int(bits * p + deviations * np.sqrt(bits * p * (1 - p)))


def _shingles(text: str | None, words: int) -> list[bytes]:
    found = (text or "").encode().lower().split()
    if len(found) < words:
        return [b" ".join(found)] if found else []
    joined, after = b" ".join(found), [0, *accumulate(len(w) + 1 for w in found)]
    return list({joined[s:e - 1] for s, e in zip(after, after[words:])})


def shingle_hashes_of(text: str | None, words: int = 5) -> np.ndarray:
    """Sorted 64-bit hashes of a text's distinct shingles."""
    return np.unique(np.frombuffer(b"".join([xxhash.xxh3_128_digest(x, 0)[:8] for x in _shingles(text, words)]), np.uint64))


def long_fingerprint_of(text: str | None, words: int = 5) -> tuple[bytes, list[int]]:
    """(fingerprint of WORDS * 64 bits and 128 bits that name the set, bands) of a text's distinct shingles; no words: zeros."""
    parts = _shingles(text, words)
    if not parts:
        return bytes(8 * WORDS + 16), [0] * BANDS
    digest = xxhash.xxh3_128_digest
    ones, least, all_of = np.zeros(64 * WORDS, dtype=np.int64), np.full(BANDS * ROWS, 0xFFFFFFFFFFFFFFFF, dtype=np.uint64), []
    for at in range(0, len(parts), 1 << 13):
        some = parts[at:at + (1 << 13)]
        raw = np.frombuffer(b"".join([digest(x, seed) for x in some for seed in range(WORDS // 2)]), np.uint8).reshape(len(some), 8 * WORDS)
        ones += np.unpackbits(raw, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        first = raw.view(np.uint64)[:, :1]
        all_of.append(first[:, 0])
        h = first * _MULTIPLY + _ADD
        least = np.minimum(least, (h ^ h >> np.uint64(29)).min(axis=0))
    bands = [xxhash.xxh64_intdigest(b.tobytes(), i) - (1 << 63) for i, b in enumerate(least.reshape(BANDS, ROWS))]
    name = digest(np.unique(np.concatenate(all_of)).tobytes())
    return np.packbits(2 * ones > len(parts), bitorder="little").tobytes() + name, bands


def long_fingerprint(text: Column, words: int = 5) -> Column:
    @F.arrow_udf("struct<fp:binary,bands:array<bigint>>")
    def run(texts: pa.Array) -> pa.Array:
        found = [long_fingerprint_of(t.as_py(), words) for t in texts]
        return pa.StructArray.from_arrays([pa.array([f for f, _ in found], pa.binary()), pa.array([b for _, b in found], pa.list_(pa.int64()))], names=["fp", "bands"])
    return run(text)


def shingle_hashes(text: Column, words: int = 5) -> Column:
    @F.arrow_udf("binary")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([shingle_hashes_of(t.as_py(), words).tobytes() for t in texts], pa.binary())
    return run(text)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = 5, similarity: float = 0.8) -> DataFrame:
    """One document of each group of near copies: the one with the least id (null after all others); all columns are kept.

    Two documents are linked if their sets of shingles have the similarity, which is checked on the shingles' hashes
    where a band of minimum hashes agrees and the fingerprints lie within the radius; a chain of links is one group.
    At 0.8 a band agrees for all but 2 of 10,000 pairs, and the radius, four deviations wide, loses fewer. Null and empty texts are one group. Of rows with the id that
    stays, the one with the least (text hash, other sortable columns) stays, whatever the partitioning.
    """
    marked = cut(docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("hash"), long_fingerprint(F.col(text), words).alias("f"))
                 .select("id", "hash", "f.fp", "f.bands"))
    distinct = cut(marked.groupBy("fp").agg(F.min("id").alias("least"), F.first("bands").alias("bands"), F.min(F.struct(F.col("id").isNull(), "id", "hash")).alias("s")))
    buckets, radius = distinct.select("fp", F.explode("bands").alias("k")), radius_of(similarity)
    # Rows near another, by classes: most classes are found in many bands and are checked in one.
    near = cut(_dealt(buckets).mapInArrow(_bucket_classes(radius, WORDS), "k long, fp binary").distinct())
    nodes = distinct.join(near.select("fp").distinct(), "fp").select("fp", F.col("s.id").alias("_id"), F.col("s.hash").alias("_hash"))
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("hash"), F.col(text).alias("text"))
    sets = (texts.join(nodes, F.col("id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash"))).dropDuplicates(["fp"])
            .select("fp", shingle_hashes(F.col("text"), words).alias("shingles")))
    dealt = near.join(sets, "fp").repartition(F.col("k")).sortWithinPartitions("k", "fp")
    linked = dealt.select("k", "fp", "shingles").mapInArrow(_checked_links(radius, WORDS, similarity), "a binary, b binary")
    found = _named(marked.drop("bands"), linked, distinct.select("fp", "least"))
    first = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull(), "id", "hash")).alias("s"))
    kept = first.select(F.col("s.id").alias("_id"), F.col("s.hash").alias("_hash"))
    row = F.col("row")
    hashed = packed(docs).withColumn("_text_hash", F.xxhash64(row[text]))
    mine = hashed.join(kept, row[id_col].eqNullSafe(F.col("_id")) & (F.col("_text_hash") == F.col("_hash")), "left_semi")
    # Rows with one id and text: nearly always one.
    plain = [row[c] for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind and c not in (id_col, text)]
    same = Window.partitionBy(row[id_col], "_text_hash").orderBy(*plain, F.lit(0))
    return unpacked(mine.withColumn("_rank", F.row_number().over(same)).where(F.col("_rank") == 1))
