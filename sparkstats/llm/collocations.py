"""Phrase collocations: a multikey three-way quicksort of suffix pointers, after routing by leading words.

Every word of a text begins a suffix: the language, then the word and up to four that follow it in its piece.
Suffixes are routed to ranges of leading words, as many words as it takes to make the ranges alike in size, so
that a very common word or pair spreads over several of them. In a range, the quicksort splits pointers by the
word at one place into less, equal and more; the weight of an equal part is the count of a phrase, and it goes on
at the next place. Parts that weigh less than the least count are abandoned, since no phrase within them reaches
it; only prefixes of a range's own two ends are kept at any weight, and summed with those of its neighbours.
"""

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from . import common

#: Words of a phrase at most, and its least count.
WORDS, LEAST = 5, 100
#: Bytes of text to a range of suffixes; suffixes drawn for each range to find where it begins; bytes of text that are cut into words at a time.
RANGE_BYTES, DRAWN, CHUNK = 12 << 20, 512, 4 << 20
UNKNOWN = "und"
#: What ends a piece, and what parts words within one.
PIECE_ENDS, BLANKS = ".,;:!?\x0A\x0B\x0C\x0D", " \x09"
KIND = np.zeros(256, np.uint8)
KIND[[ord(c) for c in BLANKS]], KIND[[ord(c) for c in PIECE_ENDS]] = 1, 2


class Suffixes:
    """The suffixes of texts: `names` are their languages and words in byte order, `codes` has a row per place.

    A code of 0 stands for no word; name i has code i + 1.
    """

    def __init__(self, langs: pa.Array, texts: pa.Array, most: int):
        raw, at = common.utf8(common.lower_utf8(texts))
        kind = KIND[raw]
        inside = kind == 0
        first = np.zeros(len(raw) + 1, bool)
        first[at] = True
        begin = inside.copy()
        begin[1:] &= ~inside[:-1] | first[1:-1]
        begin, size = np.flatnonzero(begin), np.diff(np.append(np.flatnonzero(begin), len(raw)))
        before = np.concatenate(([0], np.cumsum(inside, dtype=np.int32)))
        size = before[begin + size] - before[begin]
        ends = np.concatenate(([0], np.cumsum(size, dtype=np.int64)))
        words = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(raw[inside])))
        coded = pa.concat_arrays([words, pc.fill_null(langs.cast(pa.large_string()), UNKNOWN)]).dictionary_encode()
        order = pc.sort_indices(coded.dictionary).to_numpy()
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(1, len(order) + 1)
        self.names = coded.dictionary.take(pa.array(order))
        code = rank[coded.indices.to_numpy()]
        code, lang = code[:len(begin)], code[len(begin):]
        doc = np.searchsorted(at, begin, "right") - 1
        piece = np.cumsum(kind == 2, dtype=np.int32)[begin]
        last = np.ones(len(begin), bool)
        last[:-1] = (doc[1:] != doc[:-1]) | (piece[1:] != piece[:-1])
        stop = np.flatnonzero(last)
        reach = stop[np.searchsorted(stop, np.arange(len(begin)))] - np.arange(len(begin)) + 1 if len(begin) else begin
        codes = np.zeros((most + 1, len(begin)), np.int32)
        if len(begin):
            codes[0] = lang[doc]
        for k in range(most):
            codes[k + 1, :len(begin) - k] = np.where(reach > k, np.roll(code, -k), 0)[:max(0, len(begin) - k)]
        self.codes = codes
        self.weight = np.ones(len(begin), np.int64)

    def _keys(self, codes: np.ndarray) -> np.ndarray:
        """Rows of codes (doubled) as 64-bit numbers, as few a row as hold them, that sort like the rows."""
        bits = max(1, (2 * len(self.names) + 2).bit_length())
        each = 64 // bits
        out = []
        for i in range(0, len(codes), each):
            key = np.zeros(codes.shape[1], np.uint64)
            for row in codes[i:i + each]:
                key = key << np.uint64(bits) | row.astype(np.uint64)
            out.append(key)
        return np.stack(out)

    def sort(self) -> None:
        """Put equal suffixes together as one of their weight, in order."""
        keys = self._keys(self.codes.astype(np.int64) * 2)
        order = np.lexsort(keys[::-1])
        keys = keys[:, order]
        new = np.ones(len(order), bool)
        new[1:] = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
        at = np.flatnonzero(new)
        self.codes, self.weight = self.codes[:, order[at]], np.diff(np.append(at, len(order)))
        self.sorted_keys = np.ascontiguousarray(keys[:, at].T.astype(">u8"))

    def begins(self, marks: list[list[str]]) -> np.ndarray:
        """Where the sorted suffixes reach each of some marks, which are in order."""
        if not marks:
            return np.empty(0, np.int64)
        codes = np.zeros((len(self.codes), len(marks)), np.int64)
        names = self.names.cast(pa.large_binary()).to_pylist()
        for j, mark in enumerate(marks):
            for k, word in enumerate(mark):
                i = bisect_left(names, word.encode())
                if i == len(names) or names[i] != word.encode():  # between two names: what follows does not matter
                    codes[k, j] = 2 * i + 1
                    break
                codes[k, j] = 2 * (i + 1)
        keys = np.ascontiguousarray(self._keys(codes).T.astype(">u8"))
        width = f"S{keys.shape[1] * 8}"
        return np.searchsorted(self.sorted_keys.view(width).ravel(), keys.view(width).ravel())

    def part(self, a: int, b: int) -> tuple[bytes, bytes]:
        """A run of sorted suffixes with the names that it needs, as compressed Arrow streams."""
        used, codes = np.unique(np.append(self.codes[:, a:b].ravel(), 0), return_inverse=True)
        codes = codes[:-1].reshape(len(self.codes), b - a).astype(np.int32)
        names = pa.RecordBatch.from_arrays([self.names.take(pa.array(used[1:] - 1))], names=["name"])
        table = pa.RecordBatch.from_arrays([*map(pa.array, codes), pa.array(self.weight[a:b])], names=[*map(str, range(len(codes))), "weight"])
        return _stream(names), _stream(table)


def _stream(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unstreamed(data: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(data).read_next_batch()


def chunks(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, pa.Array]]:
    """(languages, texts) of some rows at a time, with CHUNK bytes of text at most; a longer text alone."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    a = 0
    while a < len(size):
        b = max(a + 1, int(np.searchsorted(size, (size[a - 1] if a else 0) + CHUNK, "right")))
        yield batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a)
        a = b


# ---- the quicksort ----------------------------------------------------------------

def quicksorted(codes: np.ndarray, weight: np.ndarray, least: int, ends: list[list[int]]) -> Iterator[tuple[tuple[int, ...], int]]:
    """(prefix, weight) of all prefixes of suffixes that weigh `least`, and of those that begin one of `ends`.

    codes has a row per place; 0 is no word. Pointers are split by the code at a place into less, equal and more.
    """
    stack = [(np.arange(codes.shape[1], dtype=np.int32), 0, (), tuple(range(len(ends))))]
    while stack:
        at, place, prefix, near = stack.pop()
        code = codes[place][at]
        if (gone := code == 0).any():
            at, code = at[~gone], code[~gone]
        if not len(at) or weight[at].sum(dtype=np.int64) < least and not near:
            continue
        pivot = int(np.sort(code[[0, len(code) // 2, -1]])[1])
        same = at[code == pivot]
        count = int(weight[same].sum(dtype=np.int64))
        on = tuple(e for e in near if ends[e][place] == pivot)
        if count >= least or on:
            yield (*prefix, pivot), count
            if place + 1 < len(codes):
                stack.append((same, place + 1, (*prefix, pivot), on))
        if len(same) < len(at):
            stack.append((at[code < pivot], place, prefix, tuple(e for e in near if 0 < ends[e][place] < pivot)))
            stack.append((at[code > pivot], place, prefix, tuple(e for e in near if ends[e][place] > pivot)))


# ---- counts -----------------------------------------------------------------------

def marks(texts: DataFrame, ranges: int, text_bytes: int, most: int) -> list[list[str]]:
    """Where the ranges of suffixes begin, but for the first: quantiles of suffixes drawn by chance. They decide sizes only."""
    rate = min(1.0, 6 * DRAWN * ranges / max(1, text_bytes))
    docs_rate = min(1.0, 20 * rate)

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in chunks(batch):
                s = Suffixes(lang, text, most)
                step = max(1, round(docs_rate / rate))
                codes = s.codes[:, ::step]
                names = ["", *s.names.to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array([[names[c] for c in row if c] for row in codes.T.tolist()], pa.list_(pa.string()))], names=["suffix"])

    drawn = texts.sample(docs_rate, seed=1) if docs_rate < 1 else texts
    dealt = drawn.mapInArrow(draw, "suffix array<string>").repartitionByRange(ranges, "suffix")
    return sorted((r["m"] for r in dealt.groupBy(F.spark_partition_id()).agg(F.min("suffix").alias("m")).collect()),
                  key=lambda m: [w.encode() for w in m])[1:]


def counts(docs: DataFrame, lang: str = "lang", text: str = "text", most: int = WORDS, least: int = LEAST) -> DataFrame:
    """(lang, size, phrase, f): phrases of up to `most` words that occur `least` times in the texts of a language.

    size 0 with an empty phrase has all words of the language, however few. The result lies in the shared folder.
    """
    spark: SparkSession = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang), F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // RANGE_BYTES))
    begin = marks(texts, ranges, total, most)
    held = spark.sparkContext.broadcast(begin)  # one suffix a range
    ranges = len(begin) + 1

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang_, text_ in chunks(batch):
                s = Suffixes(lang_, text_, most)
                s.sort()
                at = [0, *s.begins(held.value).tolist(), s.codes.shape[1]]
                full = [(n, a, b) for n, (a, b) in enumerate(zip(at, at[1:])) if a < b]
                parts = [s.part(a, b) for _, a, b in full]
                yield pa.RecordBatch.from_arrays([*(pa.array(v, pa.int32()) for v in ([n for n, _, _ in full], [b - a for _, a, b in full])),
                                                  *(pa.array([p[k] for p in parts], pa.binary()) for k in (0, 1))], names=["range", "rows", "names", "suffixes"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [p for batch in batches for p in zip(*[c.to_pylist() for c in batch.columns])]  # as compressed as they come
        if not parts:
            return
        number, names = parts[0][0], [_unstreamed(p[2]).column(0) for p in parts]
        coded = pa.concat_arrays(names).dictionary_encode()
        indices, at, size = coded.indices.to_numpy() + 1, 0, 0
        codes, weight = np.empty((most + 1, sum(p[1] for p in parts)), np.int32), np.empty(sum(p[1] for p in parts), np.int32)
        for name, (_, n, _, rows) in zip(names, parts):
            to, rows = np.concatenate(([0], indices[at:at + len(name)])).astype(np.int32), _unstreamed(rows)
            for i in range(most + 1):
                codes[i, size:size + n] = to[rows.column(i).to_numpy()]
            weight[size:size + n] = rows.column(most + 1).to_numpy()
            at, size = at + len(name), size + n
        del names, parts
        spelled = ["", *coded.dictionary.to_pylist()]
        where = {w: i for i, w in enumerate(spelled) if i}
        ends = [[where.get(w, 0) for w in m] + [0] * (most + 1 - len(m)) for m in held.value[max(0, number - 1):number + 1]]
        found = list(quicksorted(codes, weight, least, ends))
        yield pa.RecordBatch.from_arrays(
            [pa.array([spelled[p[0]] for p, _ in found], pa.string()), pa.array([len(p) - 1 for p, _ in found], pa.int32()),
             pa.array([" ".join(spelled[c] for c in p[1:]) for p, _ in found], pa.string()), pa.array([f for _, f in found], pa.int64())],
            names=["lang", "size", "phrase", "f"])

    routed = texts.mapInArrow(route, "range int, rows int, names binary, suffixes binary").repartitionById(ranges, "range")
    found = routed.mapInArrow(count, "lang string, size int, phrase string, f long")
    summed = found.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f"))
    return common.cut(summed.where((F.col("f") >= least) | (F.col("size") == 0)))


# ---- collocations -----------------------------------------------------------------

def mine(docs: DataFrame, lang: str = "lang", text: str = "text", most: int = WORDS, least: int = LEAST, inside: int = 100, first: int | None = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the collocations of each language, the best `first` (None: all).

    A-Z count as a-z. A candidate is a phrase of 2 to `most` words within a piece with a = f >= least; cut after
    some first words it has l and r, the counts of its parts, and floor(1000 a n / (l r)); its lowest cut, of equal
    ones the shortest first part, counts. Candidates with `inside` percent of their occurrences or more inside a
    longer candidate go. Arithmetic is exact while 1000 a n has 38 digits. A null language is `und`; null and empty
    texts have no words; texts of one word a piece have no candidate; repeated rows count again; an empty table has
    no rows; other columns are not read. Ties in score go by a, then by the phrase's bytes.
    """
    all_ = counts(docs, lang, text, most, least)
    sized = all_.where("size = 0").select(F.col("lang").alias("_lang"), F.col("f").alias("n"))
    known = all_.where("size > 0").select(F.col("lang").alias("_lang"), F.col("phrase").alias("_phrase"), F.col("f").alias("_f"))
    long = all_.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))

    def looked_up(rows: DataFrame, part: str, name: str) -> DataFrame:
        return rows.join(known.withColumnRenamed("_f", name), (F.col("lang") == F.col("_lang")) & (F.col(part) == F.col("_phrase"))).drop("_lang", "_phrase", part)

    cuts = long.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("head"),
                       F.array_join(F.slice("w", F.col("k") + 1, F.size("w")), " ").alias("tail"))
    cuts = looked_up(looked_up(cuts, "head", "l"), "tail", "r")
    cuts = cuts.join(sized, F.col("lang") == F.col("_lang")).drop("_lang")
    score = F.expr("(cast(1000 as decimal(38,0)) * cast(a as decimal(20,0)) * cast(n as decimal(20,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    lowest = cuts.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.first("n").alias("n"), F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    # What lies inside a longer candidate lies inside one that is longer by a word, with as many occurrences or more.
    shorter = long.where("size > 2").select("lang", "a", F.explode(F.array(
        F.array_join(F.slice("w", F.lit(1), F.col("size") - 1), " "), F.array_join(F.slice("w", F.lit(2), F.col("size") - 1), " "))).alias("phrase"))
    covered = shorter.groupBy(F.col("lang").alias("_lang"), F.col("phrase").alias("_phrase")).agg(F.max("a").alias("longer"))
    kept = (lowest.join(covered, (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("_phrase")), "left")
            .where(F.col("longer").isNull() | (100 * F.col("longer") < inside * F.col("a"))))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase"))
    out = kept.select("lang", rank.cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    return out if first is None else out.where(F.col("rank") <= first)
