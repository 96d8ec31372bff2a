"""Language-model scores by logistic context mixing.

A text is a kind, coded first, and a sequence of tokens: its words in lower case, then an end, which is the
empty word. The kind is a hash of its most frequent short word, which tells much about its language.

A token is coded in the order of the text, after the one and the two tokens before it. A bit says whether the training
texts hold it after the same two; if not, a second bit whether they hold it after the same one. A token that is
there is then told by its share of what follows; any other is spelled. A bit that has one possible value is not
coded. The counts of token pairs and triples are exact up to hashes of 40 bits and grow with the corpus.

A word is spelled character by character, a character bit by bit along a prefix code. Several predictors guess each bit
from counts under a hashed context: the last 0 to 4 characters and all of the word so far, some with the kind.
Their logits are mixed by weights that a gate chooses by how much the longest contexts have seen, and the mixed
guess is refined by an adaptive map. Every distinct word is spelled once for each kind. The two bits of a token are
guessed, mixed and refined in the same way, from how often its contexts occur, what the two tokens before it were
coded by, and the kind. Shares and spelling leave out no word that another way could have told, so that the probabilities of
all texts sum to less than one.

Counts come from all training words. Weights and map of the letters are learned online: a batch is guessed first, by counts
without the occurrence at hand, and then learned from. Those of the tokens' bits are learned from all training tokens,
each by counts without itself.
"""

import heapq
import uuid
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .common import Tokens, delete, lower_utf8, new_path, utf8

#: log2 of the slots of each predictor's table: contexts of 0 to 4 characters, the word so far, the same with the kind.
TABLE_BITS = (14, 17, 19, 20, 20, 21, 21)
#: Contexts of characters that go with the kind; kinds; longest short word in bytes.
WITH_KIND, KINDS, SHORT = (0, 1, 2, 3), 16, 3
ORDERS = len(TABLE_BITS)
SLOTS = [0, *np.cumsum([1 << b for b in TABLE_BITS]).tolist()]
#: The end of a word is a symbol beside the 256 bytes.
END = 256
#: Gates: steps of confidence of the word so far, and of the last four characters. Cells of the refining map.
GATE_STEPS, CELLS = 6, 24
MIX_SETS = GATE_STEPS * GATE_STEPS
PRIOR = 0.4
#: Text bytes whose words are numbered together; words that are coded at once; bits between two weight updates, guessed at once.
GROUP_BYTES, WORDS_AT_ONCE, BITS_AT_ONCE, GUESSED_AT_ONCE = 8 << 20, 4096, 1 << 16, 1 << 15
#: Bits of the hash of a pair or triple of tokens; tokens whose pairs are sorted together, with their places in the bits left.
KEY_BITS, SLICE = 40, 1 << 22
#: Tokens, or words of groups, for each part in which pairs, or words, are counted.
PART_TOKENS, PART_WORDS = 1 << 20, 1 << 18
#: A token's bits: classes of how often a context occurs, and what the two tokens before were coded by.
CLASSES, PAST = 8, 9
SITUATIONS = KINDS * PAST * CLASSES * CLASSES
#: Ways in the situations of one kind.
OF_KIND = 3 * PAST * CLASSES * CLASSES


# ---- bits --------------------------------------------------------------------------

def prefix_code(frequency: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A Huffman code of the 257 symbols: where each symbol's path begins in (nodes, bits), one more entry at the end."""
    heap = [(int(f) + 1, s) for s, f in enumerate(frequency)]
    heapq.heapify(heap)
    parent, name = {}, len(frequency)
    while len(heap) > 1:
        (a, x), (b, y) = heapq.heappop(heap), heapq.heappop(heap)
        parent[x], parent[y] = (name, 0), (name, 1)
        heapq.heappush(heap, (a + b, name))
        name += 1
    starts, nodes, bits = [0], [], []
    for s in range(len(frequency)):
        path, at = [], s
        while at in parent:
            at, bit = parent[at]
            path.append((at - len(frequency), bit))
        for node, bit in reversed(path):
            nodes.append(node)
            bits.append(bit)
        starts.append(len(nodes))
    return np.array(starts), np.array(nodes, dtype=np.uint64), np.array(bits, dtype=np.uint8)


@dataclass
class Bits:
    """The bits of a batch of words: the word of each, its slots in the predictors' tables, its value."""

    word: np.ndarray
    slots: np.ndarray
    value: np.ndarray

    def part(self, at: int, n: int) -> "Bits":
        return Bits(self.word[at:at + n], self.slots[:, at:at + n], self.value[at:at + n])


def coded(words: pa.Array, kind: np.ndarray, code) -> Bits:
    starts, nodes, values = code
    raw, at = utf8(words)
    n, size = len(words), np.diff(at)
    # Each word's bytes, then its end.
    symbols = np.full(len(raw) + n, END, dtype=np.uint64)
    word = np.repeat(np.arange(n), size + 1)
    ends = np.cumsum(size + 1) - 1
    inside = np.ones(len(symbols), dtype=bool)
    inside[ends] = False
    symbols[inside] = raw
    place = np.arange(len(symbols)) - np.repeat(ends - size, size + 1)
    contexts = [np.zeros(len(symbols), dtype=np.uint64)]
    packed = np.zeros(len(symbols), dtype=np.uint64)
    for k in range(1, 5):
        before = np.full(len(symbols), 257, dtype=np.uint64)
        here = place >= k
        before[here] = symbols[np.flatnonzero(here) - k]
        packed = packed | before << np.uint64(9 * (k - 1))
        contexts.append(packed.copy())
    so_far = _prefix_hashes(symbols, place, word, ends - size)
    kinds = (kind.astype(np.uint64) + np.uint64(1))[word] << np.uint64(40)
    contexts = [c + kinds if o in WITH_KIND else c for o, c in enumerate(contexts)] + [so_far, so_far + kinds]
    first, many = starts[symbols.astype(np.int64)], np.diff(starts)[symbols.astype(np.int64)]
    of = np.repeat(np.arange(len(symbols)), many)
    step = np.repeat(first, many) + np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
    node = nodes[step] * np.uint64(0xBF58476D1CE4E5B9)
    slots = np.empty((ORDERS, len(of)), dtype=np.int32)
    for o, bits in enumerate(TABLE_BITS):
        mixed = (contexts[o] + np.uint64(o + 1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed = mixed ^ (mixed >> np.uint64(29))
        slot = mixed[of]
        slot += node
        slot *= np.uint64(0x94D049BB133111EB)
        slot >>= np.uint64(64 - bits)
        slots[o] = slot
        slots[o] += SLOTS[o]
    return Bits(word[of], slots, values[step])


def _prefix_hashes(symbols, place, word, begin) -> np.ndarray:
    """A hash of the word so far, before each symbol: a polynomial in the place, modulo 2^64."""
    terms = (symbols + np.uint64(1)) * _powers(int(place.max(initial=0)))[place]
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)))
    return total[:-1] - total[begin][word]


def _powers(most: int) -> np.ndarray:
    return np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(most, 0x5851F42D4C957F2D, dtype=np.uint64))), dtype=np.uint64)


# ---- model ---------------------------------------------------------------------------

@dataclass
class Model:
    """The prefix code, counts of zeros and ones per slot, mixing weights per gate, and the refining map's counts."""

    code: tuple
    counts: np.ndarray
    weights: np.ndarray | None = None
    cells: np.ndarray | None = None
    ready: dict = field(default_factory=dict)

    def __post_init__(self):
        if self.weights is None:
            self.weights = np.full((MIX_SETS, ORDERS), 0.3)
        if self.cells is None:
            self.cells = np.stack([_cell_centres() * 50, np.full(CELLS, 50.0)])

    def inputs(self, b: Bits) -> tuple[np.ndarray, np.ndarray]:
        """(logits per predictor, gate) of each bit; the tables of logits and gates are made once."""
        if not self.ready:
            zeros, ones = self.counts
            seen = (zeros + ones)[SLOTS[ORDERS - 2]:]
            self.ready |= {"logits": np.log((ones + np.float32(PRIOR)) / (zeros + np.float32(PRIOR))), "steps": _steps(seen).astype(np.int8)}
        steps = [self.ready["steps"][b.slots[o] - SLOTS[ORDERS - 2]].astype(np.int32) for o in (ORDERS - 1, ORDERS - 2)]
        return self.ready["logits"][b.slots], steps[0] * GATE_STEPS + steps[1]

    def inputs_without(self, b: Bits) -> tuple[np.ndarray, np.ndarray]:
        """The same without one occurrence of the bit itself."""
        if "pairs" not in self.ready:
            self.ready["pairs"] = np.ascontiguousarray(self.counts.T).ravel()
        at = b.slots * 2 + b.value
        same, other = self.ready["pairs"][at], self.ready["pairs"][at ^ 1]
        same -= 1
        np.maximum(same, 0, out=same)
        steps = [_steps(same[o] + other[o]) for o in (ORDERS - 1, ORDERS - 2)]
        same += np.float32(PRIOR)
        other += np.float32(PRIOR)
        same /= other
        logits = np.log(same, out=same)
        logits *= np.where(b.value == 1, np.float32(1), np.float32(-1))
        return logits, steps[0] * GATE_STEPS + steps[1]

    def guess(self, logits: np.ndarray, gate: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(mixed probability of a one, its cell, refined probability)."""
        z = np.clip((self.weights.T.astype(np.float32)[:, gate] * logits).sum(axis=0), -12, 12)
        p = 1 / (1 + np.exp(-z))
        place = (z + 12) * ((CELLS - 1) / 24)
        cell = np.minimum(place.astype(np.int32), CELLS - 2)
        share = place - cell
        rate = (self.cells[0] / self.cells[1]).astype(np.float32)
        refined = rate[cell] * (1 - share) + rate[cell + 1] * share
        return p, place, np.clip((p + refined) / 2, 1e-6, 1 - 1e-6)

    def learn(self, b: Bits, weight: np.ndarray, squares: np.ndarray) -> float:
        """Guess and then learn, some bits at a time; returns the weight of what was learned from."""
        for at in range(0, len(b.value), BITS_AT_ONCE):
            part = b.part(at, BITS_AT_ONCE)
            w = weight[part.word]
            logits, gate = self.inputs_without(part)
            p, place, _ = self.guess(logits, gate)
            wrong = w * (part.value - p)
            mass = np.maximum(np.bincount(gate, w, minlength=MIX_SETS), 1e-9)
            step = np.stack([np.bincount(gate, wrong * x, minlength=MIX_SETS) for x in logits], axis=1) / mass[:, None]
            squares *= 0.9
            squares += 0.1 * step * step
            self.weights += np.where(mass[:, None] > 1e-6, 0.02 * step / (np.sqrt(squares) + 1e-4), 0)
            cell = np.round(place).astype(np.int32)
            self.cells += np.stack([np.bincount(cell, w * part.value, minlength=CELLS), np.bincount(cell, w, minlength=CELLS)])
        return float(weight.sum())

    def log10(self, words: pa.Array, kind: np.ndarray) -> np.ndarray:
        """log10 of the probability of each word in texts of a kind."""
        out = np.zeros(len(words))
        for at in range(0, len(words), WORDS_AT_ONCE):
            part = words.slice(at, WORDS_AT_ONCE)
            b = coded(part, kind[at:at + WORDS_AT_ONCE], self.code)
            for low in range(0, len(b.value), GUESSED_AT_ONCE):
                sub = b.part(low, GUESSED_AT_ONCE)
                p = self.guess(*self.inputs(sub))[2]
                out[at:at + len(part)] += np.bincount(sub.word, np.log10(np.where(sub.value == 1, p, 1 - p)), minlength=len(part))
        return out


def _steps(seen: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(seen + 1) / 2, GATE_STEPS - 1).astype(np.int32)


def _cell_centres() -> np.ndarray:
    return 1 / (1 + np.exp(-np.linspace(-12, 12, CELLS)))


# ---- packed numbers and words --------------------------------------------------------

def pack(numbers: np.ndarray) -> bytes:
    """Natural numbers as compressed planes of bytes, in the least width that holds them."""
    top = int(numbers.max(initial=0))
    width = next(w for w in (1, 2, 4, 8) if top < 1 << 8 * w)
    planes = numbers.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes()
    return bytes([width]) + len(planes).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    width, size = data[0], int.from_bytes(data[1:9], "little")
    planes = np.frombuffer(pa.decompress(data[9:], size, codec="zstd", asbytes=True), np.uint8) if size else np.empty(0, np.uint8)
    return np.ascontiguousarray(planes.reshape(width, -1).T).view(f"<u{width}").ravel().astype(np.int64)


def pack_words(words: pa.Array) -> dict:
    raw, at = utf8(words)
    return {"raw": pack(raw), "sizes": pack(np.diff(at))}


def unpack_words(raw: list[bytes], sizes: list[bytes]) -> pa.Array:
    """The words of several packed lists, one after the other."""
    size = np.concatenate([unpack(x) for x in sizes])
    at = np.concatenate(([0], np.cumsum(size))).astype(np.int64)
    bytes_ = np.concatenate([unpack(x).astype(np.uint8) for x in raw])
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(at), pa.py_buffer(bytes_))


def scattered(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def word_hashes(words: pa.Array) -> np.ndarray:
    """64 bits of each word: a polynomial in the place of its bytes, scattered."""
    raw, at = utf8(words)
    size = np.diff(at)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((raw + np.uint64(1)) * _powers(int(size.max(initial=0)))[np.arange(len(raw)) - np.repeat(at[:-1], size)], dtype=np.uint64)))
    return scattered(total[at[1:]] - total[at[:-1]] + (size.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))


def each_row(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


# ---- training the letters on Spark ------------------------------------------------------

PARTS = "part int, raw binary, sizes binary, kind binary, n binary, c binary, occurrences long, distinct long, g array<long>, at array<binary>"


def word_parts(numbered: DataFrame, parts: int) -> DataFrame:
    """The numbered words of all groups in parts by their hash: a row has a part's different words by kind.

    n: a word's training occurrences in texts of its kind, c: in all. at: where the words of each group g are.
    """
    def dealt(batches):
        for row in each_row(batches):
            words = unpack_words([row["raw"]], [row["sizes"]])
            kind, of = np.divmod(np.cumsum(unpack(row["numbers"])), len(words))
            n = unpack(row["n"])
            order, cuts = parts_of_words(word_hashes(words)[of], parts)
            for p in np.flatnonzero(np.diff(cuts)):
                i = order[cuts[p]:cuts[p + 1]]
                yield pa.RecordBatch.from_pylist([{"part": int(p), "of": row["g"], "kind": pack(kind[i]), "n": pack(n[i])} | pack_words(words.take(pa.array(of[i])))], schema=sent)
    sent = pa.schema([("part", pa.int32()), ("of", pa.int64()), ("raw", pa.binary()), ("sizes", pa.binary()), ("kind", pa.binary()), ("n", pa.binary())])

    def gathered(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("of").to_pydict()
        words = unpack_words(rows["raw"], rows["sizes"]).dictionary_encode()
        kinds, n = [unpack(x) for x in rows["kind"]], np.concatenate([unpack(x) for x in rows["n"]])
        rank = np.argsort(word_hashes(words.dictionary), kind="stable")  # the same order in every run
        place = np.empty(len(rank), dtype=np.int64)
        place[rank] = np.arange(len(rank))
        code = place[words.indices.to_numpy()]
        keys, at = np.unique(code * KINDS + np.concatenate(kinds), return_inverse=True)
        c = np.bincount(code, n).astype(np.int64)
        ends = np.cumsum([len(k) for k in kinds])
        row = {"part": rows["part"][0], "kind": pack(keys % KINDS), "n": pack(np.bincount(at, n).astype(np.int64)), "c": pack(c[keys // KINDS]),
               "occurrences": int(c.sum()), "distinct": int((c > 0).sum()), "g": rows["of"], "at": [pack(x) for x in np.split(at, ends[:-1])]}
        row |= pack_words(words.dictionary.take(pa.array(rank[keys // KINDS])))
        return pa.Table.from_pylist([row], schema=pa.schema([("part", pa.int32()), *[(x, pa.binary()) for x in ("raw", "sizes", "kind", "n", "c")], ("occurrences", pa.int64()),
                                                             ("distinct", pa.int64()), ("g", pa.list_(pa.int64())), ("at", pa.list_(pa.binary()))]))
    return numbered.select("g", "raw", "sizes", "numbers", "n").mapInArrow(dealt, "part int, of long, raw binary, sizes binary, kind binary, n binary").groupBy("part").applyInArrow(gathered, PARTS)


def parts_of_words(hashes: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(order by part, where each part begins in it) of words with these hashes."""
    part = (hashes % np.uint64(parts)).astype(np.int32)
    return np.argsort(part, kind="stable"), np.concatenate(([0], np.cumsum(np.bincount(part, minlength=parts))))


def trained_words(batches):
    """(words, kinds, occurrences) of rows of word parts, some words at a time; those without occurrences are left out."""
    for row in each_row(batches):
        n = unpack(row["n"])
        i = np.flatnonzero(n)
        words, kind = unpack_words([row["raw"]], [row["sizes"]]).take(pa.array(i)), unpack(row["kind"])[i]
        for at in range(0, len(i), WORDS_AT_ONCE):
            yield words.slice(at, WORDS_AT_ONCE), kind[at:at + WORDS_AT_ONCE], n[i[at:at + WORDS_AT_ONCE]].astype(float)


def shared_tables(spark, code: tuple, counts: np.ndarray):
    """The code and the tables as a broadcast variable, packed: counts keep 9 significant bits."""
    rounded = ((counts.view(np.uint32) + np.uint32(1 << 14)) & np.uint32(0xFFFF8000)).astype(np.uint32)
    return spark.sparkContext.broadcast({"code": code, "packed": zlib.compress(rounded.tobytes(), 1)})


def tables_of(held) -> tuple:
    """(code, counts), unpacked once in each worker process."""
    own = held.value
    if "counts" not in own:
        own["counts"] = np.frombuffer(zlib.decompress(own["packed"]), np.float32).reshape(2, -1)
    return own["code"], own["counts"]


def train(parts: DataFrame):
    """The model of the words of `word_parts`, and its shared tables.

    The driver and each task hold the tables, whose size is fixed by TABLE_BITS; all else is spread over tasks.
    """
    spark = parts.sparkSession
    words = parts.select("raw", "sizes", "kind", "n")

    def letters(batches):
        total = np.zeros(END + 1)
        for part, _, c in trained_words(batches):
            raw, at = utf8(part)
            total[:END] += np.bincount(raw, np.repeat(c, np.diff(at)), minlength=END)
            total[END] += c.sum()
        yield pa.RecordBatch.from_pydict({"s": pa.array(np.arange(END + 1), pa.int32()), "f": pa.array(total)})
    frequency = np.zeros(END + 1)
    for r in words.mapInArrow(letters, "s int, f double").groupBy("s").agg(F.sum("f").alias("f")).collect():
        frequency[r["s"]] = r["f"]
    code = prefix_code(frequency / max(1.0, frequency.sum()) * 1e9)
    block = 1 << 16

    def contexts(batches):
        counts = np.zeros((2, SLOTS[-1]))
        for part, kind, n in trained_words(batches):
            b = coded(part, kind, code)
            weight, side = n[b.word], b.value * np.int64(SLOTS[-1])
            for slots in b.slots:
                np.add.at(counts.ravel(), slots + side, weight)
        for at in range(0, SLOTS[-1], block):
            part = counts[:, at:at + block]
            if part.any():
                yield pa.RecordBatch.from_pydict({"at": pa.array([at], pa.int64()), "counts": pa.array([pack(part.ravel().astype(np.int64))], pa.binary())})

    def added(rows: pa.Table) -> pa.Table:
        total = sum(unpack(x.as_py()) for x in rows.column("counts"))
        return pa.table({"at": pa.array([rows.column("at")[0].as_py()], pa.int64()), "counts": pa.array([pack(total)], pa.binary())})
    sums = words.mapInArrow(contexts, "at long, counts binary").groupBy("at").applyInArrow(added, "at long, counts binary")
    counts = np.zeros((2, SLOTS[-1]), dtype=np.float32)
    for r in sums.toLocalIterator():
        part = unpack(r["counts"]).reshape(2, -1)
        counts[:, r["at"]:r["at"] + part.shape[1]] = part
    held = shared_tables(spark, code, counts)

    def mixing(batches):
        model, squares, mass = Model(*tables_of(held)), np.zeros((MIX_SETS, ORDERS)), 0.0
        begin = model.cells.copy()
        for part, kind, n in trained_words(batches):
            mass += model.learn(coded(part, kind, code), n, squares)
        if mass:
            yield pa.RecordBatch.from_pydict({"mass": [mass], "weights": pa.array([model.weights.tobytes()], pa.binary()), "cells": pa.array([(model.cells - begin).tobytes()], pa.binary())})
    learned = words.mapInArrow(mixing, "mass double, weights binary, cells binary").collect()
    model = Model(code, counts)
    total = sum(r["mass"] for r in learned)
    if total:
        model.weights = sum(r["mass"] / total * np.frombuffer(r["weights"]).reshape(MIX_SETS, ORDERS) for r in learned)
        model.cells = model.cells + sum(np.frombuffer(r["cells"]).reshape(2, CELLS) for r in learned)
    return model, held


# ---- pairs and triples of tokens ----------------------------------------------------------

def token_keys(hashes: np.ndarray, starts: np.ndarray):
    """Slices of a sequence of tokens, in order: (where it begins, sorted keys of KEY_BITS, their places).

    Keys are hashes of each token with the one before it (places from 0), then with the two before it (places from
    the slice's length). Texts begin at `starts`, after two tokens of their own.
    """
    begin, one_back, two_back = np.uint64(0x6A09E667F3BCC909), np.uint64(0), np.uint64(0)
    a, b, low = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95), np.uint64((1 << 64 - KEY_BITS) - 1)
    for at in range(0, len(hashes), SLICE):
        w = hashes[at:at + SLICE]
        first = starts[np.searchsorted(starts, at):np.searchsorted(starts, at + len(w))] - at
        p1 = np.concatenate(([one_back], w[:-1]))
        p1[first] = begin
        p2 = np.concatenate(([two_back], p1[:-1]))
        p2[first] = begin
        one_back, two_back = w[-1], p1[-1]
        pairs = scattered(p1 * a + w)
        keys = np.concatenate((pairs, scattered((pairs + p2 * b) ^ a)))
        keys = (keys & ~low) | np.arange(len(keys), dtype=np.uint64)
        keys.sort()
        yield at, keys >> np.uint64(64 - KEY_BITS), (keys & low).astype(np.int64)


def runs(keys: np.ndarray) -> np.ndarray:
    """Where equal sorted keys begin."""
    return np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, np.int64)


def order_of(keys: np.ndarray) -> np.ndarray:
    """What sorts keys of KEY_BITS; few enough are sorted with their places in one number."""
    low = (1 << 64 - KEY_BITS) - 1
    if len(keys) > low:
        return np.argsort(keys, kind="stable")
    packed = keys.astype(np.uint64) << np.uint64(64 - KEY_BITS) | np.arange(len(keys), dtype=np.uint64)
    packed.sort()
    return (packed & np.uint64(low)).astype(np.int64)


def number_hashes(row: dict) -> np.ndarray:
    """The hash of the word that each number of a group stands for."""
    hashes = word_hashes(unpack_words([row["raw"]], [row["sizes"]]))
    return hashes[np.cumsum(unpack(row["numbers"])) % len(hashes)]


def tokens_of(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of each token's word by kind, hash of each token, where each text begins) of a group."""
    sequence, lengths = unpack(row["sequence"]), unpack(row["lengths"])
    return sequence, number_hashes(row)[sequence], np.cumsum(lengths) - lengths


ANSWERS = "of long, sort int, part int, counts binary, scores binary"


def pair_counts(numbered: DataFrame, parts: int) -> DataFrame:
    """Training occurrences of all pairs and triples of tokens, as answers to each slice of a group (sort: 1 + its number).

    Keys meet in parts by their leading bits; a slice sends each key once, so that no frequent key makes a part large.
    `parts` is a power of two.
    """
    shift = KEY_BITS - parts.bit_length() + 1
    sent = pa.schema([("part", pa.int32()), ("of", pa.int64()), ("sort", pa.int32()), ("keys", pa.binary()), ("times", pa.binary())])

    def dealt(batches):
        for row in each_row(batches):
            _, hashes, starts = tokens_of(row)
            learned = np.repeat(1 - np.frombuffer(row["held"], np.uint8).astype(np.int64), unpack(row["lengths"]))
            for number, (at, keys, places) in enumerate(token_keys(hashes, starts)):
                first, m = runs(keys), len(keys) // 2
                times = np.add.reduceat(learned[at + np.where(places < m, places, places - m)], first)
                keys = keys[first]
                cuts = np.searchsorted(keys, np.arange(parts + 1, dtype=np.uint64) << np.uint64(shift))
                for p in np.flatnonzero(np.diff(cuts)):
                    mine = slice(cuts[p], cuts[p + 1])
                    steps = np.diff(keys[mine].astype(np.int64), prepend=int(p) << shift)
                    yield pa.RecordBatch.from_pylist([{"part": int(p), "of": row["g"], "sort": 1 + number, "keys": pack(steps), "times": pack(times[mine])}], schema=sent)

    def added(rows: pa.Table) -> pa.Table:
        keys = [np.cumsum(unpack(x.as_py())) for x in rows.column("keys")]
        ends, keys = np.cumsum([len(k) for k in keys]), np.concatenate(keys)
        times = np.concatenate([unpack(x.as_py()) for x in rows.column("times")])
        order = order_of(keys)
        first = runs(keys[order])
        total = np.empty(len(keys), dtype=np.int64)
        total[order] = np.repeat(np.add.reduceat(times[order], first), np.diff(np.append(first, len(keys))))
        return pa.table({"of": rows.column("of"), "sort": rows.column("sort"), "part": rows.column("part"),
                         "counts": pa.array([pack(x) for x in np.split(total, ends[:-1])], pa.binary()), "scores": pa.nulls(rows.num_rows, pa.binary())})
    columns = ["g", "held", "lengths", "sequence", "raw", "sizes", "numbers"]
    return numbered.select(*columns).mapInArrow(dealt, "part int, of long, sort int, keys binary, times binary").groupBy("part").applyInArrow(added, ANSWERS)


def situations(one: np.ndarray, two: np.ndarray, pair: np.ndarray, triple: np.ndarray, starts: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(situation, way) of each token. Ways: 2 and 1 for its share after two tokens and after one, 0 for its letters.

    one, two: how often the token before it, and the two before it, occur; pair, triple: the same with the token itself.
    """
    way = np.where(triple > 0, 2, (pair > 0).astype(np.int64))
    before = np.concatenate(([0], way[:-1]))
    before[starts] = 0
    further = np.concatenate(([0], before[:-1]))
    further[starts] = 0
    often_two = np.minimum(np.frexp(two.astype(float))[1], CLASSES - 1)
    often_one = np.minimum((np.frexp(one.astype(float))[1] + 1) // 2, CLASSES - 1)
    return ((kind * PAST + before * 3 + further) * CLASSES + often_two) * CLASSES + often_one, way


def way_scores(seen: np.ndarray) -> np.ndarray:
    """log10 of the probability of each way in each situation, from training tokens by (situation, way)."""
    s = np.arange(SITUATIONS)
    one, two, past, kind = s % CLASSES, s // CLASSES % CLASSES, s // CLASSES**2 % PAST, s // CLASSES**2 // PAST
    contexts = [two * CLASSES + one, past * CLASSES + two, past * CLASSES + one, kind * CLASSES + two, kind * CLASSES + one, s]
    out = np.zeros((SITUATIONS, 3))
    for bit, zeros, ones, often in ((2, seen[:, 0] + seen[:, 1], seen[:, 2], two), (1, seen[:, 0], seen[:, 1], one)):
        p = _mixed(zeros * (often > 0), ones * (often > 0), contexts, often)
        out[:, bit] += np.where(often > 0, np.log10(p), 0)
        out[:, :bit] += np.where(often > 0, np.log10(1 - p), 0)[:, None]
    return out


def _mixed(zeros: np.ndarray, ones: np.ndarray, contexts: list[np.ndarray], gate: np.ndarray, steps: int = 100) -> np.ndarray:
    """Mixed and refined probability of a one in each situation; what is learned from is guessed by counts without itself."""
    totals = [(np.bincount(c, zeros)[c], np.bincount(c, ones)[c]) for c in contexts]

    def logits(less_zero, less_one):
        return np.stack([np.log((np.maximum(o - less_one, 0) + PRIOR) / (np.maximum(z - less_zero, 0) + PRIOR)) for z, o in totals])

    def mixed(x, g):
        return np.clip((weights.T[:, g] * x).sum(axis=0), -12, 12)
    live = np.flatnonzero(zeros + ones)
    x = np.concatenate((logits(1, 0)[:, live], logits(0, 1)[:, live]), axis=1)
    w, value, g = np.concatenate((zeros[live], ones[live])), np.repeat([0.0, 1.0], len(live)), np.tile(gate[live], 2)
    weights, squares = np.full((CLASSES, len(contexts)), 1 / len(contexts)), np.zeros((CLASSES, len(contexts)))
    mass = np.maximum(np.bincount(g, w, minlength=CLASSES), 1e-9)
    for _ in range(steps):
        wrong = w * (value - 1 / (1 + np.exp(-mixed(x, g))))
        step = np.stack([np.bincount(g, wrong * row, minlength=CLASSES) for row in x], axis=1) / mass[:, None]
        squares = 0.9 * squares + 0.1 * step * step
        weights += 0.02 * step / (np.sqrt(squares) + 1e-4)
    cell = np.round((mixed(x, g) + 12) * ((CELLS - 1) / 24)).astype(np.int64)
    hits, tries = _cell_centres() * 50 + np.bincount(cell, w * value, minlength=CELLS), 50 + np.bincount(cell, w, minlength=CELLS)
    z = mixed(logits(0, 0), gate)
    refined = np.interp(z, np.linspace(-12, 12, CELLS), hits / tries)
    return np.clip((1 / (1 + np.exp(-z)) + refined) / 2, 1e-6, 1 - 1e-6)


# ---- texts ------------------------------------------------------------------------------

NUMBERED = ("g long, ids array<long>, held binary, lengths binary, kinds binary, sequence binary, raw binary, sizes binary, "
            "numbers binary, n binary, tokens long, entries long, learned array<long>")


def numbered_words(texts: DataFrame) -> DataFrame:
    """(id, text, held) rows to groups g of texts of about GROUP_BYTES: their tokens in order, as numbers of words by kind.

    raw, sizes: the group's words, the last one the end. numbers: what each number stands for, as steps of the kind times the
    number of words, plus the word. n: its training occurrences. learned: training texts by kind.
    """
    def run(batches):
        waiting, size = [], 0
        for batch in batches:
            rows, at = batch.num_rows, 0
            ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 8)
            while at < rows:
                before = ends[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(ends, before + GROUP_BYTES - size, side="right")))
                waiting.append(batch.slice(at, to - at))
                size += int(ends[to - 1] - before)
                at = to
                if size >= GROUP_BYTES:
                    yield group(waiting)
                    waiting, size = [], 0
        if waiting:
            yield group(waiting)

    def group(batches):
        rows = pa.Table.from_batches(batches).combine_chunks()
        t = Tokens(lower_utf8(pa.concat_arrays(rows.column("text").chunks)))
        held = pc.fill_null(rows.column("held"), False).to_numpy().astype(bool)
        width = len(t.words) + 1  # the last word is the end
        kind = kinds_of(t)
        lengths = t.count + 1
        ends = np.cumsum(lengths) - 1
        codes = np.full(int(lengths.sum()), width - 1, dtype=np.int64)
        inside = np.ones(len(codes), dtype=bool)
        inside[ends] = False
        codes[inside] = t.codes
        codes += np.repeat(kind * width, lengths)
        if KINDS * width <= 1 << 26:
            used = np.zeros(KINDS * width, dtype=bool)
            used[codes] = True
            numbers, sequence = np.flatnonzero(used), (np.cumsum(used) - 1)[codes]
        else:
            numbers, sequence = np.unique(codes, return_inverse=True)
        n = np.bincount(sequence, np.repeat(~held, lengths), minlength=len(numbers)).astype(np.int64)
        words = pa.concat_arrays([t.words.cast(pa.large_string()), pa.array([""], pa.large_string())])
        row = {"g": uuid.uuid4().int >> 65, "ids": rows.column("id").to_pylist(), "held": held.astype(np.uint8).tobytes(), "lengths": pack(lengths), "kinds": pack(kind),
               "sequence": pack(sequence), "numbers": pack(np.diff(numbers, prepend=0)), "n": pack(n), "tokens": len(codes),
               "entries": len(numbers), "learned": np.bincount(kind, ~held, minlength=KINDS).astype(np.int64).tolist()} | pack_words(words)
        return pa.RecordBatch.from_pylist([row], schema=schema)
    binary = ("held", "lengths", "kinds", "sequence", "raw", "sizes", "numbers", "n")
    schema = pa.schema([("g", pa.int64()), ("ids", pa.list_(pa.int64())), *[(x, pa.binary()) for x in binary], ("tokens", pa.int64()), ("entries", pa.int64()), ("learned", pa.list_(pa.int64()))])

    def kinds_of(t):
        """Per text the hash of its most frequent word of at most SHORT bytes, of equal ones the least; 0 without one."""
        out = np.zeros(t.rows, dtype=np.int64)
        short = np.flatnonzero(pc.less_equal(pc.binary_length(t.words), SHORT).to_numpy(zero_copy_only=False))
        if not len(short):
            return out
        spelled = t.words.take(pa.array(short)).cast(pa.large_binary()).to_pylist()
        order = sorted(range(len(short)), key=spelled.__getitem__)
        rank = np.full(len(t.words), -1)
        rank[short[order]] = np.arange(len(short))
        hashed = np.array([zlib.crc32(spelled[i]) % KINDS for i in order], dtype=np.int64)
        mine = rank[t.codes]
        pairs, times = np.unique((t.doc * len(short) + mine)[mine >= 0], return_counts=True)
        doc, best = pairs // len(short), pairs % len(short)
        order = np.lexsort((best, -times, doc))
        first = order[runs(doc[order])]
        out[doc[first]] = hashed[best[first]]
        return out
    return texts.mapInArrow(run, NUMBERED)


RESULT = "id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _power(n: int) -> int:
    """The least power of two that is at least n."""
    return 1 << max(0, n - 1).bit_length()


def score(docs: DataFrame, held: Column, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score): one row per row of docs.

    The model learns from the rows where `held` is false; a null there counts as false. Null texts count as
    empty: they have one token, the end. Repeated rows count as often as they are there. Without training rows
    every guess is even. An empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    path = new_path(spark, "words")
    numbered_words(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"), held.alias("held"))).write.parquet(f"{path}/numbered")
    rows = spark.read.parquet(f"{path}/numbered")
    size = rows.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tokens", "entries")], *[F.coalesce(F.sum(F.col("learned")[k]), F.lit(0)).alias(f"k{k}") for k in range(KINDS)]).first()
    learned = np.array([size[f"k{k}"] for k in range(KINDS)])
    texts = int(learned.sum())
    kind_score = np.log10((learned + 1) / (texts + KINDS))
    in_words = _power(-(-size["entries"] // PART_WORDS))
    word_parts(rows, in_words).write.parquet(f"{path}/words")
    words = spark.read.parquet(f"{path}/words")
    sums = words.agg(F.coalesce(F.sum("occurrences"), F.lit(0)).alias("n"), F.coalesce(F.sum("distinct"), F.lit(0)).alias("v")).first()
    tokens, floor = sums["n"], np.log10(sums["n"] + sums["v"] + 1)
    model, held_tables = train(words)
    weights, cells = model.weights, model.cells
    answer = pa.schema([("of", pa.int64()), ("sort", pa.int32()), ("part", pa.int32()), ("counts", pa.binary()), ("scores", pa.binary())])

    def spelled(batches):
        own = Model(*tables_of(held_tables), weights, cells)
        for row in each_row(batches):
            found = own.log10(unpack_words([row["raw"]], [row["sizes"]]), unpack(row["kind"])).astype("<f4").view("<u4")
            c = unpack(row["c"])
            for g, at in zip(row["g"], map(unpack, row["at"])):
                yield pa.RecordBatch.from_pylist([{"of": g, "sort": 0, "part": row["part"], "counts": pack(c[at]), "scores": pack(found[at])}], schema=answer)

    def told(groups: pa.Table, answers: pa.Table) -> pa.Table:
        row = groups.to_pylist()[0]
        answers = answers.sort_by([("sort", "ascending"), ("part", "ascending")])
        sort, counts = answers.column("sort").to_numpy(), answers.column("counts")
        of_words = np.flatnonzero(sort == 0)
        sequence, hashes, starts = tokens_of(row)
        order, _ = parts_of_words(number_hashes(row), in_words)
        c, lp = np.empty(len(order), dtype=np.int64), np.empty(len(order))
        c[order] = np.concatenate([unpack(counts[i].as_py()) for i in of_words])
        lp[order] = np.concatenate([unpack(answers.column("scores")[i].as_py()).astype("<u4").view("<f4") for i in of_words])
        held_, lengths, kinds = np.frombuffer(row["held"], np.uint8).astype(bool), unpack(row["lengths"]), unpack(row["kinds"])
        own, kind = np.repeat(~held_, lengths).astype(np.int64), np.repeat(kinds, lengths)
        pair, triple = np.empty(len(sequence), dtype=np.int64), np.empty(len(sequence), dtype=np.int64)
        for number, (at, keys, places) in enumerate(token_keys(hashes, starts)):
            first, m = runs(keys), len(keys) // 2
            found = np.empty(2 * m, dtype=np.int64)
            found[places] = np.repeat(np.concatenate([unpack(counts[i].as_py()) for i in np.flatnonzero(sort == 1 + number)]), np.diff(np.append(first, 2 * m)))
            pair[at:at + m], triple[at:at + m] = found[:m], found[m:]
        one = np.concatenate(([0], c[sequence[:-1]]))
        one[starts] = texts
        pair = np.minimum(pair, one)
        two = np.concatenate(([0], pair[:-1]))
        two[starts] = texts
        triple = np.minimum(np.minimum(triple, two), pair)
        where, way = situations(one, two, pair, triple, starts, kind)
        share = np.log10(np.maximum(np.where(way == 2, triple, pair), 1) / np.maximum(np.where(way == 2, two, one), 1))
        fixed = np.where(way == 0, lp[sequence], share)
        others = situations(one - own, two - own, pair - own, triple - own, starts, kind)
        seen = np.bincount(others[0] * 3 + others[1], own, minlength=SITUATIONS * 3).astype(np.int64)
        base = np.log10(c + 1.0) - floor
        return pa.Table.from_pylist([{"ids": row["ids"], "held": row["held"], "lengths": row["lengths"], "known": pack(np.add.reduceat((c > 0)[sequence].astype(np.int64), starts)),
                                      "base": np.add.reduceat(base[sequence], starts).tobytes(), "fixed": (np.add.reduceat(fixed, starts) + kind_score[kinds]).tobytes(),
                                      "kinds": row["kinds"], "ways": pack(where * 3 + way - kind * OF_KIND), "seen": pack(seen)}], schema=TOLD)

    spelled_words = words.select("part", "raw", "sizes", "kind", "c", "g", "at").mapInArrow(spelled, ANSWERS)
    answers = spelled_words.unionByName(pair_counts(rows, _power(-(-size["tokens"] // PART_TOKENS))))
    groups = rows.select("g", "ids", "held", "lengths", "kinds", "sequence", "raw", "sizes", "numbers")
    groups.groupBy("g").cogroup(answers.groupBy("of")).applyInArrow(told, "ids array<long>, " + ", ".join(f"{c} binary" for c in TOLD.names[1:])).write.parquet(f"{path}/told")
    by_group = spark.read.parquet(f"{path}/told")
    for done in ("numbered", "words"):
        delete(spark, f"{path}/{done}")

    def added(batches):
        total = np.zeros(SITUATIONS * 3, dtype=np.int64)
        for batch in batches:
            for x in batch.column("seen"):
                total += unpack(x.as_py())
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"at": pa.array(at, pa.int64()), "n": pa.array(total[at], pa.int64())})
    seen = np.zeros(SITUATIONS * 3)
    for r in by_group.select("seen").mapInArrow(added, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        seen[r["at"]] = r["n"]
    ways = way_scores(seen.reshape(-1, 3)).ravel()

    def scored(batches):
        for row in each_row(batches):
            lengths = unpack(row["lengths"])
            found = ways[unpack(row["ways"]) + np.repeat(unpack(row["kinds"]) * OF_KIND, lengths)]
            yield pa.RecordBatch.from_arrays([
                pa.array(row["ids"], pa.int64()), pa.array(np.frombuffer(row["held"], np.uint8).astype(bool)), pa.array(lengths), pa.array(unpack(row["known"])),
                pa.array(np.frombuffer(row["base"])), pa.array(np.frombuffer(row["fixed"]) + np.add.reduceat(found, np.cumsum(lengths) - lengths))],
                names=["id", "held_out", "n_tokens", "n_known", "base_score", "score"])
    return by_group.select(*[c for c in TOLD.names if c != "seen"]).mapInArrow(scored, RESULT).withColumn("train_tokens", F.lit(tokens).cast("long"))


TOLD = pa.schema([("ids", pa.list_(pa.int64())), *[(c, pa.binary()) for c in ("held", "lengths", "kinds", "known", "base", "fixed", "ways", "seen")]])
