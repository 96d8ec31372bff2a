"""Packing documents into token sequences: bounded-space best fit, partition by partition.

Each partition keeps a fixed number of open windows. A piece goes to the fullest window that it fits into; where
it fits into none, the fullest window is emitted. What the windows hold when a partition ends is merged: some
partitions' windows at a time are packed by the same rule, and the last windows of a merge are emptied into full
sequences and into ones whose lengths are powers of two, which need no padding.

Documents are tokenised in their scan. A batch is cut where the pre-tokeniser cuts, its distinct parts are encoded
by the tokeniser's model, and the ids are gathered.
"""

from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from . import common

WIDTH = 1024
#: Open windows of a partition; free tokens with which a window may be emitted; partitions whose last windows are merged at once.
WINDOWS, SLACK, MERGED = 32, 8, 64
#: Bytes of text that are tokenised at a time, at most (a longer text alone); bytes of parts and ids that a worker remembers.
CHUNK, MEMORY = 2 << 20, 96 << 20
#: Byte length from which a part is not remembered.
LONG = 256


# ---- tokens ----------------------------------------------------------------------

LETTER, NUMBER, OTHER, BLANK, UNSEEN = range(5)


class Tokenizer:
    """A byte-level BPE tokeniser file, applied to batches. Other kinds of tokeniser encode text by text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer as Loaded, pre_tokenizers
        self.whole = Loaded.from_file(path)
        cutter = self.whole.pre_tokenizer
        self.by_parts = (isinstance(cutter, pre_tokenizers.ByteLevel) and cutter.use_regex and not cutter.add_prefix_space
                         and self.whole.normalizer is None and self.whole.truncation is None and self.whole.padding is None)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.kinds = np.full(0x110000, UNSEEN, np.uint8)
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in visible]
        self.letters = {b: b for b in visible} | {b: 256 + n for n, b in enumerate(hidden)}
        self.known: dict[bytes, bytes] = {}
        self.held = 0

    def _kind(self, code: int) -> int:
        """How the pre-tokeniser takes a character: a letter, a number, and so on, by what it keeps it together with."""
        if 0xD800 <= code < 0xE000:
            return OTHER
        for kind, beside in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")):
            if len(self.whole.pre_tokenizer.pre_tokenize_str(beside + chr(code))) == 1:
                return kind
        return BLANK

    def starts(self, raw: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the parts begin in texts laid end to end; `at` has where the texts begin and the last one ends."""
        where = np.flatnonzero((raw & 0xC0) != 0x80)
        if not len(where):
            return where
        code = raw[where].astype(np.int32)
        long = np.flatnonzero(code >= 0x80)
        if len(long):
            b = np.append(raw, np.zeros(3, np.uint8))[where[long][:, None] + np.arange(4)].astype(np.int32)
            b0, b1, b2, b3 = b[:, 0], b[:, 1] & 63, b[:, 2] & 63, b[:, 3] & 63
            code[long] = np.where(b0 < 0xE0, (b0 & 31) << 6 | b1, np.where(b0 < 0xF0, (b0 & 15) << 12 | b1 << 6 | b2,
                                                                           (b0 & 7) << 18 | b1 << 12 | b2 << 6 | b3)) % 0x110000
        kind, n = self.kinds[code], len(code)
        new = kind == UNSEEN
        if new.any():
            for c in np.unique(code[new]):
                self.kinds[c] = self._kind(int(c))
            kind = self.kinds[code]
        first = np.zeros(n + 1, bool)
        first[np.searchsorted(where, at)] = True
        begins = np.ones(n + 1, bool)
        np.not_equal(kind[1:], kind[:-1], out=begins[1:n])
        begins[:n] |= first[:n]
        run = np.flatnonzero(begins)
        run, end, of = run[:-1], run[1:], kind[run[:-1]]
        # The last blank before a word is a part of its own, or the word's if it is a space.
        gap = (of == BLANK) & ~first[end]
        last, follows = end[gap] - 1, end[gap]
        begins[last] = True
        begins[follows[code[last] == 32]] = False
        # An apostrophe that begins a part takes s, t, m, d, re, ve and ll with it.
        mark = (of == OTHER) & (end - run == 1) & (code[run] == 39) & begins[run] & ~first[end]
        mark[:-1] &= of[1:] == LETTER
        mark = np.flatnonzero(mark)
        if len(mark):
            word, stop = end[mark], end[np.minimum(mark + 1, len(end) - 1)]
            c, then = code[word], code[np.minimum(word + 1, n - 1)]
            two = (stop - word >= 2) & ((c == 114) & (then == 101) | (c == 118) & (then == 101) | (c == 108) & (then == 108))
            size = np.where(np.isin(c, [115, 116, 109, 100]), 1, np.where(two, 2, 0))
            begins[word[size > 0]] = False
            begins[(word + size)[size > 0]] = True
        return where[np.flatnonzero(begins[:n])]

    def _ids(self, parts: list[bytes]) -> list[bytes]:
        """The ids of parts as little-endian 32-bit numbers."""
        known, model, letters, out = self.known, self.whole.model, self.letters, []
        for p in parts:
            ids = known.get(p)
            if ids is None:
                ids = array("I", [t.id for t in model.tokenize(p.decode("latin-1").translate(letters))]).tobytes()
                if len(p) < LONG:
                    self.held += len(p) + len(ids) + 150
                    if self.held > MEMORY:
                        known.clear()
                        self.held = 0
                    known[p] = ids
            out.append(ids)
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, where each text's begin and the last one's end). Null has none."""
        if not self.by_parts or any(pc.any(pc.match_substring(texts, s)).as_py() for s in self.special):
            rows = [np.array(e.ids, "<u4") for e in self.whole.encode_batch_fast([t or "" for t in texts.to_pylist()], add_special_tokens=False)]
            return np.concatenate([*rows, np.empty(0, "<u4")]), np.concatenate(([0], np.cumsum([len(r) for r in rows], dtype=np.int64)))
        raw, at = common.utf8(texts)
        start = self.starts(raw, at)
        ends = np.append(start, len(raw)).astype(np.int64)
        coded = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(raw))).dictionary_encode()
        spelled, at_part = common.utf8(coded.dictionary)
        spelled, at_part = spelled.tobytes(), at_part.tolist()
        ids = self._ids([spelled[a:b] for a, b in zip(at_part, at_part[1:])])
        code, flat = coded.indices.to_numpy(), np.frombuffer(b"".join(ids), "<u4")
        size = np.array([len(i) // 4 for i in ids], np.int64)
        begin = np.cumsum(size) - size
        length = size[code]
        before = np.concatenate(([0], np.cumsum(length)))
        taken = flat[np.repeat(begin[code] - before[:-1], length) + np.arange(before[-1])] if len(code) else flat
        return taken, before[np.searchsorted(start, at)]


def chunks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows with CHUNK bytes of text at most; a longer text is a range of its own."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    begin, total = 0, 0
    for i, n in enumerate(size):
        if total and total + n > CHUNK:
            yield begin, i
            begin, total = i, 0
        total += int(n)
    if begin < len(size):
        yield begin, len(size)


# ---- windows ---------------------------------------------------------------------

@dataclass
class Piece:
    """Ids of a document from its `start` on."""

    doc: int | None
    start: int
    ids: np.ndarray
    doc_tokens: int


class Windows:
    """A bounded number of open windows, in order of their free room."""

    def __init__(self, width: int, count: int, slack: int):
        self.width, self.count, self.slack, self.made = width, count, slack, 0
        self.open: list[tuple[int, int, list[Piece]]] = []  # (room, age, pieces)
        self.age = 0

    def put(self, piece: Piece) -> Iterator[list[Piece]]:
        """Place a piece; sequences that are emitted for it come back."""
        while len(piece.ids) >= self.width:
            head, piece = _cut(piece, self.width)
            yield [head]
        while len(piece.ids):
            n = len(piece.ids)
            fit = bisect_left(self.open, (n, -1))
            if fit < len(self.open):
                room, age, pieces = self.open.pop(fit)
                pieces.append(piece)
                if room > n:
                    insort(self.open, (room - n, age, pieces))
                else:
                    yield pieces
                return
            if len(self.open) < self.count:
                self.age += 1
                insort(self.open, (self.width - n, self.age, [piece]))
                return
            room, _, pieces = self.open.pop(0)
            if room > self.slack:
                head, piece = _cut(piece, room)
                pieces.append(head)
            yield pieces

    def rest(self) -> list[list[Piece]]:
        return [pieces for _, _, pieces in sorted(self.open, key=lambda w: (w[0], w[1]))]


def _cut(piece: Piece, at: int) -> tuple[Piece, Piece]:
    return (Piece(piece.doc, piece.start, piece.ids[:at], piece.doc_tokens),
            Piece(piece.doc, piece.start + at, piece.ids[at:], piece.doc_tokens))


def emptied(windows: list[list[Piece]], width: int) -> Iterator[list[Piece]]:
    """All pieces in full sequences, the last tokens in ones whose lengths are powers of two."""
    left = sum(len(p.ids) for w in windows for p in w)
    size = lambda: width if left >= width else 1 << (left.bit_length() - 1)
    made, room = [], size() if left else 0
    for piece in (p for w in windows for p in w):
        while len(piece.ids):
            head, piece = _cut(piece, room)
            made.append(head)
            room -= len(head.ids)
            left -= len(head.ids)
            if not room:
                yield made
                made, room = [], size() if left else 0


FIELDS = "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def _rows(sequences: list[list[Piece]], numbers: list[int], kind: pa.DataType, open_: list[bool]) -> pa.RecordBatch:
    flat = [(p, number, o, at) for s, number, o in zip(sequences, numbers, open_)
            for p, at in zip(s, np.cumsum([0] + [len(p.ids) for p in s]))]
    return pa.RecordBatch.from_arrays(
        [pa.array([x[0].doc for x in flat], kind), *[pa.array(v, pa.int64()) for v in ([x[0].start for x in flat], [len(x[0].ids) for x in flat])],
         pa.array([x[0].ids.astype("<u4").tobytes() for x in flat], pa.binary()),
         *[pa.array(v, pa.int64()) for v in ([x[0].doc_tokens for x in flat], [x[1] for x in flat], [int(x[3]) for x in flat])],
         pa.array([x[2] for x in flat], pa.bool_())], names=["doc", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "open"])


def packed(docs: DataFrame, tokenizer: str, end: int = 0, width: int = WIDTH, id_col: str = "doc_id", text: str = "text",
           windows: int = WINDOWS, slack: int = SLACK) -> DataFrame:
    """The pieces of all documents: (doc, start, length, ids, doc_tokens, sequence_id, offset).

    A document is the ids of its text, then `end`. ids are little-endian unsigned 32-bit numbers; start is what the
    document has before the piece, offset what the sequence has before it. Sequences have `width` ids at most. One
    has less only with at most `slack` missing, or with a power of two, so padding is at most slack / width. A null
    or empty text is `end` alone; repeated rows and null ids are documents of their own; an empty table has no
    pieces; other columns are not read. Pieces are written to the shared folder once, so what lost executors had is
    read there; the folder stays. Pieces depend on how the scan is cut, sequence ids too.
    """
    spark = docs.sparkSession
    if width < 1 or width & (width - 1):
        raise ValueError("the width must be a power of two")
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text).alias("text"))
    schema = f"doc {rows.schema['doc'].dataType.simpleString()}, {FIELDS}, open boolean"
    loaded = spark.sparkContext.broadcast({"path": tokenizer})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = loaded.value
        if "made" not in own:  # a worker process builds it once
            own["made"] = Tokenizer(own["path"])
        tokens, space, part, number, kind = own["made"], Windows(width, windows, slack), TaskContext.get().partitionId() << 32, 0, None
        for batch in batches:
            kind = batch.column(0).type
            for a, b in chunks(batch.column(1)):
                ids, at = tokens.encode(batch.column(1).slice(a, b - a))
                made = []
                for doc, i, j in zip(batch.column(0).slice(a, b - a).to_pylist(), at, at[1:]):
                    whole = np.append(ids[i:j], np.uint32(end))
                    made += space.put(Piece(doc, 0, whole, len(whole)))
                yield _rows(made, list(range(part + number, part + number + len(made))), kind, [False] * len(made))
                number += len(made)
        last = space.rest()
        if last:
            yield _rows(last, list(range(part + number, part + number + len(last))), kind, [True] * len(last))

    path = common.new_path(spark, "packed")
    rows.mapInArrow(run, schema).write.option("compression", "zstd").partitionBy("open").parquet(path)
    table = spark.read.schema(schema).parquet(path)

    def merge(key: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by([("sequence_id", "ascending"), ("offset", "ascending")]).combine_chunks()
        space, made, held = Windows(width, windows, slack), [], {}
        for r in group.select(["doc", "start", "ids", "doc_tokens", "sequence_id"]).to_pylist():
            held.setdefault(r["sequence_id"], []).append(Piece(r["doc"], r["start"], np.frombuffer(r["ids"], "<u4"), r["doc_tokens"]))
        for piece in sorted((p for w in held.values() for p in w), key=lambda p: -len(p.ids)):
            made += space.put(piece)
        made += emptied(space.rest(), width)
        first = (1 << 30) + key[0].as_py() << 32
        out = _rows(made, list(range(first, first + len(made))), group.schema.field("doc").type, [False] * len(made))
        return pa.Table.from_batches([out]).drop_columns(["open"])

    names = [c for c in table.columns if c != "open"]
    left = table.where("open").select(*names, F.floor(F.shiftright("sequence_id", 32) / MERGED).alias("group"))
    last = left.groupBy("group").applyInArrow(merge, schema.removesuffix(", open boolean"))
    return table.where("not open").select(names).unionByName(last)


def sequences(pieces: DataFrame, width: int = WIDTH, pad: int = 0) -> DataFrame:
    """(sequence_id, length, ids): the pieces of each sequence in order, filled up with `pad` to the width unless the length is a power of two."""
    listed = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    whole = F.aggregate(listed, F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    out = pieces.groupBy("sequence_id").agg(F.sum("length").alias("length"), whole.alias("ids"))
    short = F.col("length").bitwiseAND(F.col("length") - 1) != 0
    filled = F.expr(f"rpad(ids, {4 * width}, X'{int(pad).to_bytes(4, 'little').hex()}')")
    return out.withColumn("ids", F.when(short, filled).otherwise(F.col("ids")))
