"""SentencePiece encoding and decoding by a weighted transducer.

A model compiles to three parts. The normaliser rewrites blanks to the blank mark and puts one in front. The
piece transducer reads characters and writes pieces; characters without a piece go through byte arcs. The
weights depend on the model: of a unigram model an arc weighs minus its score; of a BPE model an arc weighs
nothing where the merges leave the piece beside its neighbour and is infinite where they would not, so that
the one path of finite weight is the segmentation that the merges make. Composed with an input, the least
path in the tropical semiring (min, +) is its encoding.

Inputs are cut where no arc crosses: before a run of blank marks, and between characters that no piece joins.
The paths of the parts are kept in a bounded memory, as most parts come again.
"""

import math
import re
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from . import common, packing

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Bytes of parts, and of pairs, that a worker remembers until it lets go of those not asked for meanwhile; those of a part that it does not remember.
MEMORY, PAIRS, LONG = 112 << 20, 40 << 20, 1024
#: Ids that are spelled at a time, about.
SPELLED = 1 << 19
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


class Memory(dict):
    """Values by key, made when they are first asked for. When it is full, what was asked for since the last time stays."""

    def __init__(self, make, size=lambda key, value: 0, most: int | None = None):
        super().__init__()
        self.make, self.size, self.most, self.before, self.held = make, size, most or MEMORY, {}, 0

    def __missing__(self, key):
        value = self.before.get(key)
        if value is None:
            value = self.make(key)
        cost = 150 + self.size(key, value)
        if cost > LONG:
            return value
        if self.held + cost > self.most:
            self.before, self.held = dict(self), 0
            self.clear()
        self.held += cost
        self[key] = value
        return value


@dataclass
class Transducer:
    """A compiled model: `ids` of the pieces, their `scores`, the ids of bytes, and the spelling of every id.

    `root` is the piece transducer as a prefix tree: a node has nodes by character and, under the empty string, the
    (length, id) of all arcs up to the piece that ends there.
    """

    kind: int
    ids: dict[str, int]
    scores: list[float]
    bytes_: list[int]
    unknown: int
    spelled: list[bytes]
    dummy_prefix: bool
    escape: bool
    collapse: bool

    def __post_init__(self):
        if self.kind == BPE:  # pieces that the merges never make have no arc
            self.arcs = {p: i for p, i in self.ids.items() if len(p) == 1 or self.merged(p) == [p]}
        else:
            self.arcs = self.ids
        self.letters = {p for p in self.ids if len(p) == 1}
        self.text_of = {i: p for p, i in self.arcs.items()}
        self.root: dict = {}
        for piece in sorted(self.arcs, key=len):
            node, within = self.root, ()
            for c in piece:
                within = node.get("", within)
                node = node.setdefault(c, {})
            node[""] = (*within, (len(piece), self.arcs[piece]))
        #: Neighbours within pieces; no arc crosses between any two others.
        self.inside = {p[i:i + 2] for p in self.arcs for i in range(len(p) - 1)}
        crosses = any(MARK in p.lstrip(MARK) for p in self.arcs)
        feed = "" if any("\n" in x for x in self.inside) else "\n"
        self.cutter = re.compile("(?s).+") if crosses else re.compile(f"{MARK}*[^{MARK}{feed}]+|{MARK}+" + ("|\n" if feed else ""))
        self.beside = Memory(self._beside, most=PAIRS)
        self.paths = Memory(lambda part: array("i", self.least_path(part)).tobytes(), lambda part, ids: 2 * len(part) + len(ids))
        self.crosses, self.feed = crosses, feed
        self.letters_of = np.frombuffer(b"".join(self.spelled), np.uint8)
        self.spans = np.concatenate(([0], np.cumsum([len(x) for x in self.spelled], dtype=np.int64)))

    def tables(self) -> tuple:
        """What it is made from."""
        return (self.kind, self.ids, self.scores, self.bytes_, self.unknown, self.spelled, self.dummy_prefix, self.escape, self.collapse)

    # ---- normaliser ---------------------------------------------------------

    def normalised(self, text: str) -> str:
        """Blanks as blank marks, one in front; the empty text stays empty."""
        if self.collapse:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return ""
        text = (" " if self.dummy_prefix else "") + text
        return text.replace(" ", MARK) if self.escape else text

    # ---- piece transducer -----------------------------------------------------

    def merged(self, text: str) -> list[str]:
        """The pieces that the merges make of a text: the best-scored pair first, of equal ones the leftmost."""
        parts = list(text)
        while len(parts) > 1:
            best, at = -math.inf, -1
            for i in range(len(parts) - 1):
                id_ = self.ids.get(parts[i] + parts[i + 1])
                if id_ is not None and self.scores[id_] > best:
                    best, at = self.scores[id_], i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _beside(self, pair: tuple[int, int]) -> bool:
        """Whether the merges leave the two pieces side by side."""
        left, right = self.text_of[pair[0]], self.text_of[pair[1]]
        return self.merged(left + right) == [left, right]

    def from_place(self, text: str, at: int) -> tuple[tuple[int, int], ...]:
        """(length, id) of the arcs that leave a place of a text, the shortest first."""
        node, out = self.root, ()
        for c in text[at:]:
            node = node.get(c)
            if node is None:
                break
            out = node.get("", out)
        return out

    def least_path(self, text: str) -> list[int]:
        """The ids on the least path through the composition of the transducer with a text."""
        inside, start, out = self.inside, 0, b""
        for i in range(1, len(text)):
            if text[i - 1:i + 1] not in inside:
                out += self.paths[text[start:i]]
                start = i
        if start:
            return np.frombuffer(out + self.paths[text[start:]], np.int32).tolist()
        if text in self.letters or len(text) > 1:
            return self._known(text)
        return [self.bytes_[b] for b in text.encode()] if self.bytes_ else [self.unknown]

    def _known(self, text: str) -> list[int]:
        if not text:
            return []
        return self._least_by_pairs(text) if self.kind == BPE else self._least_by_scores(text)

    def _least_by_scores(self, text: str) -> list[int]:
        weight, via = [0.0] + [math.inf] * len(text), [(0, 0)] * (len(text) + 1)
        for at in range(len(text)):
            for length, id_ in self.from_place(text, at):
                w = weight[at] - self.scores[id_]
                if w < weight[at + length]:
                    weight[at + length], via[at + length] = w, (at, id_)
        out, at = [], len(text)
        while at:
            at, id_ = via[at]
            out.append(id_)
        return out[::-1]

    def _least_by_pairs(self, text: str) -> list[int]:
        """States are (place, last piece); every arc weighs 0 or infinity, so the first path that arrives is the least.

        The longest arcs are tried first; a state from which no path arrives is left for good.
        """
        beside, end, root = self.beside, len(text), self.root
        dead: set[tuple[int, int]] = set()
        path, places, open_ = [], [], []
        at, left, arcs = 0, -1, None
        while at < end:
            if arcs is None:  # a new state: its arcs, the shortest first
                node, arcs = root, ()
                for c in text[at:]:
                    node = node.get(c)
                    if node is None:
                        break
                    arcs = node.get("", arcs)
                n = len(arcs)
            while n:
                n -= 1
                length, id_ = arcs[n]
                if (left < 0 or beside[left, id_]) and (not dead or (at + length, id_) not in dead):
                    path.append(id_)
                    places.append(at)
                    open_.append((arcs, n))
                    at, left, arcs = at + length, id_, None
                    break
            else:
                if not path:
                    raise ValueError(f"no path for {text!r}: a letter of the model is no piece")
                dead.add((at, path.pop()))
                at = places.pop()
                arcs, n = open_.pop()
                left = path[-1] if path else -1
        return path

    # ---- whole texts -----------------------------------------------------------

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text."""
        return np.frombuffer(b"".join(map(self.paths.__getitem__, self.cutter.findall(self.normalised(text)))), np.int32)

    def decode(self, ids) -> str:
        """The text that is spelled by ids; bytes that are no UTF-8 become replacement characters."""
        text = b"".join([self.spelled[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text

    # ---- batches ---------------------------------------------------------------

    def normalised_batch(self, texts: pa.Array) -> pa.Array:
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if self.collapse:
            texts = pc.utf8_trim(pc.replace_substring_regex(texts, " +", " "), " ")
        if self.dummy_prefix:
            none = pa.scalar("", pa.large_string())
            texts = pc.if_else(pc.equal(texts, none), none, pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, none))
        return pc.replace_substring(texts, " ", MARK) if self.escape else texts

    def cuts(self, raw: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where parts begin in normalised texts laid end to end: with each text, run of marks and line feed, and after a line feed."""
        begin = np.zeros(len(raw) + 1, bool)
        begin[at] = True
        if not self.crosses and len(raw) > 2:
            a, b, c = MARK.encode()
            mark = np.zeros(len(raw), bool)
            mark[:-2] = (raw[:-2] == a) & (raw[1:-1] == b) & (raw[2:] == c)
            begin[:3] |= mark[:3]
            begin[3:-1] |= mark[3:] & ~mark[:-3]
        if not self.crosses and self.feed:
            feed = raw == 10
            begin[:-1] |= feed
            begin[1:] |= feed
        return np.flatnonzero(begin[:-1])

    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(the ids of all texts end to end, where each text's begin and the last one's end). The path of each distinct part is found once."""
        raw, at = common.utf8(self.normalised_batch(texts))
        start = self.cuts(raw, at)
        ends = np.append(start, len(raw)).astype(np.int64)
        coded = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(raw))).dictionary_encode()
        spelled, span = common.utf8(coded.dictionary)
        spelled, span, paths = spelled.tobytes(), span.tolist(), self.paths
        found = [paths[spelled[a:b].decode()] for a, b in zip(span, span[1:])]
        flat, size = np.frombuffer(b"".join(found), np.int32), np.array([len(f) // 4 for f in found], np.int64)
        begin, code = np.cumsum(size) - size, coded.indices.to_numpy()
        ids, before = gathered(flat, begin, size, code)
        return ids, before[np.searchsorted(start, at)]

    def decode_batch(self, flat: np.ndarray, ends: np.ndarray) -> pa.Array:
        """The texts that are spelled by runs of ids; `ends` has where the runs begin and the last one ends."""
        raw, before = gathered(self.letters_of, self.spans[:-1], np.diff(self.spans), flat)
        at = before[ends]
        if self.dummy_prefix and len(raw):
            first = at[:-1][at[:-1] < at[1:]]
            gone = np.zeros(len(raw) + 1, bool)
            gone[first[raw[first] == 32]] = True
            raw, at = raw[~gone[:-1]], at - np.concatenate(([0], np.cumsum(gone)))[at]
        data = raw.tobytes()
        try:
            data.decode()
            whole = not ((raw[at[:-1][at[:-1] < len(raw)]] & 0xC0) == 0x80).any()
        except UnicodeDecodeError:
            whole = False
        if not whole:
            return pa.array([self.decode(flat[a:b].tolist()) for a, b in zip(ends, ends[1:])], pa.large_string())
        return pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data))


def gathered(flat: np.ndarray, begin: np.ndarray, size: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the spans of `flat` that codes stand for, end to end; where each begins and the last one ends)."""
    length = size[code]
    before = np.concatenate(([0], np.cumsum(length)))
    return flat[np.repeat(begin[code] - before[:-1], length) + np.arange(before[-1])], before


def compiled(path: str = MODEL) -> Transducer:
    """Read and compile a model file of type unigram or BPE with the identity normaliser."""
    from sentencepiece import sentencepiece_model_pb2
    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    spec, kind = proto.normalizer_spec, proto.trainer_spec.model_type
    if spec.precompiled_charsmap or kind not in (UNIGRAM, BPE):
        raise ValueError("models with a character map, and word or character models, are not supported")
    pieces = list(proto.pieces)
    spelled = [bytes([int(p.piece[3:5], 16)]) if p.type == BYTE else b"" if p.type == CONTROL else " ⁇ ".encode() if p.type == UNKNOWN
               else p.piece.replace(MARK, " ").encode() for p in pieces]
    by_byte = [i for i, p in enumerate(pieces) if p.type == BYTE]
    return Transducer(kind, {p.piece: i for i, p in enumerate(pieces) if p.type in (NORMAL, USER)}, [p.score for p in pieces],
                      by_byte if proto.trainer_spec.byte_fallback else [], next((i for i, p in enumerate(pieces) if p.type == UNKNOWN), 0),
                      spelled, spec.add_dummy_prefix, spec.escape_whitespaces, spec.remove_extra_whitespaces)


# ---- columns -------------------------------------------------------------------

_HELD: dict = {}


def _shared(spark, model: str):
    """The model's tables as a broadcast variable (some MB), one for a model and application."""
    key = (spark.sparkContext.applicationId, model)
    if key not in _HELD:
        _HELD[key] = spark.sparkContext.broadcast({"tables": compiled(model).tables()})
    return _HELD[key]


def _transducer(held) -> Transducer:
    """The transducer, built once in each worker process: it stays beside the tables with the paths found so far."""
    own = held.value
    if "made" not in own:
        own["made"] = Transducer(*own["tables"])
    return own["made"]


def encoded(docs: DataFrame, model: str = MODEL, text: str = "text") -> DataFrame:
    """docs with `ids` (array of int) and `n_pieces`, which replace columns of those names.

    Null counts as the empty text, which has no ids. Repeated rows are encoded alike; an empty table stays empty.
    """
    held = _shared(docs.sparkSession, model)

    def run(texts: pa.Array) -> pa.Array:
        t = _transducer(held)
        flat, ends = [np.empty(0, np.int32)], [np.zeros(1, np.int64)]
        for a, b in packing.chunks(texts):
            ids, at = t.encode_batch(texts.slice(a, b - a))
            flat.append(ids)
            ends.append(at[1:] + ends[-1][-1])
        return pa.ListArray.from_arrays(pa.array(np.concatenate(ends).astype(np.int32)), pa.array(np.concatenate(flat)))
    out = docs.withColumn("ids", F.arrow_udf(run, "array<int>")(F.col(text)))
    return out.withColumn("n_pieces", F.size("ids"))


def decoded(ids: Column, model: str, spark) -> Column:
    """The text of an array of ids; null ids give null."""
    held = _shared(spark, model)

    def run(lists: pa.Array) -> pa.Array:
        t, out, a = _transducer(held), [], 0
        ends, flat = lists.offsets.to_numpy().astype(np.int64), lists.values.to_numpy()
        while a < len(lists):
            b = max(a + 1, int(np.searchsorted(ends, ends[a] + SPELLED, "right")) - 1)
            out.append(t.decode_batch(flat[ends[a]:ends[b]], ends[a:b + 1] - ends[a]))
            a = b
        texts = pa.chunked_array(out, pa.large_string()).cast(pa.string()).combine_chunks()
        return pc.if_else(lists.is_valid(), texts, None)
    return F.arrow_udf(run, "string")(ids)
