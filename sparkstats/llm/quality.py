"""Quality rules: text statistics with fixed limits, and a calibrated logistic regression on hashed n-grams.

The regression sees the shares of hashed words, word pairs and character n-grams of a text. It is fitted on
a bounded sample of labelled rows, calibrated on rows that the fit did not see, and scored in Arrow batches.
"""

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from . import linear
from .common import Tokens, packed, unpacked, utf8

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
IS_SPACE = np.isin(np.arange(256), list(SPACES))
#: Hash buckets of words, of word pairs and of character n-grams.
WORD_BITS, PAIR_BITS, CHAR_BITS = 15, 15, 15
WIDTH = (1 << WORD_BITS) + (1 << PAIR_BITS) + (1 << CHAR_BITS)
CHAR_N = 4
#: Labelled rows of each class that the regression is fitted on, at most.
SAMPLE = 2000
#: Kept at this calibrated probability of good quality.
THRESHOLD = 0.5
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    a: float
    b: float


class Batch:
    """The texts of a batch as bytes, words and n-gram features."""

    def __init__(self, texts: pa.Array):
        self.texts, self.rows = pc.fill_null(texts.cast(pa.large_string()), ""), len(texts)
        self.raw, self.at = utf8(texts)
        self.tokens = Tokens(texts)

    def per_row(self, of_bytes: np.ndarray) -> np.ndarray:
        """Sums of a value per byte over each text."""
        total = np.concatenate(([0], np.cumsum(of_bytes, dtype=np.int64)))
        return total[self.at[1:]] - total[self.at[:-1]]

    def statistics(self) -> dict[str, np.ndarray]:
        t = self.tokens
        first = (self.raw & 0xC0) != 0x80  # the first byte of a code point
        return {"n_words": t.count, "word_chars": self.per_row(first & ~IS_SPACE[self.raw]),
                "n_symbols": self.per_row(IS_SYMBOL[self.raw]),
                "n_dup_lines": np.array([repeated_lines(x.as_py()) for x in self.texts], dtype=np.int64),
                "n_repeat_words": repeated_words(t)}

    def features(self):
        """(row of, feature) arrays with one entry per word, word pair and character n-gram, and their numbers per row."""
        t = self.tokens
        hashed = np.array([zlib.crc32(w) for w in t.words.cast(pa.large_binary()).to_pylist()], dtype=np.uint64) if len(t.words) else np.empty(0, np.uint64)
        word = hashed[t.codes]
        yield t.doc, (word & np.uint64((1 << WORD_BITS) - 1)).astype(np.int64), t.count
        inside = np.flatnonzero(t.doc[1:] == t.doc[:-1])
        pair = (word[inside] * np.uint64(0x9E3779B97F4A7C15) + word[inside + 1]) * np.uint64(0xD6E8FEB86659FD93)
        yield t.doc[inside], ((pair >> np.uint64(64 - PAIR_BITS)) + np.uint64(1 << WORD_BITS)).astype(np.int64), np.maximum(t.count - 1, 0)
        if len(self.raw) >= CHAR_N:
            mixed = np.zeros(len(self.raw) - CHAR_N + 1, dtype=np.uint32)
            for i in range(CHAR_N):
                mixed = (mixed << np.uint32(8)) | self.raw[i:len(self.raw) - CHAR_N + 1 + i]
            mixed = (mixed * np.uint32(0x9E3779B1)) >> np.uint32(32 - CHAR_BITS)
            doc = np.repeat(np.arange(self.rows), np.diff(self.at))[:len(mixed)]
            inside = doc == np.repeat(np.arange(self.rows), np.diff(self.at))[CHAR_N - 1:]
            feature = mixed[inside].astype(np.int64) + (1 << WORD_BITS) + (1 << PAIR_BITS)
            yield doc[inside], feature, np.maximum(np.diff(self.at) - CHAR_N + 1, 0)

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """For each row the sum of its features' shares times their weights."""
        out = np.zeros(self.rows)
        for doc, feature, count in self.features():
            out += np.bincount(doc, weights[feature], minlength=self.rows) / np.maximum(count, 1)
        return out

    def sparse(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each row its features and their shares."""
        parts: list[list] = [[] for _ in range(self.rows)]
        for doc, feature, count in self.features():
            pairs, n = np.unique(doc.astype(np.int64) * WIDTH + feature, return_counts=True)
            rows = pairs // WIDTH
            share = n / np.maximum(count[rows], 1)
            cuts = np.searchsorted(rows, np.arange(self.rows + 1))
            for i in range(self.rows):
                parts[i].append((pairs[cuts[i]:cuts[i + 1]] % WIDTH, share[cuts[i]:cuts[i + 1]]))
        return [(np.concatenate([f for f, _ in p] or [np.empty(0, np.int64)]), np.concatenate([v for _, v in p] or [np.empty(0)])) for p in parts]


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    full = [line for line in text.split("\n") if line.strip(SPACES.decode())]
    return len(full) - len(set(full))


def repeated_words(t: Tokens, n: int = 3) -> np.ndarray:
    """Per row: the words that lie in a window of n words found twice or more in the row."""
    out = np.zeros(t.rows, dtype=np.int64)
    width = max(1, len(t.words))
    for row in np.flatnonzero(t.count > n):
        codes = t.codes[t.start[row]:t.start[row + 1]].astype(np.int64)
        key = codes[:len(codes) - n + 1]
        for i in range(1, n):  # numbers of the prefixes so far stay below the row's length
            key = np.unique(key, return_inverse=True)[1] * width + codes[i:len(codes) - n + 1 + i]
        _, of, times = np.unique(key, return_inverse=True, return_counts=True)
        again = times[of] > 1
        if again.any():
            covered = np.zeros(len(codes), dtype=bool)
            for i in range(n):
                covered[i:len(codes) - n + 1 + i] |= again
            out[row] = covered.sum()
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text: str, sample: int) -> DataFrame:
    """(id, y, t): the texts of the `sample` labelled ids of each class with the lowest hashes.

    Only ids are compared and sorted; 2 * sample of them at most then pick their texts out of the scan. Of rows
    with one id, and of an id with both labels, all are taken.
    """
    known = labels.where(F.col("y").isin(0, 1)).distinct().join(docs.where(F.col(text).isNotNull()).select(F.col(id_col).alias("id")), "id", "left_semi")
    first, second = [known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(sample) for y in (0, 1)]
    chosen = first.union(second).select(F.col("id").alias("_id"), "y")
    return (docs.select(F.col(id_col).alias("id"), F.col(text).alias("t")).where(F.col("t").isNotNull())
            .join(F.broadcast(chosen), F.col("id") == F.col("_id")).select("id", "y", "t"))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> Model:
    """The model of the `sample` labelled rows of each class with the lowest hashes of their ids.

    Rows without a label or text are not used. A class without rows gives a model that keeps everything that
    the rules keep. Every fourth row of the sample is left to the calibration.
    """
    chosen = labelled_sample(docs, labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("y")), id_col, text, sample)

    def train(batches):
        rows, y, names = [], [], []
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows += Batch(part.column("t")).sparse()
                y += part.column("y").to_pylist()
                names += [(zlib.crc32(str(i).encode()), i, len(t)) for i, t in zip(part.column("id").to_pylist(), part.column("t").to_pylist())]
        order = sorted(range(len(rows)), key=lambda i: (names[i], y[i]))  # whatever the order of arrival
        rows, y = [rows[i] for i in order], np.array([y[i] for i in order], dtype=float)
        if y.min(initial=1) == y.max(initial=0):
            yield _packed(Model(np.zeros(WIDTH), 20.0, 1.0, 0.0))
            return
        check = np.arange(len(rows)) % 4 == 3
        x = linear.Sparse([r for r, c in zip(rows, check) if not c], WIDTH)
        fit_y = y[~check]
        weight = np.where(fit_y > 0.5, 1 / max(1, fit_y.sum()), 1 / max(1, (1 - fit_y).sum()))
        w, bias = linear.fit(x, fit_y, weight, l2=1e-6, steps=200, rate=2.0)
        seen = linear.Sparse([r for r, c in zip(rows, check) if c], WIDTH)
        a, b = linear.platt(seen.times(w) + bias, y[check])
        yield _packed(Model(w, bias, a, b))

    row = chosen.repartition(1).mapInArrow(train, "w binary, bias double, a double, b double").first()
    if row is None:
        return Model(np.zeros(WIDTH), 20.0, 1.0, 0.0)
    return Model(np.frombuffer(row["w"], np.float32).astype(float), row["bias"], row["a"], row["b"])


def _packed(m: Model) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"w": pa.array([m.weights.astype(np.float32).tobytes()], pa.binary()), "bias": [m.bias], "a": [m.a], "b": [m.b]})


RESULT = "struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint,base_failed:boolean,probability:double,kept:boolean>"


def judged(text: Column, model: Model) -> Column:
    """A struct of the statistics, base_failed, the calibrated probability and kept. Null counts as the empty text."""
    shared = Model(model.weights.astype(np.float32), model.bias, model.a, model.b)

    def run(texts: pa.Array) -> pa.Array:
        parts = []
        for at in range(0, len(texts), 512):
            batch = Batch(texts.slice(at, 512))
            s = batch.statistics()
            failed = (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > MAX_REPEAT_PERCENT * s["n_words"])
            p = linear.sigmoid(shared.a * (batch.scores(shared.weights) + shared.bias) + shared.b)
            s |= {"base_failed": failed, "probability": p, "kept": ~failed & (p >= THRESHOLD)}
            parts.append(pa.StructArray.from_arrays([pa.array(v) for v in s.values()], names=list(s)))
        return pa.concat_arrays(parts) if parts else pa.nulls(0)
    return F.arrow_udf(run, RESULT)(text)


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, quality_rules): the id and the struct of `judged` for every row of docs, fitted on `labels`."""
    model = fit(docs, labels, id_col, text)
    return docs.select(F.col(id_col).alias("id"), judged(F.col(text), model).alias("quality_rules"))


def kept(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that pass; their columns are unchanged."""
    model = fit(docs, labels, id_col, text)
    return unpacked(packed(docs).where(judged(F.col("row")[text], model)["kept"]))
