"""Toxicity by weak supervision: voters, a generative label model, and a linear classifier on its labels.

Lexicon voters hold words and word beginnings that toxic rows of a bounded labelled sample use far more often;
pattern voters look at the shape of a text. Every training document is voted on. A generative model of the
votes - what each voter says of toxic and of clean texts, and how much voters repeat each other - is fitted to
the counts of all vote patterns by expectation maximisation. Its posterior labels a bounded sample of texts
that a logistic regression on hashed words is trained on, and that scores every text in Arrow batches.
"""

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from . import linear
from .common import Tokens, cut, lower_utf8, utf8
from .quality import labelled_sample

#: Labelled rows of each class that lexicons are found in, and texts of each posterior label that are learned from, at most.
SAMPLE = 2000
#: Lexicon voters, words and beginnings in each at most, and how much more often toxic rows must use them.
LEXICONS, ENTRIES, LIFT = 10, 64, 8.0
#: Documents of the sample that a word must be in.
SEEN = 5
#: A text's words count by this power of their number; strength of the penalty on the weights, as so many rows.
POWER = 0.25
L2 = 0.4
BEGINNINGS = (4, 5, 6)
#: Punctuation that is taken off words.
EDGES = ".,;:!?\"'()[]{}<>*_-#$%&|"
#: Texts that are read at once.
AT_ONCE = 4096
PATTERNS = ["shouting", "exclaiming", "symbols", "address"]
SYMBOLS = np.isin(np.arange(256), list(b"#*$%&@"))
VOTERS = LEXICONS + len(PATTERNS)
ADDRESS = {b"you", b"your", b"du", b"dich", b"tu", b"te", b"toi", b"vous", b"usted"}


def distinct(numbers: np.ndarray) -> np.ndarray:
    """Sorted, without repeats."""
    numbers = np.sort(numbers)  # several times faster than np.unique, which hashes whole numbers first
    return numbers[np.flatnonzero(np.append(numbers[1:] != numbers[:-1], True)[:len(numbers)])]


class Batch:
    """The distinct words of each text of a batch."""

    def __init__(self, texts: pa.Array):
        self.raw, self.at = utf8(texts)
        t = Tokens(lower_utf8(texts))
        self.rows = t.rows
        self.words = pc.utf8_lower(pc.utf8_trim(t.words, EDGES))
        pairs = distinct(t.doc.astype(np.int64) * max(1, len(t.words)) + t.codes)
        self.doc, self.code = pairs // max(1, len(t.words)), pairs % max(1, len(t.words))
        self.count = np.bincount(self.doc, minlength=self.rows)

    def spellings(self):
        """(mark, which, forms, code) for what features are made of: words, and their beginnings of each length, those they are longer than.

        `code` numbers the spellings of the words `which` into `forms`. A word of edges only has none.
        """
        size = pc.utf8_length(self.words).to_numpy()
        for mark, n in (("=", 0), *(("^", n) for n in BEGINNINGS)):
            which = np.flatnonzero(size > n)
            some = self.words.take(pa.array(which))
            coded = (pc.utf8_slice_codeunits(some, 0, n) if n else some).dictionary_encode()
            yield mark.encode(), which, coded.dictionary.cast(pa.large_binary()), coded.indices.to_numpy()

    def hashes(self):
        """(which, hashes, code): spellings as their hashes."""
        for mark, which, forms, code in self.spellings():
            start = zlib.crc32(mark)
            yield which, [zlib.crc32(f, start) for f in forms.to_pylist()], code

    def patterns(self) -> np.ndarray:
        """(rows, patterns) votes on the shape of the texts."""
        size = np.maximum(np.diff(self.at), 1)

        def share(of: np.ndarray) -> np.ndarray:
            return np.diff(np.searchsorted(np.flatnonzero(of), self.at)) / size
        address = pc.is_in(self.words.cast(pa.large_binary()), pa.array(sorted(ADDRESS), pa.large_binary())).to_numpy(zero_copy_only=False)
        named = np.bincount(self.doc[address[self.code]], minlength=self.rows) > 0
        return np.stack([share((self.raw >= 65) & (self.raw <= 90)) > 0.3, share(self.raw == 33) > 0.01, share(SYMBOLS[self.raw]) > 0.02, named], axis=1)

    def votes(self, lexicon: dict[bytes, int]) -> np.ndarray:
        """The votes of each row as bits of a number: lexicons first, then patterns."""
        bits = np.zeros(len(self.words), dtype=np.int64)
        for mark, which, forms, code in self.spellings():
            known = {f[1:]: 1 << v for f, v in lexicon.items() if f[:1] == mark}
            at = pc.index_in(forms, pa.array(known, pa.large_binary())).fill_null(len(known)).to_numpy()
            bits[which] |= np.array([*known.values(), 0], dtype=np.int64)[at[code]]
        out = np.zeros(self.rows, dtype=np.int64)
        mine = np.flatnonzero(bits[self.code])
        np.bitwise_or.at(out, self.doc[mine], bits[self.code[mine]])
        return out | (self.patterns() << (LEXICONS + np.arange(len(PATTERNS)))).sum(axis=1)

    def scale(self) -> np.ndarray:
        return 1 / np.maximum(self.count, 1) ** POWER

    def scores(self, weights: dict[int, float]) -> np.ndarray:
        """The sum of the weights of a row's distinct words, by the root of their number. Weights go by hash."""
        kinds = []
        for which, hashes, code in self.hashes():
            kinds.append(np.zeros(len(self.words)))
            kinds[-1][which] = np.array([weights.get(h, 0.0) for h in hashes], dtype=float)[code]
        per_word = np.array([sum(w) for w in zip(*[k.tolist() for k in kinds])], dtype=float)
        return np.bincount(self.doc, per_word[self.code], minlength=self.rows) * self.scale()

    def sparse(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each row its hashes and their values."""
        found = [np.empty(0, np.int64)]
        for which, hashes, code in self.hashes():
            of_word = np.full(len(self.words), -1, dtype=np.int64)
            of_word[which] = np.array(hashes, dtype=np.int64)[code]
            has = of_word[self.code] >= 0
            found.append((self.doc[has] << 32) + of_word[self.code[has]])
        pairs, n = np.unique(np.concatenate(found), return_counts=True)
        cuts, scale = np.searchsorted(pairs, np.arange(self.rows + 1) << 32), self.scale()
        return [(pairs[a:z] & 0xFFFFFFFF, n[a:z] * scale[i]) for i, (a, z) in enumerate(zip(cuts, cuts[1:]))]


# ---- lexicons --------------------------------------------------------------------

def lexicons(texts: list[pa.Array], toxic: np.ndarray) -> dict[bytes, int]:
    """Words and beginnings that toxic texts use most over clean ones, dealt out to the voters in that order."""
    in_texts: tuple[dict, dict] = ({}, {})
    at = 0
    for part in texts:
        b = Batch(part)
        said = toxic[at + np.arange(b.rows)].astype(bool)
        for mark, which, forms, code in b.spellings():
            of_word = np.full(len(b.words), -1, dtype=np.int64)
            of_word[which] = code
            has = of_word[b.code] >= 0
            pairs = distinct(b.doc[has] * max(1, len(forms)) + of_word[b.code[has]])
            doc, form = pairs // max(1, len(forms)), pairs % max(1, len(forms))
            for counts, mine in zip(in_texts, (~said, said)):
                n = np.bincount(form[mine[doc]], minlength=len(forms))
                for f, k in zip(forms.filter(pa.array(n > 0)).to_pylist(), n[n > 0].tolist()):
                    counts[mark + f] = counts.get(mark + f, 0) + k
        at += b.rows
    n = [max(1, int((toxic == v).sum())) for v in (0, 1)]
    lift = {f: (k / n[1]) / ((in_texts[0].get(f, 0) + 0.5) / n[0]) for f, k in in_texts[1].items() if k >= SEEN}
    best = sorted((f for f in lift if lift[f] >= LIFT), key=lambda f: (-in_texts[1][f] * np.log(lift[f]), f))
    return {f: i % LEXICONS for i, f in enumerate(best[:LEXICONS * ENTRIES])}


# ---- label model -------------------------------------------------------------------

@dataclass
class LabelModel:
    """What voters say of clean (row 0) and toxic (row 1) texts, the share of toxic ones, and each voter's own share of what it says."""

    rates: np.ndarray
    prior: float
    own: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """The probability of toxic for rows of 0/1 votes."""
        said = votes @ (self.own * np.log(self.rates[1] / self.rates[0])) + (1 - votes) @ (self.own * np.log((1 - self.rates[1]) / (1 - self.rates[0])))
        return linear.sigmoid(said + np.log(self.prior / (1 - self.prior)))


def unpacked(patterns: np.ndarray) -> np.ndarray:
    return (patterns[:, None] >> np.arange(VOTERS) & 1).astype(float)


def fit_labels(patterns: np.ndarray, counts: np.ndarray, start: LabelModel, steps: int = 40) -> LabelModel:
    """Expectation maximisation over vote patterns and their counts.

    Correlations: within a class, voters that repeat each other share their say; a voter's own share is one over
    one plus the sum of its positive correlations.
    """
    model, votes = start, unpacked(patterns)
    for step in range(steps):
        p = model.posterior(votes)
        mass = np.stack([counts * (1 - p), counts * p])
        # The start counts as some texts, so that a voter that is never heard keeps its place.
        rates = (mass @ votes + 20 * start.rates) / (mass.sum(axis=1, keepdims=True) + 20)
        own = model.own
        if step % 10 == 9:
            shared = np.zeros((VOTERS, VOTERS))
            for y in (0, 1):
                apart = votes - rates[y]
                cov = (apart * mass[y][:, None]).T @ apart / max(mass[y].sum(), 1e-9)
                sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
                shared += np.clip(cov / sd[:, None] / sd, 0, 1) * (0.5 - np.eye(VOTERS) * 0.5)
            own = 1 / (1 + np.clip(shared - np.diag(np.diag(shared)), 0, 1).sum(axis=1))
        model = LabelModel(np.clip(rates, 1e-4, 1 - 1e-4), float(np.clip(mass[1].sum() / max(counts.sum(), 1e-9), 1e-4, 0.5)), own)
    return model


# ---- on Spark -----------------------------------------------------------------------

@dataclass
class Classifier:
    """Weights by hash of a word or beginning, and a bias."""

    weights: dict[int, float]
    bias: float


def _learned_lexicons(sample: DataFrame):
    def run(batches):
        parts, y = [], []
        for batch in batches:
            parts.append(batch.column("t"))
            y += batch.column("y").to_pylist()
        y = np.array(y, dtype=int)
        small = [p.slice(at, 256) for p in parts for at in range(0, len(p), 256)]
        found = lexicons(small, y)
        votes = unpacked(np.concatenate([Batch(p).votes(found) for p in small] or [np.empty(0, np.int64)]))
        rates = np.stack([(votes[y == v].sum(axis=0) + 0.5) / ((y == v).sum() + 1) for v in (0, 1)])
        yield pa.RecordBatch.from_pydict({"word": pa.array(list(found), pa.binary()), "voter": pa.array(list(found.values()), pa.int32())} | {"rates": pa.nulls(len(found), pa.binary())})
        yield pa.RecordBatch.from_pydict({"word": pa.nulls(1, pa.binary()), "voter": pa.nulls(1, pa.int32()), "rates": pa.array([rates.tobytes()], pa.binary())})
    rows = sample.repartition(1).mapInArrow(run, "word binary, voter int, rates binary").collect()
    rates = next((np.frombuffer(r["rates"]).reshape(2, VOTERS) for r in rows if r["rates"] is not None), np.full((2, VOTERS), 0.5))
    return {bytes(r["word"]): r["voter"] for r in rows if r["word"] is not None}, rates


def voted(text: Column, lexicon: dict[bytes, int]) -> Column:
    """The votes on a text as bits of a number; null counts as the empty text."""
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(np.concatenate([Batch(texts.slice(at, AT_ONCE)).votes(lexicon) for at in range(0, len(texts), AT_ONCE)] or [np.empty(0, np.int64)]))
    return F.arrow_udf(run, "long")(text)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE) -> Classifier:
    """The classifier of the training documents and their labels; both are to hold no row that is held out.

    Labels other than 0 and 1 and rows without a text are not used. Without toxic or without clean labelled rows
    every text is clean.
    """

    labelled = labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("y"))
    known = labelled.where(F.col("y").isin(0, 1)).agg(F.count("*").alias("n"), F.sum("y").alias("k")).first()
    if not known["k"] or known["k"] == known["n"]:
        return Classifier({}, -10.0)
    lexicon, rates = _learned_lexicons(labelled_sample(docs, labelled, id_col, text, sample))
    start = LabelModel(np.clip(rates, 1e-3, 1 - 1e-3), float(np.clip(known["k"] / known["n"], 1e-3, 0.5)), np.ones(VOTERS))
    seen = cut(docs.where(F.col(text).isNotNull()).select(F.col(id_col).alias("id"), voted(F.col(text), lexicon).alias("votes")))
    patterns = seen.groupBy("votes").agg(F.count("*").alias("n")).collect()  # 2 ** VOTERS at most
    if not patterns:
        return Classifier({}, -10.0)
    codes = np.array([r["votes"] for r in patterns], dtype=np.int64)
    model = fit_labels(codes, np.array([r["n"] for r in patterns], dtype=float), start)
    posterior = dict(zip(codes.tolist(), model.posterior(unpacked(codes)).tolist()))
    table = docs.sparkSession.createDataFrame(list(posterior.items()), "_votes long, p double")
    named = seen.join(F.broadcast(table), F.col("votes") == F.col("_votes"))
    high, low = [named.where((F.col("p") >= 0.5) == v).orderBy(F.xxhash64("id"), "id").limit(sample) for v in (True, False)]
    chosen = high.union(low).select(F.col("id").alias("_id"), "p")
    texts = (docs.select(F.col(id_col).alias("id"), F.col(text).alias("t")).where(F.col("t").isNotNull())
             .join(F.broadcast(chosen), F.col("id") == F.col("_id")).select("id", "t", "p"))

    def train(batches):
        rows, p, names = [], [], []
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows += Batch(part.column("t")).sparse()
                p += part.column("p").to_pylist()
                names += [(i, len(t)) for i, t in zip(part.column("id").to_pylist(), part.column("t").to_pylist())]
        order = sorted(range(len(rows)), key=lambda i: names[i])
        rows, y = [rows[i] for i in order], np.array([p[i] for i in order])
        # Hashes that few texts have say nothing of others.
        hashes, times = np.unique(np.concatenate([f for f, _ in rows]), return_counts=True)
        hashes = hashes[times >= SEEN]
        kept = []
        for f, v in rows:
            at = np.searchsorted(hashes, f)
            known = hashes[np.minimum(at, len(hashes) - 1)] == f if len(hashes) else np.zeros(len(f), dtype=bool)
            kept.append((at[known], v[known]))
        toxic, check = y >= 0.5, np.arange(len(y)) % 4 == 3
        weight = np.where(toxic, 1 / max(1, toxic[~check].sum()), 1 / max(1, (~toxic)[~check].sum()))[~check]
        w, bias = linear.fit(linear.Sparse([k for k, c in zip(kept, check) if not c], len(hashes)), y[~check], weight, l2=L2 / max(1, len(y)), steps=200, rate=0.3)
        # Calibrated on texts that the fit has not seen.
        seen = linear.Sparse([k for k, c in zip(kept, check) if c], len(hashes))
        a, b = linear.platt(seen.times(w) + bias, toxic[check].astype(float))
        w, bias = a * w, a * bias + b
        yield pa.RecordBatch.from_pydict({"f": pa.array([hashes.astype(np.int64).tobytes()], pa.binary()), "w": pa.array([w.tobytes()], pa.binary()), "bias": [bias]})
    row = texts.repartition(1).mapInArrow(train, "f binary, w binary, bias double").first()
    if row is None:
        return Classifier({}, -10.0)
    return Classifier(dict(zip(np.frombuffer(row["f"], np.int64).tolist(), np.frombuffer(row["w"]).tolist())), row["bias"])


def scored(text: Column, model: Classifier) -> Column:
    """The probability of toxic; null counts as the empty text, which has a score too."""
    weights, bias = model.weights, float(model.bias)

    def run(texts: pa.Array) -> pa.Array:
        parts = [linear.sigmoid(Batch(texts.slice(at, AT_ONCE)).scores(weights) + bias) for at in range(0, len(texts), AT_ONCE)]
        return pa.array(np.concatenate(parts or [np.empty(0)]))
    return F.arrow_udf(run, "double")(text)


def score(docs: DataFrame, labels: DataFrame, held: Column, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, held_out, score, predicted): one row per row of docs; predicted is 1 at a score of 0.5 and more.

    Neither labels nor votes of held-out ids are learned from. `held` is a condition on the id alone; a null
    counts as false. An empty table gives an empty result.
    """
    out = F.coalesce(held, F.lit(False))
    marked = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"), out.alias("held_out"))
    known = labels.where(~out).select(F.col(id_col).alias("id"), "toxic")
    model = fit(marked.where(~F.col("held_out")), known, "id", "text")
    return marked.select("id", "held_out", scored(F.col("text"), model).alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
