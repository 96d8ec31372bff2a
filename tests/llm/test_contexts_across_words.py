"""The language model's contexts across words: order, copies, and pairs and triples against brute force."""

from collections import Counter

import numpy as np
import pyarrow as pa
from corpus_rows import messy_rows, prose, rows_of
from pyspark.sql import functions as F

from sparkstats.llm import contextmix


def test_order_matters(spark):
    base = prose(200, 1).split()
    rows = [(n, prose(200, 1)) for n in range(2)] + [(n, prose(200, n)) for n in range(2, 30)]
    rows += [(100, " ".join(base)), (101, " ".join(reversed(base))), (102, " ".join(sorted(base)))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["id"]: r for r in rows_of(contextmix.score(df, F.col("doc_id") >= 100))}
    assert abs(got[100]["base_score"] - got[101]["base_score"]) < 1e-9
    assert got[100]["score"] > got[101]["score"] + 50 and got[100]["score"] > got[102]["score"] + 50


def test_pairs_and_triples_of_all_texts(spark, monkeypatch):
    """Several groups, slices and parts count what one pass over all texts counts."""
    monkeypatch.setattr(contextmix, "GROUP_BYTES", 3000)
    monkeypatch.setattr(contextmix, "SLICE", 500)
    texts = [(n, r[1], n % 3 == 0) for n, r in enumerate(messy_rows())]
    numbered = contextmix.numbered_words(spark.createDataFrame(texts, "id long, text string, held boolean").repartition(3)).cache()
    low = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    told = {i: [None, None, *(t or "").encode().translate(low).split(), b""] for i, t, _ in texts}
    want = Counter()
    for i, _, held in texts:
        for at in range(2, len(told[i])):
            want.update({tuple(told[i][at - 1:at + 1]): 1 - held, tuple(told[i][at - 2:at + 1]): 1 - held})
    answers = rows_of(contextmix.pair_counts(numbered, 8))
    assert len({a["part"] for a in answers}) == 8 and len({a["sort"] for a in answers}) > 3
    for row in rows_of(numbered):
        _, hashes, starts = contextmix.tokens_of(row)
        mine = [told[i] for i in row["ids"]]
        for number, (at, keys, places) in enumerate(contextmix.token_keys(hashes, starts)):
            first, m = contextmix.runs(keys), len(keys) // 2
            parts = sorted((a["part"], a["counts"]) for a in answers if a["of"] == row["g"] and a["sort"] == 1 + number)
            found = np.empty(2 * m, dtype=np.int64)
            found[places] = np.repeat(np.concatenate([contextmix.unpack(x) for _, x in parts]), np.diff(np.append(first, 2 * m)))
            pairs = [want[tuple(t[k - 1:k + 1])] for t in mine for k in range(2, len(t))]
            triples = [want[tuple(t[k - 2:k + 1])] for t in mine for k in range(2, len(t))]
            assert found.tolist() == pairs[at:at + m] + triples[at:at + m]


def test_ways_sum_to_one():
    seen = np.random.default_rng(1).integers(0, 50, (contextmix.SITUATIONS, 3)) * (np.arange(contextmix.SITUATIONS)[:, None] % 3)
    one, two = np.arange(contextmix.SITUATIONS) % contextmix.CLASSES, np.arange(contextmix.SITUATIONS) // contextmix.CLASSES % contextmix.CLASSES
    seen[two == 0, 2], seen[one == 0, 1] = 0, 0
    p = 10 ** contextmix.way_scores(seen)
    p[two == 0, 2], p[one == 0, 1] = 0, 0
    assert np.allclose(p.sum(axis=1), 1)


def test_packed_numbers_and_words():
    for x in ([], [0], [255, 256], [1 << 40, 3], list(range(70_000))):
        assert contextmix.unpack(contextmix.pack(np.array(x, dtype=np.int64))).tolist() == x
    words = pa.array(["", "a", "ab", "ba", "a" * 300, "é", "日本", ""], pa.large_string())
    hashes = contextmix.word_hashes(words)
    assert len(set(hashes.tolist())) == 7 and hashes[0] == hashes[7] and (contextmix.word_hashes(words.slice(2, 3)) == hashes[2:5]).all()
    packed = contextmix.pack_words(words)
    assert contextmix.unpack_words([packed["raw"]] * 2, [packed["sizes"]] * 2).to_pylist() == words.to_pylist() * 2
