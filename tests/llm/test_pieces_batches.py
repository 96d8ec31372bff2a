"""Encoding and decoding of batches against text by text, and the library."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from corpus_rows import messy_rows, prose, rows_of

from sparkstats.llm import pieces


@pytest.fixture(scope="module")
def model():
    return pieces.compiled()


def odd_texts():
    r = random.Random(3)
    marks = [" ", "  ", "\n", "▁", "▁▁", "\t", "é", "日本", "\U0001f600", "a", "the", "zq", "\r\n", "0"]
    made = ["".join(r.choice(marks) for _ in range(r.randrange(12))) for _ in range(300)]
    return ["", " ", None, "\n", "x" * 3000, *made, *[t[1] for t in messy_rows()], *[prose(60, s) for s in range(20)]]


def test_batches_are_as_texts_alone(model):
    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    texts = odd_texts()
    flat, at = model.encode_batch(pa.array(texts, pa.string()))
    alone = [model.encode(t or "").tolist() for t in texts]
    assert [flat[a:b].tolist() for a, b in zip(at, at[1:])] == alone == [library.encode(t or "") for t in texts]
    back = model.decode_batch(flat, at).to_pylist()
    assert back == [model.decode(i) for i in alone] == [(t or "").replace("▁", " ") for t in texts]


def test_broken_bytes_in_a_batch(model):
    lists = [model.encode("ok").tolist(), [model.bytes_[0xC3]], [model.bytes_[0xA9], *model.encode("b").tolist()], []]
    ends = np.concatenate(([0], np.cumsum([len(x) for x in lists])))
    assert model.decode_batch(np.array(sum(lists, [])), ends).to_pylist() == [model.decode(x) for x in lists]


def test_unigram_batches():
    ids = {"a": 1, "b": 2, "ab": 3, "▁": 4, "▁a": 5}
    t = pieces.Transducer(pieces.UNIGRAM, ids, [-1.0, -2.0, -2.0, -2.5, -3.0, -4.0], [], 0, [b"?", b"a", b"b", b"ab", b" ", b" a"], True, True, True)
    texts = [" ab  a ", "ab", "", "b a b", "xa"]
    flat, at = t.encode_batch(pa.array(texts))
    assert [flat[a:b].tolist() for a, b in zip(at, at[1:])] == [t.encode(x).tolist() for x in texts]


def test_memory_is_bounded_by_bytes(model, monkeypatch):
    monkeypatch.setattr(pieces, "MEMORY", 5000)
    memory = pieces.Memory(lambda key: key[::-1], lambda key, value: len(key) + len(value))
    for i in range(1000):
        assert memory[f"key {i}"] == f"key {i}"[::-1] and memory["k" * 2000] == "k" * 2000
        assert memory.held <= 5000 and len(memory) <= 40 and "k" * 2000 not in memory


def test_query(spark, tmp_path):
    import sentencepiece

    from sparkstats.llm.queries import QUERIES
    texts = [(r[0], r[1]) for r in messy_rows()]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    got = rows_of(QUERIES["op8_sentencepiece"](spark, str(tmp_path)))
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    want = [(i, len(library.encode(t or "")), library.encode(t or ""), hashlib.sha256((t or "").replace("▁", " ").encode()).hexdigest()) for i, t in texts]
    assert sorted([(r["doc_id"], r["n_pieces"], r["ids"], r["decoded_sha256"]) for r in got], key=key) == sorted(want, key=key)
