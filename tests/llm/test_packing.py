"""Packing: ids as the tokeniser gives them, every id in one piece, little padding."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from corpus_rows import messy_rows, prose, rows_of
from pyspark.sql import functions as F

from sparkstats.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(PATH)


def ids_of(whole, text):
    return whole.encode(text or "", add_special_tokens=False).ids


ODD = ["it's we'll they've I'm 'sam ''s '' 's x'S don't'd 'r 've", " a  b   c \n d\n\ne \t\n f ", "   ", "\n", " \n ", "x y   z  w", "12 3a4 ½ ² ٣٤ x²",
       "日本語 テキスト", "\U0001f600\U0001f600 !\U0001f600", "é ́", "", None, "'", " '", "a'", "'s", "a<|endoftext|>b", "§§ «»", "\x00\x01 \x7f", "z" * 5000, "\r\n\r\n x"]


def test_ids_are_the_tokenisers(whole):
    made = packing.Tokenizer(PATH)
    for texts in (ODD, [t for t in ODD if t and "<|" not in t], [r[1] for r in messy_rows()], [prose(200, s) for s in range(30)], [chr(c) * 2 + " " + chr(c) for c in range(32, 0x3400)]):
        flat, at = made.encode(pa.array(texts, pa.string()))
        assert [flat[a:b].tolist() for a, b in zip(at, at[1:])] == [ids_of(whole, t) for t in texts]
    assert made.encode(pa.array([], pa.string()))[1].tolist() == [0]


def check(rows, texts, whole, width, slack):
    want = sorted(((i is None, i or 0, ids_of(whole, t) + [0]) for i, t in texts))
    by_seq, by_doc = {}, {}
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] > 0
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault((r["doc"] is None, r["doc"] or 0), []).append((r["start"], ids, r["doc_tokens"]))
    padding = 0
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= width and (at >= width - slack or at & (at - 1) == 0)
        padding += 0 if at & (at - 1) == 0 else width - at
    singles = {k: v for k, v in by_doc.items() if sum(w[:2] == k for w in want) == 1}
    for missing, i, ids in want:
        if (missing, i) in singles:
            parts = sorted(singles[missing, i])
            assert sum((p[1] for p in parts), []) == ids and all(p[2] == len(ids) for p in parts)
            assert [p[0] for p in parts] == np.cumsum([0] + [len(p[1]) for p in parts])[:-1].tolist()
    assert sum(r["length"] for r in rows) == sum(len(w[2]) for w in want)
    return padding / sum(r["length"] for r in rows)


@pytest.mark.parametrize("parts", [1, 7])
def test_every_id_in_one_piece(messy, whole, parts):
    texts = [(r[0], r[1]) for r in messy_rows()]
    check(rows_of(packing.packed(messy.repartition(parts), PATH)), texts, whole, 1024, packing.SLACK)
    check(rows_of(packing.packed(messy.repartition(parts), PATH, width=64, windows=2, slack=0)), texts, whole, 64, 0)


def test_padding_is_little(spark, whole, monkeypatch):
    monkeypatch.setattr(packing, "MERGED", 2)
    texts = [(i, prose(1 + i * i % 700, i)) for i in range(600)]
    rows = rows_of(packing.packed(spark.createDataFrame(texts, "doc_id long, text string").repartition(5), PATH))
    assert check(rows, texts, whole, 1024, packing.SLACK) < 0.004
    groups = {r["sequence_id"] >> 32 for r in rows if r["sequence_id"] >> 62}
    assert groups == {1 << 30, (1 << 30) + 1, (1 << 30) + 2}


def test_windows_place_best_fit_and_emit_the_fullest():
    space = packing.Windows(16, 2, 1)
    put = lambda n: [[len(p.ids) for p in s] for s in space.put(packing.Piece(n, 0, np.zeros(n, np.uint32), n))]
    assert [put(n) for n in (10, 12, 4, 5, 1)] == [[], [], [[12, 4]], [], [[10, 5, 1]]]
    assert put(9) == [] and put(5) == [] and put(35) == [[16], [16]]
    # Rooms are 2 and 13. 14 fits neither: with one to spare the fullest would go as it is, with two it is topped up.
    assert put(14) == [[9, 5, 2]] and [[len(p.ids) for p in w] for w in space.rest()] == [[3, 12]]
    assert put(8) == [] and put(9) == [[3, 12]] and [[len(p.ids) for p in w] for w in space.rest()] == [[8], [9]][::-1]


def test_sequences(messy, whole):
    pieces = packing.packed(messy, PATH, width=64)
    rows = {r["sequence_id"]: r for r in rows_of(packing.sequences(pieces, 64, pad=7))}
    for s, parts in rows_by(pieces).items():
        ids = sum((np.frombuffer(p["ids"], "<u4").tolist() for p in sorted(parts, key=lambda p: p["offset"])), [])
        got = np.frombuffer(rows[s]["ids"], "<u4").tolist()
        assert rows[s]["length"] == len(ids) and got == (ids if len(ids) & (len(ids) - 1) == 0 else ids + [7] * (64 - len(ids)))


def rows_by(pieces):
    out = {}
    for r in rows_of(pieces):
        out.setdefault(r["sequence_id"], []).append(r)
    return out


def test_empty_and_bare(spark, empty, whole):
    assert packing.packed(empty, PATH).count() == 0
    none = spark.createDataFrame([(1, None), (2, ""), (2, "")], "doc_id long, text string")
    assert check(rows_of(packing.packed(none, PATH)), [(1, None), (2, ""), (2, "")], whole, 1024, 8) == 0
    with pytest.raises(ValueError):
        packing.packed(none, PATH, width=1000)


def test_query(spark, tmp_path, whole):
    from sparkstats.llm.queries import QUERIES
    texts = [(r[0], r[1]) for r in messy_rows()]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = rows_of(QUERIES["op13_packing"](spark, str(tmp_path)))
    assert set(got[0]) == {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}
    full = {i: ids_of(whole, t) + [0] for i, t in texts}
    for r in got:
        part = full[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert r["doc_tokens"] == len(full[r["doc_id"]]) and r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
