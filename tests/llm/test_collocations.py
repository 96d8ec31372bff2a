"""Collocations against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from corpus_rows import messy_rows, prose, rows_of

from sparkstats.llm import collocations

FIELDS = "doc_id long, text string, lang string, size int, phrase string"


def low(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def brute(rows, least, first, most=5, inside=100):
    f, n = {}, Counter()
    for lang, t in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low(t)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for i in range(len(w)):
                for k in range(1, most + 1):
                    if i + k <= len(w):
                        f.setdefault(lang, Counter())[tuple(w[i:i + k])] += 1
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= inside * a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in cand.items()):
                continue
            score, _, l, r = min((1000 * a * n[lang] // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(found)[:first], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def mined(df, **args):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in rows_of(collocations.mine(df, **args)))


def corpus(seed, docs):
    r = random.Random(seed)
    vocabulary = ["w%d" % int(r.paretovariate(0.8)) for _ in range(400)] + ["É", "ß", "the", "The", "of", "\U0001f600", "a b", "en"]
    rows = []
    for i in range(docs):
        words = [r.choice(vocabulary[-120:] if r.random() < 0.5 else ["the", "of", "in", "new", "York"]) for _ in range(r.randrange(60))]
        if i % 3 == 0:
            words += "common PHRASE of five words".split() * (i % 4)
        rows.append((i, "".join(w + r.choice([" ", " ", " ", "  ", ". ", "\t", "\n", ", ", "\r"]) for w in words), r.choice(["en", "fr", None, "", "und"]), 1, "p"))
    return rows


@pytest.mark.parametrize("ranges", [4 << 20, 200])
def test_against_brute_force(spark, monkeypatch, ranges):
    monkeypatch.setattr(collocations, "RANGE_BYTES", ranges)
    monkeypatch.setattr(collocations, "CHUNK", 900)
    rows = corpus(3, 300)
    df = spark.createDataFrame(rows, FIELDS).repartition(3)
    want = brute([(r[2], r[1]) for r in rows], 7, 50)
    assert len(want) > 100 and mined(df, least=7, first=50) == want
    assert mined(df, least=7, first=None, inside=60) == brute([(r[2], r[1]) for r in rows], 7, 10**9, inside=60)


def test_odd_rows(spark, messy, empty):
    rows = [(r[2], r[1]) for r in messy_rows()]
    assert mined(messy, least=2) == brute(rows, 2, 2000)
    assert mined(empty) == [] and mined(messy.where("text is null")) == []


def test_one_suffix_holds_most_rows(spark, monkeypatch):
    monkeypatch.setattr(collocations, "RANGE_BYTES", 100)
    rows = [(i, "again and again we say so", "en", 1, "p") for i in range(150)] + [(i, prose(30, i), "en", 1, "p") for i in range(40)]
    assert mined(spark.createDataFrame(rows, FIELDS), least=30) == brute([(r[2], r[1]) for r in rows], 30, 2000)


def test_large_counts_are_exact(spark):
    from pyspark.sql import functions as F
    a, n, l, r = 3_000_000_000_000, 9_000_000_000_000_007, 3_000_000_000_001, 4_000_000_000_003
    row = spark.createDataFrame([(a, n, l, r)], "a long, n long, l long, r long").select(
        F.expr("(cast(1000 as decimal(38,0)) * cast(a as decimal(20,0)) * cast(n as decimal(20,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))").alias("s")).first()
    assert row["s"] == 1000 * a * n // (l * r)


def test_quicksort_counts_prefixes():
    rng = np.random.default_rng(0)
    codes = rng.integers(1, 5, size=(4, 3000)).astype(np.int32)
    codes[2, rng.random(3000) < 0.2] = 0
    codes[3, codes[2] == 0] = 0
    weight = rng.integers(1, 4, 3000)
    want = Counter()
    for row, w in zip(codes.T.tolist(), weight.tolist()):
        row = [c for c in row if c]
        for k in range(1, len(row) + 1):
            want[tuple(row[:k])] += w
    end = [2, 3, 1, 4]
    got = dict(collocations.quicksorted(codes, weight, 60, [end]))
    assert got == {p: w for p, w in want.items() if w >= 60 or list(p) == end[:len(p)]}


def test_suffixes_in_order():
    s = collocations.Suffixes(pa.array(["b", None]), pa.array(["x y\nx", "x"]), 2)
    s.sort()
    names = ["-", *s.names.to_pylist()]
    assert [[names[c] for c in row] for row in s.codes.T] == [["b", "x", "-"], ["b", "x", "y"], ["b", "y", "-"], ["und", "x", "-"]]
    assert s.begins([["a"], ["b", "x", "y"], ["b", "xx"], ["c", "x"], ["und", "x"], ["und", "x", "a"]]).tolist() == [0, 1, 2, 3, 3, 4]


def test_query(spark, tmp_path):
    from sparkstats.llm.queries import QUERIES
    rows = [(i, f"one two three. {prose(5, i)}", "en", 1, "p") for i in range(120)]
    spark.createDataFrame(rows, FIELDS).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op11_collocations"](spark, str(tmp_path))
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {t for c, t in got.dtypes if c not in ("lang", "phrase")} == {"bigint"}
    assert sorted(map(tuple, got.collect())) == brute([(r[2], r[1]) for r in rows], 100, 2000)
