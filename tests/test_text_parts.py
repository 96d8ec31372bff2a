"""Texts are counted some bytes at a time, with the same counts."""

import pyarrow as pa
from pyspark.sql import functions as F

from sparkstats.functions import arrow_text as at
from sparkstats.operators import documents as dc


def test_parts_are_bounded_and_whole():
    texts = pa.array(["ab", None, "", "c" * 9, "é", "d"]).slice(0)
    cut = list(at.parts(texts, 4))
    assert [(first, part.to_pylist()) for first, part in cut] == [(0, ["ab", None, ""]), (3, ["c" * 9]), (4, ["é", "d"])]
    assert list(at.parts(pa.array([], pa.string()), 4)) == []
    assert [(first, part.to_pylist()) for first, part in at.parts(texts.slice(1, 3), 4)] == [(0, [None, ""]), (2, ["c" * 9])]


def test_a_large_batch_is_counted_in_parts(spark):
    rows = [(i, ("x y x " + f"w{i} ") * 600) for i in range(1500)]  # one batch of more than three parts
    df = spark.createDataFrame(rows, "id long, t string").coalesce(1)

    def items(texts):
        if sum(len(t or "") for t in texts.to_pylist()) > at.PART_BYTES:
            raise ValueError("a part is too large")
        return [at.Items(texts, at.NO_WORD)]

    got = {(r["id"], r["term"]): r["cnt"] for r in dc._counted(df, "id", F.col("t"), "term", items).collect()}
    assert got == {(i, w): n for i, _ in rows for w, n in (("x", 1200), ("y", 600), (f"w{i}", 600))}
    total = {r["term"]: r["cnt"] for r in dc._totals(df, F.col("t"), "term", items).collect()}
    assert total == {"x": 1200 * 1500, "y": 600 * 1500} | {f"w{i}": 600 for i in range(1500)}


def test_lines_are_restored_in_parts(spark, monkeypatch):
    monkeypatch.setattr(dc, "WORDS_AT_ONCE", 3)
    rows = [(0, "a b c d e"), (1, None), (2, ""), (3, "b"), (4, "a a"), (5, " b  q ")]
    lines = spark.createDataFrame(rows, "id int, t string").coalesce(1)
    forms = spark.createDataFrame([("a", "á"), ("b", "ß")], "plain string, word string")
    got = {r["id"]: r["restored"] for r in dc.restore(lines, forms, ["id"], "t").collect()}
    assert got == {0: "á ß c d e", 1: "", 2: "", 3: "ß", 4: "á á", 5: "ß q"}
