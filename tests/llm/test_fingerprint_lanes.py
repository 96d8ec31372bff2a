"""The lanes of fingerprints against sums made in Python, on long texts, and through the query."""

import hashlib
import re

import numpy as np
import xxhash
from corpus_rows import messy_rows, prose, rows_of
from pyspark.sql import functions as F

from sparkstats.llm import fingerprints

FORM = "t string"


def hashed(seed: int, text: str) -> int:
    """Spark's xxhash64 of an int, then a string."""
    first = xxhash.xxh64_intdigest(seed.to_bytes(4, "little"), 42)
    return xxhash.xxh64_intdigest(text.encode(), first)


def brute(text: str):
    lines = text.split("\n") if text else []
    lanes = []
    for i in range(fingerprints.WIDE):
        h = [hashed(i, p) for p in lines]
        lanes.append((sum(x >> 32 for x in h) % 2**32) << 32 | sum(x & 0xFFFFFFFF for x in h) % 2**32)
    parts = [s for s in re.split("[.\n]", text) if s]
    signs = []
    for seed in range(fingerprints.SIGNS):
        h = [hashed(seed, s) for s in parts]
        signs += [sum(x >> k + 32 & 1 for x in h) << 32 | sum(x >> k & 1 for x in h) for k in range(32)]
    return "".join(f"{v:016x}" for v in [*lanes, *signs, len(parts)]), parts


def likeness(a: str, b: str) -> float:
    (fa, pa), (fb, pb) = brute(a), brute(b)
    if fa == fb:
        return 1.0
    if not pa or not pb:
        return 0.0
    def vector(f, n):
        v = [int(f[i:i + 8], 16) for i in range(16 * fingerprints.WIDE, len(f) - 16, 8)]
        return np.array([2 * c - n for c in v], float)
    x, y = vector(fa, len(pa)), vector(fb, len(pb))
    size = np.sqrt(x @ x) * np.sqrt(y @ y)
    return float(min(1, max(0, x @ y / size))) if size else 0.0


def test_query_against_sums_in_python(spark, tmp_path):
    from sparkstats.llm.queries import QUERIES
    texts = [(r[0], r[1]) for r in messy_rows() if r[0] is not None]
    texts = sorted({i: (i, t) for i, t in texts}.values())
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in rows_of(QUERIES["op1_fingerprints"](spark, str(tmp_path)))}
    down = sorted(((i, t or "") for i, t in texts), reverse=True)
    for n, (i, t) in enumerate(down):
        follows, half = down[(n + 1) % len(down)][1], len(t) // 2
        new = t[:len(t) - half] + follows[:half]
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(new.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (brute(t)[0], brute(new)[0])
        assert abs(r["near_edited"] - likeness(t, new)) < 1e-9 and abs(r["near_next"] - likeness(t, follows)) < 1e-9


def test_two_million_sentences(spark):
    text = "a." * (1 << 21) + "b"
    df = spark.range(1).select(F.concat(F.repeat(F.lit("a."), 1 << 21), F.lit("b")).alias("t")).select(fingerprints.fingerprint(F.col("t")).alias("f"))
    df = df.cache()
    one = df.select(fingerprints.written(F.col("f")).alias("w"), fingerprints.n_sentences(F.col("f")).alias("n"),
                    fingerprints.likeness(F.col("f"), fingerprints.plus(F.col("f"), F.col("f"))).alias("like")).first()
    assert one["n"] == (1 << 21) + 1 and one["like"] > 0.999
    a, b = (fingerprints.SIGNS, [hashed(s, "a") for s in range(fingerprints.SIGNS)]), [hashed(s, "b") for s in range(fingerprints.SIGNS)]
    want = "".join(f"{(((a[1][s] >> k + 32 & 1) << 21) + (b[s] >> k + 32 & 1)) << 32 | ((a[1][s] >> k & 1) << 21) + (b[s] >> k & 1):016x}" for s in range(fingerprints.SIGNS) for k in range(32))
    assert one["w"][16 * fingerprints.WIDE:-16] == want and len(text) > 4_000_000


def test_likeness_error(spark):
    """Texts that share a known part of their sentences."""
    rows = []
    for seed in range(40):
        s = [prose(8, 1000 * seed + i).replace(".", "").replace("\n", "") for i in range(60)]
        rows.append((". ".join(s[:40]), ". ".join(s[20:60])))
    got = [r["l"] for r in spark.createDataFrame(rows, "a string, b string").select(
        fingerprints.likeness(fingerprints.fingerprint(F.col("a")), fingerprints.fingerprint(F.col("b"))).alias("l")).collect()]
    assert abs(np.mean(got) - 0.5) < 0.05 and np.std(got) < 0.08
