"""WARC round trips, the index, and the pipeline end to end."""

import base64
import gzip
import hashlib
import io
import random

import corpus_pipeline
import pytest
from corpus_rows import messy_rows, prose, rows_of
from pyspark.sql import functions as F

from sparkstats.llm import common, quality, secrets, simhash, warc

HTML = [(1, "http://www.Example.org/a?b=1#c", "<p>é\r\n\r\nWARC/1.1\r\n</p>"), (2, "https://example.org:8443/x", "<p>same</p>"), (3, None, "<p>same</p>"), (4, "not a url [", ""),
        (5, "http://b.example.org/\t\r\n x", None), (6, "http://www.example.org/a?b=1", "<p>same</p>"), (7, "http://z.net", "x" * 300_000), (7, "http://z.net", "x" * 300_000), (None, "http://n.net", "null id")]


def read_back(pages, spark, folder):
    warc.write(pages, f"{folder}/archives")
    content = warc.archives(spark, f"{folder}/archives")
    warc.write_index(warc.entries(content), f"{folder}/index")
    index = spark.read.parquet(f"{folder}/index")
    return content, index, warc.read(warc.find(warc.keys_of(pages), index))


def test_round_trip(spark, tmp_path):
    pages = spark.createDataFrame(HTML, "page_id long, url string, html string").withColumn("key", F.lit("k")).withColumn("file", F.lit(1)).repartition(2)
    content, _, found = read_back(pages, spark, str(tmp_path))
    got = rows_of(found)
    first = {}
    for i, _, h in HTML:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    want = []
    for i, _, h in HTML:
        h = h or ""
        response = i is None or first[h] == i
        want.append((i, len(h.encode()), base64.b32encode(hashlib.sha1(h.encode()).digest()).decode(), "response" if response else "revisit", None if response else first[h], h if response else None))
    key = lambda x: tuple((v is None, str(v)) for v in x)
    assert sorted([(r["page"], r["payload_bytes"], r["digest"], r["kind"], r["refers_to"], r["payload"]) for r in got], key=key) == sorted(want, key=key)
    files = sorted((tmp_path / "archives").rglob("part-*"))
    assert sum(gzip.open(f).read().count(b"WARC-Record-ID") for f in files) == len(HTML)


def test_empty_pages(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    _, index, found = read_back(pages, spark, str(tmp_path))
    assert index.count() == 0 and found.count() == 0


def test_members_are_read_by_their_ranges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    monkeypatch.setattr(warc, "RUN_BYTES", 700)
    pages = spark.range(60).select(F.col("id").alias("page_id"), F.lit("http://a.org/").alias("url"), F.concat(F.sha2(F.col("id").cast("string"), 256), F.lit("é")).alias("html"))
    content, index, found = read_back(pages.coalesce(2), spark, str(tmp_path))
    want = {i: hashlib.sha256(str(i).encode()).hexdigest() + "é" for i in range(60)}
    assert {r["page"]: r["payload"] for r in rows_of(found)} == want
    sizes = {r["path"]: r["length"] for r in rows_of(content)}
    assert len(sizes) > 4 and max(sizes.values()) < 2000 + 500
    places = rows_of(warc.entries(content))
    by_file = {}
    for r in places:
        by_file.setdefault(r["file"], []).append((r["at"], r["size"]))
    for file, ranges in by_file.items():
        ends = [0]
        with warc.opened(file) as stream:
            for at, size in sorted(ranges):
                assert at == ends[-1]
                stream.seek(at)
                assert gzip.decompress(stream.read(size)).startswith(b"WARC/1.1")
                ends.append(at + size)
        assert ends[-1] == sizes[file]
    # Bytes outside the ranges asked for are never looked at: spoil every record but one per archive.
    kept = {file: sorted(ranges)[1] for file, ranges in by_file.items() if len(ranges) > 1}
    for file, (at, size) in kept.items():
        with open(file.removeprefix("file:"), "r+b") as stream:
            stream.write(b"?" * at)
            stream.seek(at + size)
            stream.write(b"?" * (sizes[file] - at - size))
    asked = spark.createDataFrame([(f, a, n) for f, (a, n) in kept.items() for _ in range(2)], "file string, at long, size long")
    got = rows_of(warc.read(asked))
    assert len(got) == len(kept) and all(r["payload"] == want[r["page"]] for r in got)


def test_records_over_several_members(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "MEMBER", 1000)
    rows = [(i, f"http://a.org/{i}", "".join(hashlib.sha256(f"{i} {j}".encode()).hexdigest() for j in range(i * 7))) for i in range(12)]
    _, _, found = read_back(spark.createDataFrame(rows, "page_id long, url string, html string"), spark, str(tmp_path))
    assert {r["page"]: r["payload"] for r in rows_of(found)} == {i: h for i, _, h in rows}
    data = b"x" * ((1 << 24) + 5)
    packed = warc.member(data, (1 << 24) - 1)
    assert packed[-1] == 0 and gzip.decompress(packed) == data


@pytest.mark.parametrize("spoil", [lambda b: b[:-3], lambda b: b[:40]])
def test_archives_that_are_cut_off(spoil):
    whole = warc.member(warc.record(1, "http://a.org", "text", warc.digest_of(b"text"), None).encode() + b"\r\n\r\n", 1 << 20)
    assert [(at, size) for _, at, size in warc.scanned(io.BytesIO(whole * 3), chunk=7, piece=11)] == [(i * len(whole), len(whole)) for i in range(3)]
    with pytest.raises(ValueError):
        list(warc.scanned(io.BytesIO(whole + spoil(whole))))


@pytest.mark.parametrize("most", [100_000, 3])
def test_index_over_many_blocks(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(warc, "ENTRIES", 7)
    keys = [f"org,h{i % 50})/{i} {i}" for i in range(700)] + ["org,hot)/ 1"] * 60
    rows = [(k, f"f{i % 4}", i, 10) for i, k in enumerate(keys)]
    warc.write_index(spark.createDataFrame(rows, "key string, file string, at long, size long"), f"{tmp_path}/index")
    sought = ["org,hot)/ 1", "org,h3)/3 3", "org,h49)/699 699", "absent", "zz", ""]
    found = rows_of(warc.find(spark.createDataFrame([(k,) for k in sought], "key string"), spark.read.parquet(f"{tmp_path}/index"), most))
    assert sorted((r["key"], r["file"], r["at"], r["size"]) for r in found) == sorted(r for r in rows if r[0] in sought)


def test_url_keys():
    assert warc.url_key("https://a.b.org:81/x?y#z") == "org,b,a:81)/x?y" and warc.url_key("http://B.org") == "org,b)/"
    assert warc.url_key(None) == warc.url_key("") and warc.url_key("http://[") .startswith(")")


# ---- pipeline ----------------------------------------------------------------------------

@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    r = random.Random(1)
    rows, known = [], []
    for i in range(160):
        text = prose(150, i)
        if i % 8 == 1:
            text = prose(150, i).upper().replace(" ", "!! ")
            known.append((i, 0, 0))
        elif i % 8 == 2:
            text = prose(150, i - 2)
        elif i % 8 == 3:
            words = prose(150, i - 3).split(" ")
            words[r.randrange(150)] = "other"
            text = " ".join(words)
        else:
            known.append((i, 1, 0))
        if i % 16 == 4:
            text += " password=abcdef1234567890 end"
        rows.append((i, text, "en", f"s{i % 3}", len(text)))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(known, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_pipeline(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    want = docs.columns
    by_stage = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, tables)
        rows = rows_of(docs)
        by_stage[name] = rows
        if name != "sentencepiece":
            assert docs.columns == want
        path = common.new_path(spark, "test-stage")
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
    good = {r["doc_id"] for r in by_stage["quality_rules"]}
    assert all(i not in good for i in range(1, 160, 8)) and len(good) == 140
    kept = {r["doc_id"] for r in by_stage["near_dedup"]}
    assert kept == {i for i in good if i % 8 not in (2, 3)}
    assert not any("abcdef1234567890" in r["text"] for r in by_stage["secret_scan"]) and len(by_stage["secret_scan"]) == len(kept)
    words = sum(len(r["text"].split()) for r in by_stage["mixing"])
    assert 0.8 < words / sum(len(r["text"].split()) for r in by_stage["secret_scan"]) < 1.2
    assert len(by_stage["sentencepiece"]) == len(by_stage["mixing"]) and all(r["n_pieces"] == len(r["ids"]) > 0 for r in by_stage["sentencepiece"])
    whole = rows_of(corpus_pipeline.run(spark, tables))
    key = lambda rows: sorted((r["doc_id"], r["n_pieces"], str(r["ids"])) for r in rows)
    assert key(whole) == key(by_stage["sentencepiece"])


def test_stages_on_odd_rows(messy, empty, labels):
    for stage in (lambda d: quality.kept(d, labels), simhash.deduplicated, secrets.redacted):
        assert stage(messy).columns == messy.columns and stage(messy).count() <= len(messy_rows()) and stage(empty).count() == 0
