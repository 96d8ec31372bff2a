"""The registered queries of the corpus operators."""

from pyspark.sql import DataFrame, functions as F

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def table(spark, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op1_fingerprints")
def op1(spark, sf):
    from . import fingerprints
    found = fingerprints.edited(table(spark, sf, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                        fingerprints.written(F.col("fingerprint")).alias("fingerprint"),
                        fingerprints.written(F.col("edited_fingerprint")).alias("edited_fingerprint"), "near_edited", "near_next")


@query("op2_warc", sql="""
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM (
  SELECT page_id, h, (SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(('0b' || substr(bits, 5 * k + 1, 5)) AS INTEGER), 1), '' ORDER BY k) FROM range(32) t(k)) AS digest
  FROM (SELECT page_id, coalesce(html, '') AS h, (
    SELECT string_agg(lpad(bin(CAST('0x' || substr(sha1(coalesce(html, '')), 2 * i + 1, 2) AS INTEGER)), 8, '0'), '' ORDER BY i) FROM range(20) r(i)) AS bits FROM pages)))""")
def op2(spark, sf):
    from . import common, warc
    pages, path = table(spark, sf, "pages"), common.new_path(spark, "warc")
    warc.write(pages, f"{path}/archives")
    warc.entries(warc.archives(spark, f"{path}/archives")).write.parquet(f"{path}/entries")
    warc.write_index(spark.read.parquet(f"{path}/entries"), f"{path}/index")
    found = warc.find(warc.keys_of(pages), spark.read.parquet(f"{path}/index"))
    records = warc.read(found, payloads=False)
    return records.select(F.col("page").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"),
                          F.col("kind").alias("record_type"), "refers_to")


@query("op3_secret_scan")
def op3(spark, sf):
    from . import secrets
    found = secrets.scan(table(spark, sf, "documents"))
    base = secrets.joined(secrets.base_spans(F.col("spans")))
    return found.select(
        F.col("id").alias("doc_id"), *[secrets.count(F.col("spans"), k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(base, 256).alias("base_sha256"), secrets.joined(F.col("spans")).alias("spans"))


@query("op4_toxicity")
def op4(spark, sf):
    from . import toxicity
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    found = toxicity.score(table(spark, sf, "documents"), table(spark, sf, "labels"), held)
    return found.select(F.col("id").alias("doc_id"), "held_out", "score", "predicted")


@query("op5_sharding")
def op5(spark, sf):
    from . import sharding
    found = sharding.shard(table(spark, sf, "documents"))
    return found.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


@query("op6_mixing")
def op6(spark, sf):
    from . import mixing
    found = mixing.mix(table(spark, sf, "documents"))
    return found.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


@query("op7_quality_rules")
def op7(spark, sf):
    from . import quality
    scored = quality.judge(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return scored.select(F.col("id").alias("doc_id"), "quality_rules.*")


@query("op8_sentencepiece")
def op8(spark, sf):
    from . import pieces
    docs = table(spark, sf, "documents").select("doc_id", "text")
    coded = pieces.encoded(docs, pieces.MODEL)
    back = pieces.decoded(F.col("ids"), pieces.MODEL, spark)
    return coded.select("doc_id", "n_pieces", "ids", F.sha2(back, 256).alias("decoded_sha256"))


@query("op9_lm_score")
def op9(spark, sf):
    from . import contextmix
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    found = contextmix.score(table(spark, sf, "documents"), held)
    return found.select(F.col("id").alias("doc_id"), "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op10_simhash")
def op10(spark, sf):
    from . import simhash
    found = simhash.near_duplicates(table(spark, sf, "documents"))
    return found.select(F.col("id").alias("doc_id"), simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


@query("op13_packing")
def op13(spark, sf):
    import public_tokenizers

    from . import packing
    pieces = packing.packed(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select(F.col("doc").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op11_collocations")
def op11(spark, sf):
    from . import collocations
    return collocations.mine(table(spark, sf, "documents"))


@query("op12_whitening")
def op12(spark, sf):
    from . import whitening
    return whitening.whitened(table(spark, sf, "embeddings")).withColumnRenamed("id", "vec_id")
