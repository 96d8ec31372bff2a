"""WARC archives of pages, and a two-level capture index to find records by URL.

Archives are WARC 1.1 files of HTTP responses with one gzip member per record, written by Spark's text writer, so
that its commits and retries hold. The index sorts reversed-host URL keys into compressed blocks; a sparse directory
has the first key of every few blocks. A lookup searches the directory by bisection, then the block, then seeks to
the record's range in its archive and reads nothing else.

Tasks open archives by their paths: folders that all executors mount (`file:`), or any file system of pyarrow.
"""

import base64
import hashlib
import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import small

END = "\r\n\r\n"
DATE = "2000-01-01T00:00:00Z"
#: Entries of an index block, directory entries that are broadcast: each at most.
ENTRIES, DIRECTORY = 512, 100_000
#: An archive is closed once it has this many bytes; records of one run of this many bytes are read in one task.
ARCHIVE_BYTES, RUN_BYTES = 256 << 20, 32 << 20
#: Ranges less than GAP apart are read at once, up to READ_BYTES; a batch of rows leaves a task at READ_BYTES.
READ_BYTES, GAP = 8 << 20, 64 << 10
#: A gzip member holds fewer bytes than this, so that its last byte, the highest of their number, is 0.
MEMBER = (1 << 24) - 1


def digest_of(payload: bytes) -> str:
    """Bare base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def digest(payload: Column) -> Column:
    """The digest of a string column in UTF-8; null counts as empty."""
    @F.arrow_udf("string")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([digest_of(x.as_py() or b"") for x in texts.cast(pa.binary())], pa.string())
    return run(payload)


def url_key(url: str | None) -> str:
    """The host reversed, then port, path and query: https://a.b.org:81/x?y#z gives org,b,a:81)/x?y."""
    try:
        parts = urlsplit(url or "")
        host, port = (parts.hostname or "").lower(), parts.port
    except ValueError:
        return ")" + url
    named = ",".join(reversed(host.split("."))) + (f":{port}" if port not in (None, 80, 443) else "")
    return f"{named}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def entry_key(url: str | None, page: int | None) -> str:
    """Keys tell captures of one URL apart by the page; they sort as UTF-8."""
    return f"{url_key(url)} {'null' if page is None else page}"


# ---- writing ---------------------------------------------------------------------

def record(page, url, payload: str, sha1: str, refers_to) -> str:
    """A record without its closing blank lines. A revisit has the HTTP header only."""
    revisit = refers_to is not None
    size = len(payload.encode())
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    clean = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'null' if page is None else page}>",
            f"WARC-Date: {DATE}", f"WARC-Target-URI: {clean}", f"WARC-Payload-Digest: sha1:{sha1}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    body = http + ("" if revisit else payload)
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(http) + (0 if revisit else size)}"]
    return "\r\n".join(head) + END + body


def member(data: bytes, size: int) -> bytes:
    """A record as one gzip member, or as several in a row where it has over `size` bytes."""
    out = []
    for at in range(0, len(data), size):
        packer = zlib.compressobj(wbits=31)
        out += [packer.compress(data[at:at + size]), packer.flush()]
    return b"".join(out)


def write(pages: DataFrame, path: str, id_col: str = "page_id", url: str = "url", payload: str = "html", least: int = 0) -> None:
    """One record per row of pages, in archives of about ARCHIVE_BYTES below `path`.

    Of rows with equal payloads of at least `least` bytes, that with the smallest id is the response and the
    others are revisits of it; rows that repeat that id are responses too. Rows without an id are responses.
    A null payload is the empty one, a null URL the empty one. Other columns are not read. An empty table
    gives no archives.
    """
    rows = pages.select(F.col(id_col).alias("page"), F.col(url).alias("url"), F.col(payload).alias("html")).withColumn("sha1", digest(F.col("html")))
    narrow = rows.select("page", "sha1", F.coalesce(F.octet_length("html"), F.lit(0)).alias("n"))
    shared = (narrow.where(F.col("n") >= least).groupBy("sha1").agg(F.min("page").alias("first"), F.count("*").alias("copies"))
              .where(F.col("copies") > 1).select(F.col("sha1").alias("_sha1"), "first"))
    marked = rows.join(small(shared, shared.count(), 64), F.col("sha1") == F.col("_sha1"), "left")
    closing, size, limit, most = END.encode(), MEMBER, ARCHIVE_BYTES, READ_BYTES

    def records(batches):
        archive = written = held = 0
        names, values = [], []

        def batch_of():
            return pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(values, pa.binary())], names=["archive", "value"])
        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("page", "url", "html", "sha1", "first"))):
                page, link, html, sha1, first = (x.as_py() for x in row)
                refers = None if first is None or page is None or page == first else first
                # The text writer ends each row with a byte 0: the last of the member.
                packed = member(record(page, link, html or "", sha1, refers).encode() + closing, size)[:-1]
                names.append(archive)
                values.append(packed)
                held += len(packed)
                written += len(packed) + 1
                if written >= limit:
                    archive, written = archive + 1, 0
                if held >= most:
                    yield batch_of()
                    held, names, values = 0, [], []
        if values:
            yield batch_of()
    lines = marked.select("page", "url", "html", "sha1", "first").mapInArrow(records, "archive long, value binary")
    lines.select("archive", F.col("value").cast("string").alias("value")).write.partitionBy("archive").option("lineSep", "\0").text(path)


# ---- reading ---------------------------------------------------------------------

def archives(spark: SparkSession, path: str) -> DataFrame:
    """(path, length): the archive files below a path, whose contents are not read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", True).load(path)
            .select("path", "length"))


def opened(path: str):
    """A file to seek in."""
    if path.startswith("/") or path.startswith("file:"):
        return open("/" + path.removeprefix("file:").lstrip("/"), "rb")
    where, name = fs.FileSystem.from_uri(path)
    return where.open_input_file(name)


def inflated(data: bytes) -> bytes:
    """All gzip members of a range."""
    out = []
    while data:
        unpacker = zlib.decompressobj(31)
        out += [unpacker.decompress(data), unpacker.flush()]
        if not unpacker.eof:
            raise ValueError("a gzip member is cut off")
        data = unpacker.unused_data
    return b"".join(out)


def scanned(stream, chunk: int = 64 << 10, piece: int = 4 << 20) -> Iterator[tuple[dict[str, str], int, int]]:
    """The header of each record of an archive, and where its members begin and how many bytes they have.

    The archive is read through once; a chunk of it, a piece of what is unpacked and a header are held.
    """
    raw, at = stream.read(chunk), 0
    while raw:
        begin, seen, whole, head, start = at, 0, None, None, b""
        while whole is None or seen < whole:
            unpacker = zlib.decompressobj(31)
            while not unpacker.eof:
                raw = raw or stream.read(chunk)
                if not raw:
                    raise ValueError(f"the record at {begin} is cut off")
                got = unpacker.decompress(raw, piece)
                rest = unpacker.unused_data if unpacker.eof else unpacker.unconsumed_tail
                at += len(raw) - len(rest)
                raw, seen = rest, seen + len(got)
                if head is None:
                    start += got
                    if END.encode() in start:
                        head, _, end = parsed(start, 0)
                        whole, start = end + len(END), b""
            raw = raw or stream.read(chunk)
        yield head, begin, at - begin


def parsed(data: bytes, at: int) -> tuple[dict[str, str], int, int]:
    """The header of the record at a place, and where its block begins and ends."""
    split = data.index(b"\r\n\r\n", at)
    lines = data[at:split].decode().split("\r\n")
    head = dict(line.split(": ", 1) for line in lines[1:])
    return head, split + 4, split + 4 + int(head["Content-Length"])


def page_of(urn: str | None) -> int | None:
    found = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(found) if found and found != "null" else None


def entries(found: DataFrame) -> DataFrame:
    """(key, file, at, size) of every record of archives: the range of its gzip members. Archives are not shuffled."""
    def rows_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.string(), pa.int64(), pa.int64()))],
                                          names=["key", "file", "at", "size"])

    def run(batches):
        rows = []
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with opened(path) as stream:
                    for head, at, size in scanned(stream):
                        rows.append((entry_key(head["WARC-Target-URI"], page_of(head["WARC-Record-ID"])), path, at, size))
                        if len(rows) == 10_000:
                            yield rows_of(rows)
                            rows = []
        if rows:
            yield rows_of(rows)
    return found.select("path").mapInArrow(run, "key string, file string, at long, size long")


def write_index(records: DataFrame, path: str) -> None:
    """Blocks of entries in order of their keys, compressed, as a table below `path`.

    A block has its number in its part, its first and last key, and its lines `key \\t file \\t at \\t size`.
    """
    def run(batches):
        held, n = [], 0

        def block(lines):
            return pa.RecordBatch.from_pydict({
                "seq": pa.array([n], pa.int64()), "first": [lines[0][0]], "last": [lines[-1][0]],
                "packed": pa.array([zlib.compress("\n".join("\t".join(map(str, x)) for x in lines).encode())], pa.binary())})
        for batch in batches:
            held += zip(*(batch.column(c).to_pylist() for c in ("key", "file", "at", "size")))
            while len(held) >= ENTRIES:
                yield block(held[:ENTRIES])
                held, n = held[ENTRIES:], n + 1
        if held:
            yield block(held)
    ordered = records.withColumn("key", F.regexp_replace("key", "[\t\n]", " ")).repartitionByRange(F.col("key")).sortWithinPartitions("key", "file", "at")
    ordered.mapInArrow(run, "seq long, first string, last string, packed binary").withColumn("part", F.spark_partition_id()).write.parquet(path)


def find(keys: DataFrame, index: DataFrame, most: int = DIRECTORY) -> DataFrame:
    """(key, file, at, size) of the entries with the distinct keys given (column `key`).

    The directory has the first key of every m-th block of a part, such that at most about `most` keys are
    broadcast; the m blocks between two of them are searched together.
    """
    spark = keys.sparkSession
    m = -(-index.count() // most) or 1
    above = index.withColumn("group", F.concat_ws(":", "part", F.floor(F.col("seq") / m)))
    sparse = above.where(F.col("seq") % m == 0).select("first", "group").collect()
    ranked = sorted((r["first"].encode(), r["group"]) for r in sparse)
    held = spark.sparkContext.broadcast(([k for k, _ in ranked], [g for _, g in ranked]))

    def place(batches):
        firsts, groups = held.value
        for batch in batches:
            key, group = [], []
            for k in batch.column("key").to_pylist():
                b = k.encode()
                for i in range(max(0, bisect_left(firsts, b) - 1), bisect_right(firsts, b)):
                    key.append(k)
                    group.append(groups[i])
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.string()), pa.array(group, pa.string())], names=["key", "group"])

    def search(blocks: pa.Table, wanted: pa.Table) -> pa.Table:
        keys_ = sorted({k.encode(): k for k in wanted.column("key").to_pylist()}.items())
        sought, rows = [b for b, _ in keys_], []
        for first, last, packed in zip(*(blocks.column(c).to_pylist() for c in ("first", "last", "packed"))):
            low, high = bisect_left(sought, first.encode()), bisect_right(sought, last.encode())
            if low < high:
                lines = [x.split("\t") for x in zlib.decompress(packed).decode().split("\n")]
                names = [x[0].encode() for x in lines]
                for b in sought[low:high]:
                    rows += [(x[0], x[1], int(x[2]), int(x[3])) for x in lines[bisect_left(names, b):bisect_right(names, b)]]
        return pa.Table.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64(), pa.int64()))],
                                    names=["key", "file", "at", "size"])

    placed = keys.select(F.regexp_replace("key", "[\t\n]", " ").alias("key")).mapInArrow(place, "key string, group string")
    return (above.select("group", "first", "last", "packed").groupBy("group").cogroup(placed.groupBy("group"))
            .applyInArrow(search, "key string, file string, at long, size long"))


RESULT = "page long, payload_bytes long, digest string, kind string, refers_to long, payload string"


def reads(ranges: Iterator[tuple[str, int, int]]) -> Iterator[tuple[str, int, bytes]]:
    """(file, at, bytes) of each distinct range, given in order of (file, at): near ones are read at once."""
    name, stream, group = None, None, []

    def cut_out():
        begin = group[0][0]
        stream.seek(begin)
        data = stream.read(group[-1][0] + group[-1][1] - begin)
        for at, size in group:
            yield name, at, data[at - begin:at - begin + size]
    try:
        for file, at, size in ranges:
            if file == name and group and at == group[-1][0]:
                continue
            if group and (file != name or at - sum(group[-1]) > GAP or at + size - group[0][0] > READ_BYTES):
                yield from cut_out()
                group = []
            if file != name:
                if stream:
                    stream.close()
                name, stream = file, opened(file)
            group.append((at, size))
        if group:
            yield from cut_out()
    finally:
        if stream:
            stream.close()


def read(found: DataFrame, payloads: bool = True) -> DataFrame:
    """The records at (file, at, size), each checked against its digest: page, payload_bytes, digest, kind, refers_to, payload.

    Ranges are dealt to tasks in runs of RUN_BYTES of an archive and read in order; bytes between them are skipped.
    Equal ranges are read once. A revisit's bytes and digest are those of the payload it refers to; its payload is
    null. No ranges give no records.
    """
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    names, most = [c.split()[0] for c in RESULT.split(", ")], READ_BYTES

    def row(at: int, data: bytes) -> tuple:
        head, begin, end = parsed(data, 0)
        body = data.index(b"\r\n\r\n", begin) + 4
        size = int(re.search(r"Content-Length: (\d+)", data[begin:body].decode())[1])
        sha1, response = head["WARC-Payload-Digest"].removeprefix("sha1:"), head["WARC-Type"] == "response"
        got = data[body:end]
        if response and (len(got) != size or digest_of(got) != sha1):
            raise ValueError(f"the record at {at} does not match its digest")
        return (page_of(head["WARC-Record-ID"]), size, sha1, head["WARC-Type"], page_of(head.get("WARC-Refers-To")),
                got.decode() if payloads and response else None)

    def run(batches):
        ranges = (x for batch in batches for x in zip(*(batch.column(c).to_pylist() for c in ("file", "at", "size"))))
        rows, held = [], 0

        def batch_of():
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)
        for _, at, data in reads(ranges):
            rows.append(row(at, inflated(data)))
            held += 500 + len(rows[-1][-1] or "")
            if held >= most:
                yield batch_of()
                rows, held = [], 0
        if rows:
            yield batch_of()
    return (found.select("file", "at", "size").repartition("file", F.floor(F.col("at") / RUN_BYTES)).sortWithinPartitions("file", "at")
            .mapInArrow(run, RESULT))


def keys_of(pages: DataFrame, id_col: str = "page_id", url: str = "url") -> DataFrame:
    """The distinct index keys of pages."""
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([
                entry_key(re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", u or ""), p)
                for p, u in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())], pa.string())], names=["key"])
    return pages.select(id_col, url).mapInArrow(run, "key string").distinct()
