"""WARC archives: a writer of records as single gzip members, and a reader that splits archives at any byte.

The reader's tasks each get a byte range. A task scans its range for the gzip magic, takes a candidate for a member's start only if
its inflated head is a WARC version line with parsable headers, and owns the records that start inside its range; the last of them may
end in the next range. Inside a member nothing is scanned, as the inflater tells where the member ends.

Archives lie in the shared folder, through pyarrow's file systems (local, HDFS, S3 and others, by the URI). Each writing task makes a
file of its own name and the manifest, a table, lists the files of the tasks that counted; what a lost task has left isn't in it.

A URL with control characters or spaces is percent-encoded in WARC-Target-URI, and stands as it is, encoded whole, in X-Page-URL: no URL can break
a header, and the exact one is read back. What is read is counted against the manifest; a record that is missing is an error.

A null payload is empty, a null URL too. Very long payloads are whole: a record may be larger than a range, and is read by the task that owns its start. Of records with equal payloads of min_bytes or more, the one with the largest page_id is a response and the
others revisit it. Rows that repeat a page_id are all written: where the largest id itself repeats, all its rows are responses. A null
page_id comes before all others. Columns beside page_id, url and html are ignored; an empty table gives no archive.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import _arrow_schema, drop_folder, lookup, map_rows, materialize, new_folder, to_batch

MAGIC = b"\x1f\x8b\x08"
#: Bytes of an archive that a reading task owns.
SPLIT_BYTES = 8 << 20
#: Reading tasks at most; with more ranges each task reads several.
MOST_TASKS = 20_000
#: Bytes after which a writing task opens its next archive.
ARCHIVE_BYTES = 256 << 20
_READ = 1 << 20


_BREAKS = re.compile("[\x00-\x20\x7f]")


def target(url: str) -> list[str]:
    """The headers that hold a URL."""
    if not _BREAKS.search(url):
        return [f"WARC-Target-URI: {url}"]
    return [f"WARC-Target-URI: {_BREAKS.sub(lambda m: quote(m.group()), url)}", f"X-Page-URL: {quote(url, safe='')}"]


def url_of(headers: dict[str, str]) -> str | None:
    exact = headers.get("x-page-url")
    return headers.get("warc-target-uri") if exact is None else unquote(exact)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, url: str, page_id: int | None, payload: bytes, payload_digest: str, refers_to: int | None = None) -> bytes:
    """A WARC record, not compressed. A revisit has no block; its payload's length and digest stand in its headers."""
    number = "null" if page_id is None else str(page_id)
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{number}')}>", "WARC-Date: 2024-01-01T00:00:00Z",
        *target(url), f"WARC-Payload-Digest: sha1:{payload_digest}", f"X-Page-ID: {number}", f"X-Payload-Length: {len(payload)}",
    ]
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{refers_to}')}>", f"X-Refers-To-Page: {refers_to}"]
        payload = b""
    lines += ["Content-Type: text/html", f"Content-Length: {len(payload)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def plan_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload and refers_to (null for responses).

    Equal payloads are found by their SHA-1, counted map-side. Frequent digests are few, by a share of all rows, and are broadcast; the
    others are joined on the digest.
    """
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("key", F.when(F.length("payload") >= min_bytes, F.sha1("payload")))
    groups = rows.where("key is not null").groupBy("key").agg(F.max("page_id").alias("last"), F.count("*").alias("n"))
    groups = materialize(groups.where("n > 1"), "payload-groups")
    rows = lookup(rows, "key", groups, F.xxhash64("page_id", "url").cast("string"))
    return rows.select("page_id", "url", "payload", F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last")).alias("refers_to"))


def write_archives(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes all pages' records; returns the manifest: path, bytes and records of each archive."""
    spark = pages.sparkSession
    folder = new_folder(spark, "warc")
    schema = "path string, bytes long, records long"
    arrow = _arrow_schema(spark, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        store, root = _open(folder)
        store.create_dir(root, recursive=True)
        out, path, size, records = None, "", 0, 0
        for batch in batches:
            for page_id, url, payload, refers_to in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if out is None:
                    path = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
                    out, size, records = store.open_output_stream(f"{root}/{path}", compression=None), 0, 0
                kind = "response" if refers_to is None else "revisit"
                member = gzip_member(record(kind, url, page_id, payload, digest(payload), refers_to))
                out.write(member)
                size, records = size + len(member), records + 1
                if size >= ARCHIVE_BYTES:
                    out.close()
                    out = None
                    yield to_batch([(f"{folder}/{path}", size, records)], arrow)
        if out is not None:
            out.close()
            yield to_batch([(f"{folder}/{path}", size, records)], arrow)

    return materialize(plan_revisits(pages, min_bytes).mapInArrow(run, schema), "warc-manifest")


def splits(manifest: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """path, start and end of the byte ranges, each row for a task."""
    ranges = manifest.select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split_bytes).cast("long"))).alias("start"))
    return ranges.select("path", "start", F.least(F.col("start") + split_bytes, F.col("bytes")).alias("end"))


def _headers(head: bytes) -> dict[str, str] | None:
    """The headers of a record whose head is complete in head; None if it is no WARC record."""
    if not head.startswith(b"WARC/1."):
        return None
    lines = head.split(b"\r\n")
    out = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        out[name.decode("latin-1").lower()] = value.strip().decode("utf-8", "replace")
    return out if "warc-type" in out and out.get("content-length", "").isdigit() else None


class _Window:
    """Bytes of a file from a moving start on; read in pieces."""

    def __init__(self, file, start: int) -> None:
        self.file, self.start, self.data, self.ended = file, start, bytearray(), False

    def more(self) -> bool:
        if self.ended:
            return False
        piece = self.file.read_at(_READ, self.start + len(self.data))
        self.ended = not piece
        self.data += piece
        return not self.ended

    def forget(self, upto: int) -> None:
        if upto - self.start > _READ:
            del self.data[: upto - self.start]
            self.start = upto


def _inflate(window: _Window, at: int) -> tuple[dict[str, str], bytes, int] | None:
    """Headers, block and end of the member at a place; None if there is none. The head is validated before the rest is read."""
    unpack = zlib.decompressobj(31)
    out, fed, headers, body = bytearray(), at, None, 0
    while not unpack.eof:
        piece = bytes(window.data[fed - window.start : fed - window.start + (4096 if headers is None else 65536)])
        if not piece:
            if not window.more():
                return None
            continue
        try:
            out += unpack.decompress(piece)
        except zlib.error:
            return None
        fed += len(piece)
        if headers is None:
            if len(out) >= 7 and not out.startswith(b"WARC/1."):
                return None
            if (end := out.find(b"\r\n\r\n")) >= 0:
                headers, body = _headers(bytes(out[:end])), end + 4
                if headers is None:
                    return None
    if headers is None or len(out) - body < int(headers["content-length"]):
        return None
    return headers, bytes(out[body : body + int(headers["content-length"])]), fed - len(unpack.unused_data)


def read_range(file, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Offset, headers and block of the records that start in a byte range of a file (with read_at)."""
    window, at = _Window(file, start), start
    while at < end:
        found = window.data.find(MAGIC, at - window.start)
        if found < 0 or window.start + found + 3 > window.start + len(window.data):
            at = max(at, window.start + len(window.data) - 2)
            window.forget(at)
            if at >= end or not window.more():
                return
            continue
        at = window.start + found
        if at >= end:
            return
        got = _inflate(window, at)
        if got is None:
            at += 1
            continue
        yield at, got[0], got[1]
        at = got[2]
        window.forget(at)


class _Random:
    """read_at over pyarrow's random access files."""

    def __init__(self, file) -> None:
        self.file = file

    def read_at(self, n: int, at: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)


READ_SCHEMA = "path string, offset long, page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long, digest_ok boolean"


def read_archives(ranges: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records of byte ranges (path, start, end). A response's digest is checked against its payload."""

    def one(row: dict) -> list[tuple]:
        store, path = _open(row["path"])
        out = []
        with store.open_input_file(path) as file:
            for offset, h, block in read_range(_Random(file), row["start"], row["end"]):
                kind = h["warc-type"]
                said = h.get("warc-payload-digest", "").removeprefix("sha1:")
                length = int(h.get("x-payload-length", len(block))) if kind == "revisit" else len(block)
                number = lambda key, h=h: int(h[key]) if h.get(key, "").lstrip("-").isdigit() else None
                out.append((row["path"], offset, number("x-page-id"), url_of(h), block if with_payload else None, length, said, kind, number("x-refers-to-page"), kind == "revisit" or digest(block) == said))
        return out

    return map_rows(ranges, lambda: one, READ_SCHEMA)


def deal(ranges: DataFrame) -> DataFrame:
    """Spreads byte ranges over as many tasks, MOST_TASKS at most. The number is given, as ranges are rows too small to tell how much they stand for."""
    return ranges.repartition(max(1, min(ranges.count(), MOST_TASKS)))


def round_trip(pages: DataFrame, min_bytes: int = 0, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Writes pages' archives and reads them back: one row per record. Raises if what is read isn't as many records as were written."""
    manifest = write_archives(pages, min_bytes)
    found = materialize(read_archives(deal(splits(manifest, split_bytes))), "warc-records")
    written, read = manifest.agg(F.sum("records")).first()[0] or 0, found.count()
    if written != read:
        raise RuntimeError(f"{written} records were written, but {read} read")
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok")


def remove_archives(spark: SparkSession, manifest: DataFrame) -> None:
    """Removes the folders of a manifest's archives."""
    for row in manifest.select(F.regexp_replace("path", "/[^/]*$", "").alias("folder")).distinct().collect():
        drop_folder(spark, row["folder"])
