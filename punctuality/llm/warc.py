"""Web archives (WARC 1.1) written and read by Spark tasks, with segment reassembly.

Writing: equal payloads are found by their SHA-256 and length; the one with the smallest page_id is a
response, the others revisits that refer to it. A response's block is an HTTP message with a chunked
body. A block longer than ``segment`` bytes is cut: the first record has segment number
1, continuation records name its id as their origin, the last one the total length. Every
task writes its records one after another through Spark's text writer, records being
bytes and the blank line that ends a record the separator; files are gzip streams.

Reading: a file is parsed record by record. A response or revisit without a segment number is whole and is decoded where
it is read. Segments are grouped by origin id over all files, ordered by segment number,
checked for a gap and for the total length, and joined. The chunked body is decoded and
compared with the digest. ``intact`` tells whether all of that held.

Null html is an empty payload. A null page_id is never the smallest and refers to nothing. Rows that share
the smallest page_id of a payload are all responses. Control characters in a url are percent-encoded; a
null url is left out. No rows: no archive records, an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctuality.session import scratch_path

DATE = "2024-01-01T00:00:00Z"
PARSED = "origin string, segment int, total long, kind string, page_id long, url string, digest string, length long, refers_to long, block binary"
_NAMES = ["origin", "segment", "total", "kind", "page_id", "url", "digest", "length", "refers_to", "block"]
_TYPES = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def with_originals(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, refers_to: the page that a revisit repeats, null for a response."""
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"))
    size = F.octet_length("payload")
    key = p.select("*", F.when(size >= least_bytes, F.concat_ws("-", F.sha2("payload", 256), size)).alias("key"))
    first = key.where("key is not null").groupBy(F.col("key").alias("k")).agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    out = key.join(first.where("n > 1 and first is not null").drop("n"), F.col("key") == F.col("k"), "left")
    refers = F.when(F.coalesce(F.col("page_id") != F.col("first"), F.lit(False)), F.col("first"))
    return out.select("page_id", "url", "payload", refers.alias("refers_to"))


def _header(fields: list[tuple[str, object]]) -> bytes:
    return b"WARC/1.1\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in fields if v is not None) + b"\r\n"


def _chunked(payload: bytes, size: int) -> bytes:
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(x), x) for x in parts) + b"0\r\n\r\n"


def _clean(url: str | None) -> str | None:
    return None if url is None else "".join(c if ord(c) > 32 and ord(c) != 127 else f"%{ord(c):02X}" for c in url)


def page_records(page_id, url, payload: bytes, refers_to, name: str, segment: int, chunk: int) -> Iterator[bytes]:
    """The records of one page, without the blank line that ends each."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if refers_to is None:
        block = http + b"Transfer-Encoding: chunked\r\n\r\n" + _chunked(payload, chunk)
    else:
        block = http + b"\r\n"
    about = [("WARC-Target-URI", _clean(url)), ("WARC-Date", DATE), ("WARC-Page-ID", page_id)]
    digest = [("WARC-Payload-Digest", "sha1:" + sha1_base32(payload)), ("WARC-Payload-Length", len(payload))]
    own = f"<urn:page:{page_id}:{name}>"
    if refers_to is not None:
        kind = [
            ("WARC-Type", "revisit"), ("WARC-Record-ID", own), ("WARC-Refers-To", f"<urn:page:{refers_to}>"),
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ]
        yield _header([*kind, *about, *digest, ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]) + block
        return
    parts = [block[i : i + segment] for i in range(0, len(block), segment)]
    for n, part in enumerate(parts, 1):
        several = len(parts) > 1
        if n == 1:
            fields = [("WARC-Type", "response"), ("WARC-Record-ID", own), *about, *digest, ("WARC-Segment-Number", 1 if several else None)]
        else:
            fields = [
                ("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:page:{page_id}:{name}:{n}>"), ("WARC-Date", DATE), ("WARC-Segment-Number", n),
                ("WARC-Segment-Origin-ID", own), ("WARC-Segment-Total-Length", len(block) if n == len(parts) else None),
            ]
        kind = "application/http; msgtype=response" if n == 1 else None
        yield _header([*fields, ("WARC-Block-Digest", "sha1:" + sha1_base32(part)), ("Content-Type", kind), ("Content-Length", len(part))]) + part


def write_warc(pages: DataFrame, path: str, segment: int = 32 << 10, chunk: int = 8 << 10, least_bytes: int = 0, file_records: int = 5000) -> None:
    """Write a record per row of ``pages`` (page_id, url, html) to archives under ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n = TaskContext.get().partitionId(), 0
        for b in batches:
            records = []
            size = 0
            for row in zip(*(b.column(c).to_pylist() for c in ("page_id", "url", "payload", "refers_to")), strict=True):
                for x in page_records(*row, f"{task}-{n}", segment, chunk):
                    records.append(x)
                    size += len(x)
                n += 1
                if size > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], ["record"])
                    records, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], ["record"])

    rows = with_originals(pages, least_bytes).mapInArrow(run, "record binary")
    writer = rows.select(F.col("record").cast("string").alias("value")).write
    writer.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", file_records).text(path)


class _Stream:
    """Bytes of a gzip file (of one or more members), a piece at a time."""

    def __init__(self, data: bytes):
        self.data, self.at, self.unpack, self.ready = data, 0, zlib.decompressobj(31), b""

    def more(self) -> bool:
        if self.unpack.eof:
            if not self.unpack.unused_data:
                return False
            rest, self.unpack = self.unpack.unused_data, zlib.decompressobj(31)
            self.ready += self.unpack.decompress(rest)
            return True
        if self.at >= len(self.data):
            return False
        self.ready += self.unpack.decompress(self.data[self.at : self.at + (1 << 18)])
        self.at += 1 << 18
        return True

    def until(self, mark: bytes) -> bytes | None:
        seen = 0
        while (x := self.ready.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.ready)
            if not self.more():
                return None
        out, self.ready = self.ready[:x], self.ready[x + len(mark) :]
        return out

    def take(self, n: int) -> bytes:
        while len(self.ready) < n and self.more():
            pass
        out, self.ready = self.ready[:n], self.ready[n:]
        return out


def records_of(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields in lower case, block) of each record of an archive file."""
    stream = _Stream(data)
    while True:
        head = stream.until(b"\r\n\r\n")
        if head is None:
            return
        if not head.strip():
            continue
        lines = head.strip(b"\r\n").decode("utf-8", "replace").split("\r\n")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        block = stream.take(int(fields.get("content-length", 0)))
        stream.until(b"\r\n\r\n")
        yield fields, block


def decode_chunked(data: bytes) -> bytes | None:
    """The body of a chunked message; None if the framing is broken or cut."""
    out, at = [], 0
    while True:
        end = data.find(b"\r\n", at)
        if end < 0:
            return None
        try:
            size = int(data[at:end].split(b";")[0], 16)
        except ValueError:
            return None
        at = end + 2
        if not size:
            return b"".join(out)
        if len(data) < at + size + 2 or data[at + size : at + size + 2] != b"\r\n":
            return None
        out.append(data[at : at + size])
        at += size + 2


def _number(text: str | None) -> int | None:
    return int(text) if text and text.lstrip("-").isdigit() else None


def _is_whole(f: dict[str, str]) -> bool:
    """Whether a record's fields say that it is a page by itself. Every segment has a number (WARC 1.1, 5.19)."""
    return f.get("warc-type") in ("response", "revisit") and not {"warc-segment-number", "warc-segment-origin-id", "warc-segment-total-length"} & f.keys()


def _record(f: dict[str, str], block: bytes) -> tuple:
    """A record as a row of ``PARSED``."""
    own = f.get("warc-record-id")
    return (
        f.get("warc-segment-origin-id", own), _number(f.get("warc-segment-number")) or 1, _number(f.get("warc-segment-total-length")),
        f.get("warc-type"), _number(f.get("warc-page-id")), f.get("warc-target-uri"),
        f.get("warc-payload-digest", "").removeprefix("sha1:") or None, _number(f.get("warc-payload-length")),
        _number(f.get("warc-refers-to", "").removeprefix("<urn:page:").removesuffix(">")), block,
    )


PAGE = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary, intact boolean"
_PAGE_NAMES = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload", "intact"]
_PAGE_TYPES = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.bool_()]


def _page(records: list[dict]) -> tuple:
    """The page of the records of one origin, as a row of ``PAGE``."""
    s = sorted(records, key=lambda x: x["segment"])
    head = s[0]
    block = b"".join(x["block"] for x in s)
    whole = [x["segment"] for x in s] == list(range(1, len(s) + 1)) and head["kind"] in ("response", "revisit")
    whole &= len(s) == 1 or s[-1]["total"] == len(block)
    if head["kind"] == "revisit":
        payload, length, digest = None, head["length"], head["digest"]
    else:
        http, _, body = block.partition(b"\r\n\r\n")
        payload = decode_chunked(body) if b"transfer-encoding: chunked" in http.lower() else body
        length, digest = len(payload or b""), sha1_base32(payload or b"")
        whole &= payload is not None and digest == head["digest"]
    return head["page_id"], head["url"], length, digest, head["kind"], head["refers_to"], payload, bool(whole)


def _batches(rows: Iterator[tuple], payload: int, names: list[str], types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    """Rows as batches of about 4 MB of the column number ``payload``."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[payload] or b"")
        if size > 4 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*held, strict=True), types, strict=True)], names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*held, strict=True), types, strict=True)], names)


def _archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")


def _records_in(batch: pa.RecordBatch) -> Iterator[tuple[dict[str, str], bytes]]:
    for content in batch.column("content"):
        yield from records_of(content.as_buffer().to_pybytes())


def parsed_records(spark: SparkSession, path: str, segments_only: bool = False) -> DataFrame:
    """The records of all archives under ``path``, as they stand; with ``segments_only`` without those that are whole pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = (_record(f, block) for f, block in _records_in(b) if not (segments_only and _is_whole(f)))
            yield from _batches(rows, -1, _NAMES, _TYPES)

    return _archives(spark, path).mapInArrow(run, PARSED)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload, intact: one
    row per response or revisit, segments put together. Only segments are shuffled."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = (_page([dict(zip(_NAMES, _record(f, block), strict=True))]) for f, block in _records_in(b) if _is_whole(f))
            yield from _batches(rows, -2, _PAGE_NAMES, _PAGE_TYPES)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield from _batches((_page(parts.as_py()) for parts in b.column("parts")), -2, _PAGE_NAMES, _PAGE_TYPES)

    fields = F.struct("segment", "total", "kind", "page_id", "url", "digest", "length", "refers_to", "block")
    groups = parsed_records(spark, path, segments_only=True).groupBy("origin").agg(F.collect_list(fields).alias("parts")).select("parts")
    return _archives(spark, path).mapInArrow(whole, PAGE).unionByName(groups.mapInArrow(joined, PAGE))


def round_trip(pages: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write archives of ``pages`` and read them back."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_warc(pages, path, **options)
    return read_warc(spark, path)
