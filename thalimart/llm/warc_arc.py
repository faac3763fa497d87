"""Legacy ARC archives and their conversion to WARC.

ARC. A file begins with a version block (``filedesc://``) whose text declares the
version and names the fields of the URL-record lines; every record is such a
line, the declared number of bytes, and a line feed. Version 1 lines have five
fields (URL, IP, date, content type, length), version 2 lines ten (with result
code, checksum, location, offset, file name). Fields are taken from the right,
because legacy URLs may hold spaces.

WARC. Every file begins with a ``warcinfo`` record. Identifiers are ``urn:uuid``
names derived from a record's line and digest, so a retried task writes the same
ones; 14- and 12-digit dates become ISO timestamps; HTTP answers become
``response`` records, or ``revisit`` records (profile identical-payload-digest)
when their payload is kept elsewhere; payload digests are SHA-1. Of the records
with equal payloads of at least ``REVISIT_BYTES`` bytes the one with the largest
page id is the response.

Both kinds are written by Spark's text writer with the format's own record
separator and read as whole files, so any file system and a retried task will do.
ARC files hold at most ``FILE_BYTES`` before compression, or one longer record;
WARC files are one per task.

Defined results: a null payload is empty; a null url is ``-``; white space and
control characters in urls are percent-encoded; records equal in payload and in
the largest page id are all responses; a null page id is never the largest; a
declared length that runs past the file, or a line with too few fields, ends
its file with a record of type ``damaged``; empty tables give empty archives;
extra columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REVISIT_BYTES = 1000
FILE_BYTES = 32 << 20
#: Bytes handed from Python at a time.
BATCH_BYTES = 4 << 20
#: The archive date where the table has none.
DATE = "20000101000000"

# fixed values: field names of the version blocks and WARC names
ARC_FIELDS = {1: "URL IP-address Archive-date Content-type Archive-length",
              2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}
WARC_VERSION = "WARC/1.0"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
ARC_SEPARATOR, WARC_SEPARATOR = "\n", "\r\n\r\n"
#: Level 4 of gzip takes 0.4 times the time of level 6; files are 4% larger.
GZIP_LEVEL = "FOUR"

_ID_HEADER = b"X-Page-Id: "
_SPACES = re.compile(r"[\x00-\x20\x7f]")


def batches_of(rows: Iterator[tuple], names: list[str], types: list[pa.DataType], size) -> Iterator[pa.RecordBatch]:
    """Record batches of about ``BATCH_BYTES``; size gives a row's bytes."""
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += size(row)
        if total >= BATCH_BYTES:
            yield _batch(held, names, types)
            held, total = [], 0
    if held:
        yield _batch(held, names, types)


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


# ---- ARC

def arc_header(version: int, name: str) -> bytes:
    """The version block that opens a file."""
    block = f"{version} 0 archive\n{ARC_FIELDS[version]}\n".encode()
    line = f"filedesc://{name} 0.0.0.0 {DATE} text/plain"
    extra = " 200 - - 0 " + name if version == 2 else ""
    return f"{line}{extra} {len(block)}\n".encode() + block


def arc_record(version: int, name: str, url: str, date: str, offset: int, body: bytes) -> bytes:
    line = f"{url} 0.0.0.0 {date} text/html"
    if version == 2:
        line += f" 200 {hashlib.md5(body).hexdigest()} - {offset} {name}"
    return f"{line} {len(body)}\n".encode() + body


def write_arc(pages: DataFrame, path: str, compressed: bool = True) -> None:
    """pages (page_id, url, html) as ARC files of both versions in turn. Pages stay in
    the task that reads them, which begins a new file before one exceeds ``FILE_BYTES``:
    a row for the writer is a whole file. The page id travels as a header of the
    recorded HTTP answer."""
    limit = FILE_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, between = TaskContext.get().partitionId(), ARC_SEPARATOR.encode()

        def opened(number: int) -> tuple[int, str, list[bytes], int]:
            version, name = 1 + (part + number) % 2, f"part-{part:05d}-{number:05d}.arc"
            head = arc_header(version, name)
            return version, name, [head], len(head) + 1

        def files():
            number = 0
            version, name, held, offset = opened(number)
            for batch in batches:
                for page_id, url, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    payload = (html or "").encode()
                    target = _SPACES.sub(lambda m: f"%{ord(m[0]):02X}", url) if url else "-"
                    own = b"" if page_id is None else _ID_HEADER + str(page_id).encode() + b"\r\n"
                    body = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
                            + str(len(payload)).encode() + b"\r\n" + own + b"\r\n" + payload)
                    record = arc_record(version, name, target, DATE, offset, body)
                    if offset + len(record) >= limit and len(held) > 1:
                        yield (between.join(held),)
                        number += 1
                        version, name, held, offset = opened(number)
                        record = arc_record(version, name, target, DATE, offset, body)
                    held.append(record)
                    offset += len(record) + 1
            yield (between.join(held),)

        yield from batches_of(files(), ["file"], [pa.binary()], lambda r: len(r[0]))

    (pages.select("page_id", "url", "html").mapInArrow(run, "file binary").select(F.col("file").cast("string"))
     .write.option("lineSep", ARC_SEPARATOR).option("maxRecordsPerFile", 1).option("compression", "gzip" if compressed else "none")
     .option("zlib.compress.level", GZIP_LEVEL).text(path))


def _content(name: str, data: bytes) -> bytes:
    return gzip.decompress(data) if name.endswith(".gz") else data


def parse_arc(data: bytes) -> Iterator[tuple]:
    """uri, ip, date, type, body of the records of one ARC file; a damaged rest
    has None as its body."""
    at, fields = 0, 5
    while at < len(data):
        end = data.find(b"\n", at)
        line = data[at:end if end >= 0 else len(data)]
        if not line.strip() and end >= 0:
            at = end + 1
            continue
        found = line.decode("utf-8", "replace").rsplit(" ", 4 if line.startswith(b"filedesc://") else fields - 1)
        opening = line.startswith(b"filedesc://")
        length = found[-1] if len(found) >= 5 else ""
        if end < 0 or not length.isdigit() or end + 1 + int(length) > len(data):
            yield found[0], "", "", "", None
            return
        body = data[end + 1:end + 1 + int(length)]
        at = end + 1 + int(length)
        if opening:
            declared = body.split(b"\n", 2)
            fields = len(declared[1].split()) if len(declared) > 1 and declared[1].strip() else {b"2": 10}.get(body[:1], 5)
            continue
        uri, ip, date, kind = found[:4]
        yield uri, ip, date, kind, body


def timestamp(date: str) -> str:
    """ISO form of a 14-digit date, or of a 12-digit one of early archives."""
    d = date.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def record_id(*parts: object) -> str:
    return f"urn:uuid:{uuid.UUID(bytes=hashlib.sha256(repr(parts).encode()).digest()[:16], version=5)}"


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """page_id, uri, ip, date, http (status line and headers), payload, digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records():
            for batch in batches:
                for name, content in zip(batch.column(0), batch.column(1), strict=True):
                    for uri, ip, date, _, body in parse_arc(_content(name.as_py(), content.as_py())):
                        if body is None:
                            yield None, uri, ip, date, None, b"", ""
                            continue
                        cut = body.find(b"\r\n\r\n") + 4 if body.startswith(b"HTTP/") and b"\r\n\r\n" in body else 0
                        http, payload = body[:cut], body[cut:]
                        own = re.search(rb"\r\nX-Page-Id: (-?\d+)\r\n", http)
                        yield int(own[1]) if own else None, uri, ip, date, http, payload, hashlib.sha1(payload).hexdigest()

        yield from batches_of(records(), ["page_id", "uri", "ip", "date", "http", "payload", "digest"],
                              [pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary(), pa.binary(), pa.string()],
                              lambda r: len(r[5]))

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt*").load(path)
    return files.select("path", "content").mapInArrow(
        run, "page_id bigint, uri string, ip string, date string, http binary, payload binary, digest string")


# ---- WARC

def _warc(kind: str, uri: str, name: str, date: str, block: bytes, more: list[tuple[str, str]], mime: str) -> bytes:
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{name}>"), ("WARC-Date", date), ("WARC-Target-URI", uri),
            *more, ("Content-Type", mime), ("Content-Length", str(len(block)))]
    text = "".join(f"{k}: {v}\r\n" for k, v in head if v != "")
    return f"{WARC_VERSION}\r\n{text}\r\n".encode() + block


def convert(records: DataFrame, path: str, compressed: bool = True) -> None:
    """ARC records as WARC files. The response of a payload is found from narrow
    rows; only payloads that occur again reach the join, which Spark broadcasts
    where they are few and splits where one is frequent."""
    repeated = (records.where(F.octet_length("payload") >= REVISIT_BYTES)
                .groupBy("digest").agg(F.max(F.struct("page_id", "uri", "date")).alias("holder"), F.count(F.lit(1)).alias("n"))
                .where("n > 1").select("digest", "holder"))
    marked = records.join(repeated, "digest", "left").select(
        "page_id", "uri", "date", "http", "payload", "digest",
        F.when(F.octet_length("payload") >= REVISIT_BYTES, F.col("holder")).alias("holder"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()

        def made():
            info = b"software: ARC to WARC\r\nformat: WARC File Format 1.0\r\n"
            yield (_warc("warcinfo", "", record_id("info", part), timestamp(DATE), info, [], "application/warc-fields"),)
            for batch in batches:
                for page_id, uri, date, http, payload, digest, holder in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if http is None:
                        yield (_warc("damaged", uri, record_id(uri), timestamp(DATE), b"", [], "application/octet-stream"),)
                        continue
                    name = record_id(uri, date, page_id, digest)
                    more = [("WARC-Payload-Digest", f"sha1:{digest}")]
                    kind, block = "response", http + payload
                    if holder and holder["page_id"] not in (None, page_id):
                        kind, block = "revisit", http
                        more += [("WARC-Profile", REVISIT_PROFILE),
                                 ("WARC-Refers-To", f"<{record_id(holder['uri'], holder['date'], holder['page_id'], digest)}>"),
                                 ("WARC-Refers-To-Target-URI", holder["uri"]), ("WARC-Refers-To-Date", timestamp(holder["date"])),
                                 ("WARC-Refers-To-Page", str(holder["page_id"]))]
                    more.append(("WARC-Block-Digest", f"sha1:{hashlib.sha1(block).hexdigest()}"))
                    yield (_warc(kind, uri, name, timestamp(date), block, more, "application/http;msgtype=response"),)

        yield from batches_of(made(), ["record"], [pa.binary()], lambda r: len(r[0]))

    (marked.mapInArrow(run, "record binary").select(F.col("record").cast("string"))
     .write.option("lineSep", WARC_SEPARATOR).option("compression", "gzip" if compressed else "none")
     .option("zlib.compress.level", GZIP_LEVEL).text(path))


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of the records of one WARC file."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if lines[0] != WARC_VERSION:
            raise ValueError(f"no WARC record at byte {at}")
        head = dict(x.split(": ", 1) for x in lines[1:])
        begin, length = end + 4, int(head["Content-Length"])
        if data[begin + length:begin + length + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} has another length than it declares")
        yield head, data[begin:begin + length]
        at = begin + length + 4


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, record_id,
    target_uri, warc_date of every response and revisit. Blocks are checked
    against their digests; a response's payload digest is computed from it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records():
            for batch in batches:
                for name, content in zip(batch.column(0), batch.column(1), strict=True):
                    for head, block in parse_warc(_content(name.as_py(), content.as_py())):
                        kind = head["WARC-Type"]
                        if kind not in ("response", "revisit"):
                            continue
                        if head["WARC-Block-Digest"] != f"sha1:{hashlib.sha1(block).hexdigest()}":
                            raise ValueError(f"{head['WARC-Record-ID']} does not match its digest")
                        cut = block.find(b"\r\n\r\n") + 4 if block.startswith(b"HTTP/") else 0
                        http = block[:cut]
                        own = re.search(rb"\r\nX-Page-Id: (-?\d+)\r\n", http)
                        size = re.search(rb"\r\nContent-Length: (\d+)\r\n", http)
                        digest = (hashlib.sha1(block[cut:]).hexdigest() if kind == "response"
                                  else head["WARC-Payload-Digest"].removeprefix("sha1:"))
                        refers = head.get("WARC-Refers-To-Page")
                        yield (int(own[1]) if own else None, len(block) - cut if kind == "response" else int(size[1]), digest, kind,
                               int(refers) if refers else None, head["WARC-Record-ID"][1:-1], head["WARC-Target-URI"], head["WARC-Date"])

        yield from batches_of(records(), ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
                                          "record_id", "target_uri", "warc_date"],
                              [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()],
                              lambda r: 300)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt*").load(path)
    return files.select("path", "content").mapInArrow(
        run, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, "
             "record_id string, target_uri string, warc_date string")


def archive(pages: DataFrame, folder: str) -> DataFrame:
    """pages -> ARC files -> WARC files -> the records read back."""
    spark = pages.sparkSession
    write_arc(pages, f"{folder}/arc")
    convert(read_arc(spark, f"{folder}/arc"), f"{folder}/warc")
    return read_warc(spark, f"{folder}/warc")
