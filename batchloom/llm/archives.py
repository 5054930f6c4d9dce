"""Legacy web archives: ARC files are written, parsed and converted to WARC, and WARC files are read back.

An ARC file starts with a version block, whose version (1 or 2) decides the fields of all header lines that follow: five in
version 1, ten in version 2. A header line ends with the declared length of the content, which is all that delimits it, so
content may hold anything. The URL is whatever stands left of the last fields, as old crawlers did not escape spaces.

Conversion gives every ARC record a WARC identifier (a UUID from URL, date, digest, file and place, the same in every run),
its date as an ISO timestamp, a type and a SHA-256 payload digest. HTTP records become ``response``; among records with equal
payloads of at least ``least`` bytes the one with the smallest page id stays a response and the others become ``revisit``
records that refer to it and keep only the HTTP header. Records without an HTTP header become ``resource``.

Files are written by Spark's text writer, a record a row with the format's own separator, gzipped, and read whole, one
record in memory at a time; they can be on any file system that Spark knows, and each must be below 2 GB. Which records
revisit which is decided on stored (digest, page id) rows alone. Archives are never shuffled: the files are converted in
groups whose lists of revisits are of a bounded size, worked out from their lengths, and each group's lists are broadcast to the
tasks that read its files. Every archive is parsed twice, to decide and to convert, and every WARC file once.

Null html is an empty payload, a null URL is written as ``-``, white space and control characters in URLs are percent-coded.
A null page id stays null and counts as the largest; of repeated rows one is the response. An empty table gives no rows,
other columns are not read.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchloom.llm.texts import binaries
from batchloom.sources.files import scratch_path, write_scratch

#: Field names of header lines by version, fixed values of the format.
ARC_FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"),
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SPEED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 0}
META = "path string, place bigint, record_id string, page_id bigint, payload_bytes bigint, payload_digest string, kind string"
READ = "record_id string, record_type string, page_id bigint, payload_bytes bigint, payload_digest string, refers_to_id string"


class ArcRecord(NamedTuple):
    place: int
    url: str
    date: str
    content_type: str
    content: bytes


def arc_header(version: int, url: str, date: str, content_type: str, length: int) -> bytes:
    middle = () if version == 1 else ("200", "-", "-", "0", "-")
    return " ".join((url, "0.0.0.0", date, content_type, *middle, str(length))).encode() + b"\n"


def version_block(version: int, date: str) -> bytes:
    content = f"{version} 0 batchloom\n{' '.join(ARC_FIELDS[version])}\n".encode()
    return arc_header(1, "filedesc://batchloom.arc", date, "text/plain", len(content)) + content


def parse_arc(stream) -> Iterator[ArcRecord]:
    """The records of an open ARC file after its version block."""
    fields, place = ARC_FIELDS[1], 0
    while True:
        line = stream.readline()
        if not line:
            return
        if line in (b"\n", b"\r\n"):
            continue
        first = line.startswith(b"filedesc://")
        own = line.decode("utf-8", "replace").rstrip("\r\n").rsplit(" ", 4 if first else len(fields) - 1)
        if len(own) != (5 if first else len(fields)) or not own[-1].isdigit():
            raise ValueError(f"record {place}: not a header line: {line[:200]!r}")
        content = stream.read(int(own[-1]))
        if len(content) != int(own[-1]):
            raise ValueError(f"record {place}: {len(content)} bytes of {own[-1]}")
        if first:
            fields = ARC_FIELDS[int(content.split(b" ", 1)[0])]
            continue
        yield ArcRecord(place, own[0], own[2], own[3], content)
        place += 1


def http_parts(content: bytes) -> tuple[bytes, bytes] | None:
    """Header (with its empty line) and payload of an HTTP response."""
    if not content.startswith(b"HTTP/"):
        return None
    end = content.find(b"\r\n\r\n")
    return (content[: end + 4], content[end + 4 :]) if end >= 0 else (content, b"")


def _header(block: bytes, name: bytes) -> int | None:
    found = re.search(rb"\r\n" + name + rb": *(-?\d+)\r\n", block, re.IGNORECASE)
    return int(found[1]) if found else None


def file_name(path: str) -> str:
    """The part of a file's name that stays the same when the file is written again."""
    name = path.rsplit("/", 1)[-1]
    found = re.match(r"part-\d+", name)
    return found[0] if found else name


def record_id(file: str, record: ArcRecord, digest: str) -> str:
    return str(uuid.uuid5(uuid.NAMESPACE_URL, f"{record.url} {record.date} {digest} {file} {record.place}"))


def iso_date(date: str) -> str:
    d = date.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def warc_record(kind: str, identifier: str, date: str, block: bytes, headers: dict[str, str]) -> bytes:
    """A WARC record without the two line ends after its block."""
    lines = {"WARC-Type": kind, "WARC-Record-ID": f"<urn:uuid:{identifier}>", "WARC-Date": date, **headers, "Content-Length": str(len(block))}
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines.items()).encode() + b"\r\n" + block


def converted(file: str, record: ArcRecord, refers_to: str | None) -> bytes:
    parts = http_parts(record.content)
    payload = parts[1] if parts else record.content
    digest = hashlib.sha256(payload).hexdigest()
    headers = {"WARC-Target-URI": record.url, "WARC-Payload-Digest": f"sha256:{digest}"}
    kind, block = "response" if parts else "resource", record.content
    if parts:
        headers["Content-Type"] = "application/http; msgtype=response"
    else:
        headers["Content-Type"] = record.content_type
    if refers_to:
        kind, block = "revisit", parts[0] if parts else b""
        headers |= {"WARC-Refers-To": f"<urn:uuid:{refers_to}>", "WARC-Profile": REVISIT_PROFILE}
    return warc_record(kind, record_id(file, record, digest), iso_date(record.date), block, headers)


def parse_warc(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of an open WARC file."""
    while True:
        line = stream.readline()
        if not line:
            return
        if line == b"\r\n":
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:100]!r}")
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode("utf-8").partition(":")
            headers[name.lower()] = value.strip()
        size = int(headers["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError(f"{len(block)} bytes of {size}")
        yield headers, block


def _opened(content: bytes):
    return io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content)), 1 << 16) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)


def _files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def file_groups(paths: list[str], revisits: dict[str, int], limit: int) -> list[list[str]]:
    """Paths in groups, none of which has more than ``limit`` revisits in all, except a file that has more by itself."""
    groups: list[list[str]] = [[]]
    total = 0
    for path in sorted(paths):
        own = revisits.get(path, 0)
        if groups[-1] and total + own > limit:
            groups.append([])
            total = 0
        groups[-1].append(path)
        total += own
    return groups


def _batches(rows: Iterator[tuple], names: list[str], types: list[pa.DataType], limit: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 200 + (len(row[0]) if isinstance(row[0], bytes) else 0)
        if size > limit:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names)


def write_arc(pages: DataFrame, path: str, date: str = "20240101000000") -> None:
    """Write (page_id, url, html) rows as ARC files, version 1 and 2 in turn."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes]]:
        version = 1 + TaskContext.get().partitionId() % 2
        yield (version_block(version, date),)
        for batch in batches:
            urls, html = batch.column("url").to_pylist(), binaries(batch.column("html"))
            for page, url, payload in zip(batch.column("page_id").to_pylist(), urls, html, strict=True):
                own = b"" if page is None else b"X-Page-Id: %d\r\n" % page
                head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n%sContent-Length: %d\r\n\r\n" % (own, len(payload))
                where = quote(url, safe="!#$%&'()*+,/:;=?@[]~|<>\\\"^`{}") if url else "-"
                yield (arc_header(version, where, date, "text/html", len(head) + len(payload)) + head + payload,)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(rows(batches), ["value"], [pa.binary()])

    source = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string"))
    source.mapInArrow(run, "value binary").select(F.col("value").cast("string")).write.options(lineSep="\n", **SPEED).text(path)


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """What the conversion decides on: one row per ARC record, without its content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for name, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                    file = file_name(name)
                    for r in parse_arc(_opened(content.as_buffer().to_pybytes())):
                        parts = http_parts(r.content)
                        payload = parts[1] if parts else r.content
                        digest = hashlib.sha256(payload).hexdigest()
                        page = _header(parts[0], b"X-Page-Id") if parts else None
                        yield name, r.place, record_id(file, r, digest), page, len(payload), digest, "http" if parts else "other"

        return _batches(rows(), ["path", "place", "record_id", "page_id", "payload_bytes", "payload_digest", "kind"], [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()])

    return _files(spark, path).mapInArrow(run, META)


def convert(spark: SparkSession, arc: str, warc: str, least: int = 100, list_limit: int = 500_000) -> None:
    """Convert the ARC files of a folder to WARC files of another, later equal payloads as revisits.

    At most ``list_limit`` revisits, about 80 bytes each, are broadcast at once; files that have more together are converted in
    several jobs, and a file that has more by itself meets its list in a shuffled join.
    """
    found = write_scratch(read_arc(spark, arc).where((F.col("payload_bytes") >= least) & (F.col("kind") == "http")), "arc-records")
    rank = F.struct(F.col("page_id").isNull().alias("unknown"), "page_id", "record_id")
    first = found.groupBy("payload_digest").agg(F.min(rank).alias("first"), F.count("*").alias("n")).where("n > 1")
    again = found.join(first, "payload_digest").where(F.col("record_id") != F.col("first.record_id"))
    listed = write_scratch(again.groupBy("path").agg(F.collect_list(F.struct("place", F.col("first.record_id").alias("refers_to"))).alias("revisits")), "arc-revisits")
    sizes = {r["path"]: r["n"] for r in listed.select("path", F.size("revisits").alias("n")).collect()}
    names = [r["path"] for r in _files(spark, arc).select("path").collect()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            info = b"software: batchloom\r\nformat: WARC file version 1.1\r\n"
            for batch in batches:
                for name, content, revisits in zip(batch.column("path").to_pylist(), batch.column("content"), batch.column("revisits").to_pylist(), strict=True):
                    file = file_name(name)
                    refers = {r["place"]: r["refers_to"] for r in revisits or ()}
                    own = str(uuid.uuid5(uuid.NAMESPACE_URL, f"warcinfo {file}"))
                    yield (warc_record("warcinfo", own, "2024-01-01T00:00:00Z", info, {"Content-Type": "application/warc-fields"}),)
                    for r in parse_arc(_opened(content.as_buffer().to_pybytes())):
                        yield (converted(file, r, refers.get(r.place)),)

        return _batches(rows(), ["value"], [pa.binary()])

    for i, group in enumerate(file_groups(names, sizes, list_limit)):
        own = [p for p in group if p in sizes]
        files = _files(spark, group or arc)
        if sum(sizes[p] for p in own) <= list_limit:
            files = files.join(F.broadcast(listed.where(F.col("path").isin(own))), "path", "left") if own else files.withColumn("revisits", F.lit(None))
        else:
            files = files.join(listed.where(F.col("path").isin(own)).hint("shuffle_hash"), "path", "left")
        written = files.mapInArrow(run, "value binary").select(F.col("value").cast("string"))
        written.write.mode("append" if i else "error").options(lineSep="\r\n\r\n", **SPEED).text(warc)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per record other than warcinfo: ids, type, page id, size and digest of the full payload, what it refers to.

    Sizes and digests of responses are those of the payload that was read; one that differs from its header is an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for content in batch.column("content"):
                    for headers, block in parse_warc(_opened(content.as_buffer().to_pybytes())):
                        kind = headers["warc-type"]
                        if kind == "warcinfo":
                            continue
                        parts = http_parts(block)
                        digest = headers["warc-payload-digest"].removeprefix("sha256:")
                        size = _header(parts[0], b"Content-Length") if kind == "revisit" and parts else len(parts[1] if parts else block)
                        if kind != "revisit" and hashlib.sha256(parts[1] if parts else block).hexdigest() != digest:
                            raise ValueError(f"{headers['warc-record-id']}: the payload has another digest")
                        refers = headers.get("warc-refers-to")
                        page = _header(parts[0], b"X-Page-Id") if parts else None
                        yield headers["warc-record-id"][10:-1], kind, page, size, digest, refers[10:-1] if refers else None

        return _batches(rows(), ["record_id", "record_type", "page_id", "payload_bytes", "payload_digest", "refers_to_id"], [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()])

    return _files(spark, path).mapInArrow(run, READ)


def archive_pages(pages: DataFrame, least: int = 100) -> DataFrame:
    """Pages as ARC, converted to WARC and read back: page_id, payload_bytes, payload_digest, record_type, refers_to, record_id."""
    spark = pages.sparkSession
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arc(pages, arc)
    convert(spark, arc, warc, least)
    records = write_scratch(read_warc(spark, warc), "warc-records")
    targets = records.where("record_type = 'response'").select(F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"))
    again = records.where("refers_to_id is not null").join(targets, "refers_to_id")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id"]
    plain = records.where("refers_to_id is null").withColumn("refers_to", F.lit(None).cast("bigint"))
    return plain.select(columns).unionByName(again.select(columns))
