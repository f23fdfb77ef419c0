"""WARC archives written and read by Spark: segments, revisits and chunked transfer framing.

Each row becomes a response or revisit record. A block longer than the segment size is written
as a first segment and continuation records. Reading groups the segments by the record that they
continue, checks order and total length, and takes the chunked framing off the payload.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtide.llm.common import spread
from adtide.sources.files import scratch_path, stage

SEGMENT = 32 * 1024
CHUNK = 8 * 1024
REVISIT_FROM = 100
RECORDS_PER_FILE = 5_000
VERSION = b"WARC/1.1"
DATE = b"2020-01-01T00:00:00Z"  # fixed, so that archives of equal tables are equal
PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    """The payload in chunked transfer framing."""
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(framed: bytes) -> bytes:
    """The payload of chunked framing; a broken or unfinished frame is an error."""
    parts, at = [], 0
    while True:
        end = framed.index(b"\r\n", at)
        size = int(framed[at:end].split(b";", 1)[0], 16)
        at = end + 2
        if not size:
            return b"".join(parts)
        if framed[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk without its end")
        parts.append(framed[at : at + size])
        at += size + 2


def record(headers: list[tuple[bytes, bytes]], block: bytes) -> bytes:
    """A record but for the last line end, which the line writer adds."""
    lines = b"".join(b"%s: %s\r\n" % x for x in [*headers, (b"Content-Length", b"%d" % len(block))])
    return b"%s\r\n%s\r\n%s\r\n" % (VERSION, lines, block)


def _one_line(value: str | None) -> bytes:
    return " ".join((value or "").split()).encode()


def _records(segment: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                payload = (row["html"] or "").encode()
                name = b"<urn:page:%d>" % row["row"]
                own = [(b"WARC-Date", DATE), (b"WARC-Target-URI", _one_line(row["url"]))]
                if row["page_id"] is not None:
                    own.append((b"WARC-Page-Id", b"%d" % row["page_id"]))
                own.append((b"WARC-Payload-Digest", b"sha256:" + row["digest"].encode()))
                own.append((b"WARC-Payload-Length", b"%d" % len(payload)))
                head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
                kind, block = b"response", head + chunked(payload)
                if row["revisit"]:
                    kind, block = b"revisit", head
                    own.append((b"WARC-Profile", PROFILE))
                    own.append((b"WARC-Refers-To-Page", b"%d" % row["refers_to"]))
                parts = [block[i : i + segment] for i in range(0, len(block), segment)]
                for k, part in enumerate(parts, 1):
                    if k == 1:
                        h = [(b"WARC-Type", kind), (b"WARC-Record-ID", name), *own]
                    else:
                        h = [
                            (b"WARC-Type", b"continuation"), (b"WARC-Record-ID", name[:-1] + b":%d>" % k),
                            (b"WARC-Date", DATE), (b"WARC-Segment-Origin-ID", name),
                        ]
                    if len(parts) > 1:
                        h.append((b"WARC-Segment-Number", b"%d" % k))
                        if k == len(parts):
                            h.append((b"WARC-Segment-Total-Length", b"%d" % len(block)))
                    out.append(record(h, part))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    return run


def write_archives(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html",
    segment: int = SEGMENT,
) -> None:
    """Write a record per row to gzip-compressed WARC files under ``path``.

    Of rows with equal payloads of at least ``REVISIT_FROM`` bytes the one with the smallest id is
    the response and the others refer to it; a row without an id, or that repeats the smallest one,
    is a response too. Null bodies are empty. The smallest id per payload is found by an aggregate
    and an equi-join, both safe for a payload that holds a large share of the rows.
    """
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(body_col).cast("string"), F.lit("")).alias("html"),
    ).withColumn("digest", F.sha2("html", 256))
    first = rows.where(F.octet_length("html") >= REVISIT_FROM).groupBy("digest").agg(
        F.min("page_id").alias("refers_to"), F.count("*").alias("_n")
    )
    first = stage(first.where("_n > 1").drop("_n"), "first_pages")
    marked = rows.join(first, "digest", "left").select(
        F.monotonically_increasing_id().alias("row"), "page_id", "url", "html", "digest", "refers_to",
        F.coalesce(F.col("page_id") > F.col("refers_to"), F.lit(False)).alias("revisit"),
    )
    records = marked.mapInArrow(_records(segment), "record binary")
    # a record's last line end is the writer's line separator
    (
        records.select(F.col("record").cast("string").alias("value"))
        .write.option("lineSep", "\r\n").option("maxRecordsPerFile", RECORDS_PER_FILE)
        .mode("overwrite").text(path, compression="gzip")
    )


def parse_records(data: bytes) -> Iterator[tuple[dict[bytes, bytes], bytes]]:
    """Headers and block of each record of a file, by its stated lengths."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].split(b"\r\n")
        if not lines[0].startswith(b"WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = {k.lower(): v.strip() for k, _, v in (x.partition(b":") for x in lines[1:])}
        start = end + 4
        at = start + int(headers[b"content-length"]) + 4
        if data[at - 4 : at] != b"\r\n\r\n":
            raise ValueError(f"record before byte {at} has another length than stated")
        yield headers, data[start : at - 4]


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["origin", "segment", "total", "kind", "page_id", "url", "digest", "length", "refers_to", "block"]
    kinds = [
        pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(),
        pa.int64(), pa.binary(),
    ]

    def number(h: dict, key: bytes) -> int | None:
        return int(h[key]) if key in h else None

    for batch in batches:
        for content in batch.column(0):
            out = []
            for h, block in parse_records(gzip.decompress(content.as_py())):
                own = h[b"warc-record-id"]
                out.append((
                    h.get(b"warc-segment-origin-id", own).decode(), number(h, b"warc-segment-number") or 1,
                    number(h, b"warc-segment-total-length"), h[b"warc-type"].decode(), number(h, b"warc-page-id"),
                    h.get(b"warc-target-uri", b"").decode(), h.get(b"warc-payload-digest", b":").split(b":", 1)[1].decode(),
                    number(h, b"warc-payload-length"), number(h, b"warc-refers-to-page"), block,
                ))
            columns = list(zip(*out, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
            )


def _whole(origin: str, parts: list[dict]) -> dict:
    """One record from its segments in order; missing parts and wrong lengths are errors."""
    if [p["segment"] for p in parts] != list(range(1, len(parts) + 1)):
        raise ValueError(f"segments of {origin} are not complete")
    first, block = parts[0], b"".join(p["block"] for p in parts)
    if len(parts) > 1 and parts[-1]["total"] != len(block):
        raise ValueError(f"{origin} has {len(block)} bytes, stated {parts[-1]['total']}")
    head, _, body = block.partition(b"\r\n\r\n")
    payload = None
    if first["kind"] == "response":
        payload = unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body
        if hashlib.sha256(payload).hexdigest() != first["digest"]:
            raise ValueError(f"the payload of {origin} has another digest than stated")
    length = first["length"] if payload is None else len(payload)
    return {
        "page_id": first["page_id"], "url": first["url"], "payload_bytes": length, "payload_digest": first["digest"],
        "record_type": first["kind"], "refers_to": first["refers_to"], "payload": payload,
    }


RECORDS = (
    "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, "
    "refers_to bigint, payload binary"
)


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
    ])
    origin, parts = None, []
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if row["origin"] != origin:
                if parts:
                    out.append(_whole(origin, parts))
                origin, parts = row["origin"], []
            parts.append(row)
        yield pa.RecordBatch.from_pylist(out, schema)
    if parts:
        yield pa.RecordBatch.from_pylist([_whole(origin, parts)], schema)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records under ``path``, each with its whole payload (null for a revisit).

    Segments meet by a shuffle on the record that they continue and are read in order, one record
    at a time.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    segments = files.mapInArrow(
        _segments,
        "origin string, segment bigint, total bigint, kind string, page_id bigint, url string, digest string, "
        "length bigint, refers_to bigint, block binary",
    )
    ordered = spread(segments, "origin").sortWithinPartitions("origin", "segment")
    return ordered.mapInArrow(_assemble, RECORDS)


def archive_round_trip(pages: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Write ``pages`` to archives in the shared scratch folder and read them back."""
    path = scratch_path(pages.sparkSession, "warc")
    write_archives(pages, path, segment=segment)
    return read_archives(pages.sparkSession, path)
