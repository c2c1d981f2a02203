"""WARC archives: write with an index, then read selected records by coalesced byte ranges.

Writing: each task writes its rows as WARC 1.1 records, one gzip member per record, to files of its own
in the archive folder (any store pyarrow knows), and returns an index row per record: file,
offset, length, URL, digest. The index is written as a table before anything is read. A retried task
writes files of a new name, and the index only holds those of the attempt that counted.

Reading: index rows are dealt out by file and stretch of ``STRETCH`` bytes, about ``TASK_BYTES`` of archive
a task (a stated number of partitions: index rows are too narrow to tell Spark the work), sorted by offset; neighbouring records no more than ``GAP`` bytes apart are read as one range of at most
``RANGE`` bytes (a longer record alone).
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rrspark.llm.common import arrow_map, parallelism, scalar_int, stage
from rrspark.session import arrow_filesystem, scratch_path

MIN_REVISIT = 100
FILE_BYTES = 1 << 30
STRETCH, TASK_BYTES = 8 << 20, 64 << 20
GAP, RANGE = 64 << 10, 8 << 20
DATE = "2024-01-01T00:00:00Z"
_CRLF = b"\r\n"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n\r\n"

INDEX = ("page_id long, url string, payload_digest string, payload_bytes long, record_type string, refers_to long, "
         "file string, offset long, length long")


def _target(url: str | None) -> str | None:
    """A header value: blanks and control characters percent-encoded."""
    return None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record: a response with the payload, or a revisit (identical payload digest) without."""
    revisit = refers_to is not None
    block = b"HTTP/1.1 200 OK\r\n\r\n" if revisit else _HTTP + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if (uri := _target(url)) is not None:
        head.append(f"WARC-Target-URI: {uri}")
    head += [f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Payload-Length: {len(payload)}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + _CRLF + _CRLF


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one record; raises where the record is broken."""
    head, _, rest = raw.partition(_CRLF + _CRLF)
    lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    size = int(fields["Content-Length"])
    if lines[0] != "WARC/1.1" or rest[size:] != _CRLF + _CRLF:
        raise ValueError("broken WARC record")
    return fields, rest[:size].partition(_CRLF + _CRLF)[2]


def _page(urn: str) -> int | None:
    number = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def with_revisits(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, payload_digest, refers_to``. The digests are compared on narrow rows, one
    smallest page per digest; pages join only with the list of revisits, by their own id."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("html"))
    keys = rows.where(F.octet_length("html") >= MIN_REVISIT).select("page_id", F.sha2("html", 256).alias("digest"))
    keys = stage(keys, "warc-digests")
    least = keys.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n")
    again = keys.join(least, "digest").where("page_id > refers_to").select("page_id", "digest", "refers_to").distinct()
    return rows.withColumn("payload_digest", F.sha2("html", 256)).join(
        again.withColumnRenamed("digest", "payload_digest"), ["page_id", "payload_digest"], "left").select(
        "page_id", "url", "html", "payload_digest", "refers_to")


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``pages`` (page_id, url, html) to WARC files in ``folder``; returns the index table.

    Payload: the html in UTF-8, null as empty. Of equal payloads of MIN_REVISIT bytes or more the page
    with the smallest id is the response, the others revisit it; repeated rows of that page are
    responses too, and a null page_id never revisits.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = arrow_filesystem(folder)
        store.create_dir(base, recursive=True)
        out, name, offset, part = None, "", 0, TaskContext.get().partitionId()
        for b in batches:
            made = []
            for page, url, html, digest, refers in zip(*(c.to_pylist() for c in b.columns)):
                if out is None or offset >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    name, offset = f"part-{part:05d}-{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                data = gzip.compress(record(page, url, html, digest, refers), 1, mtime=0)
                out.write(data)
                made.append((page, url, digest, len(html), "response" if refers is None else "revisit", refers,
                             name, offset, len(data)))
                offset += len(data)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*made), fields.types)] if made else
                [pa.array([], t) for t in fields.types], schema=fields)
        if out is not None:
            out.close()

    fields = pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
        ("record_type", pa.string()), ("refers_to", pa.int64()), ("file", pa.string()), ("offset", pa.int64()),
        ("length", pa.int64())])
    return stage(arrow_map(with_revisits(pages), run, INDEX), "warc-index")


def ranges(spans: list[tuple[int, int]], gap: int = GAP, most: int = RANGE) -> list[tuple[int, int]]:
    """Coalesce sorted (offset, length) spans into read ranges (start, end)."""
    out: list[tuple[int, int]] = []
    for offset, length in spans:
        if out and offset - out[-1][1] <= gap and offset + length - out[-1][0] <= most:
            out[-1] = (out[-1][0], max(out[-1][1], offset + length))
        else:
            out.append((offset, offset + length))
    return out


def read(index: DataFrame, folder: str) -> DataFrame:
    """The records that ``index`` rows name: ``page_id, url, record_type, refers_to, payload_bytes,
    payload_digest, payload``. The digest of a response is taken from the payload read, and one that
    differs from its header raises; a revisit has its header's digest and length and no payload."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = arrow_filesystem(folder)
        name, source = None, None
        for b in batches:
            rows = list(zip(*(c.to_pylist() for c in b.columns)))
            at = 0
            while at < len(rows):
                same = next((i for i in range(at, len(rows)) if rows[i][0] != rows[at][0]), len(rows))
                if rows[at][0] != name:
                    if source is not None:
                        source.close()
                    name = rows[at][0]
                    source = store.open_input_file(f"{base}/{name}")
                spans = [(o, n) for _, o, n in rows[at:same]]
                i = 0
                for lo, hi in ranges(spans):
                    data = source.read_at(hi - lo, lo)
                    out = []
                    while i < len(spans) and spans[i][0] + spans[i][1] <= hi:
                        o, n = spans[i]
                        out.append(_read_one(zlib.decompress(data[o - lo:o - lo + n], 31)))
                        i += 1
                    yield pa.RecordBatch.from_pylist(out, schema=fields)
                at = same
        if source is not None:
            source.close()

    fields = pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])
    stretch = F.floor(F.col("offset") / STRETCH)
    tasks = max(parallelism(index.sparkSession), scalar_int(index.agg(F.sum("length")).first()[0]) // TASK_BYTES + 1)
    chosen = index.select("file", "offset", "length").repartition(tasks, "file", stretch).sortWithinPartitions("file", "offset")
    return arrow_map(chosen, run, "page_id long, url string, record_type string, refers_to long, payload_bytes long, "
                                  "payload_digest string, payload binary")


def _read_one(raw: bytes) -> dict:
    fields, payload = parse(raw)
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} doesn't have its digest")
    return {
        "page_id": _page(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "record_type": kind,
        "refers_to": _page(fields["WARC-Refers-To"]) if kind == "revisit" else None,
        "payload_bytes": len(payload) if kind == "response" else int(fields["WARC-Payload-Length"]),
        "payload_digest": digest, "payload": payload if kind == "response" else None}


def round_trip(pages: DataFrame) -> DataFrame:
    """Write every page, then read every record back."""
    folder = scratch_path(pages.sparkSession, "warc")
    return read(write(pages, folder), folder)


def round_trip_digest(pages: DataFrame) -> DataFrame:
    return round_trip(pages).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
