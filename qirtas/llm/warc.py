"""WARC archives: written as one gzip member per record and read in sequence.

The reader inflates a member bit by bit, frames the record by its
Content-Length and verifies both digests.  Each task writes files of its own
under new names; only the manifest rows of tasks that ended well name them, so
what a lost executor left behind is never read.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qirtas.llm import common
from qirtas.storage import fresh_path, materialize

MIN_SHARED_BYTES = 100
# A task begins a new archive when one has so many bytes.
ARCHIVE_BYTES = 256 << 20
READ_BYTES = 1 << 18
# Fixed, so that writing again gives the same bytes; pages has no time of capture.
DATE = "1970-01-01T00:00:00Z"
MANIFEST = "path string, records long, bytes long"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record.  A revisit has the headers of its response and no payload."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
    block = head % len(payload) + (payload if refers_to is None else b"")
    kind = "response" if refers_to is None else "revisit"
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url} {digest}')}>"),
        ("WARC-Date", DATE),
        ("Content-Type", "application/http;msgtype=response"),
        ("WARC-Block-Digest", "sha256:" + hashlib.sha256(block).hexdigest()),
        ("WARC-Payload-Digest", "sha256:" + digest),
        ("Content-Length", str(len(block))),
    ]
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if url is not None:
        safe = "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode()) for c in url)
        fields.append(("WARC-Target-URI", safe))
    if refers_to is not None:
        fields.append(("X-Refers-To-Page-ID", str(refers_to)))
        fields.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    header = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return f"WARC/1.1\r\n{header}\r\n".encode() + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(data) + deflate.flush()


class BadRecord(ValueError):
    """A record whose framing or digest is wrong."""


def members(stream: BinaryIO, read_bytes: int = READ_BYTES) -> Iterator[bytes]:
    """The inflated bytes of each gzip member, one member at a time."""
    raw, out, inflate, open_ = b"", bytearray(), zlib.decompressobj(31), False
    while raw or (raw := stream.read(read_bytes)):
        out += inflate.decompress(raw, read_bytes)
        raw, open_ = inflate.unconsumed_tail, True
        if inflate.eof:
            yield bytes(out)
            raw, open_ = inflate.unused_data, False
            out, inflate = bytearray(), zlib.decompressobj(31)
    if open_:
        out += inflate.flush()
        if not inflate.eof:
            raise BadRecord("the archive ends inside a member")
        yield bytes(out)


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Fields (lower-case names) and block of one record, framed and verified."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not found or not lines[0].startswith("WARC/1."):
        raise BadRecord("no record header")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    length = int(fields["content-length"])
    block, end = rest[:length], rest[length:]
    if len(block) != length or end != b"\r\n\r\n":
        raise BadRecord(f"Content-Length {length} does not frame the record")
    verify(fields["warc-block-digest"], block)
    return fields, block


def verify(declared: str, data: bytes) -> None:
    name, _, value = declared.partition(":")
    if hashlib.new(name, data).hexdigest() != value:
        raise BadRecord(f"digest {declared} does not hold")


def result_row(fields: dict[str, str], block: bytes) -> tuple:
    """page_id, payload_bytes, payload_digest, record_type, refers_to."""
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(
        int(v) for k, _, v in (x.partition(b":") for x in http.split(b"\r\n")) if k.lower() == b"content-length"
    )
    kind = fields["warc-type"]
    if kind == "response":
        verify(fields["warc-payload-digest"], payload)
        if len(payload) != length:
            raise BadRecord("the payload has another length")
    number = lambda name: int(fields[name]) if name in fields else None
    digest = fields["warc-payload-digest"].partition(":")[2]
    return number("x-page-id"), length, digest, kind, number("x-refers-to-page-id")


def write_archives(
    df: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html",
    min_shared_bytes: int = MIN_SHARED_BYTES, archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Writes a record per row below ``folder``; returns the written manifest.

    A null payload is empty.  Of equal payloads of at least ``min_shared_bytes`` the
    rows with the smallest key are responses (all of them if rows repeat) and the
    others revisits.  Null keys are never referred to; such a row is a revisit if a
    row with a key has its payload, else a response.  ``folder`` is a path that
    executors can write: a mounted one, or any store that Arrow opens by its URI.
    """
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = df.select(F.col(key).cast("long").alias("_id"), F.col(url).alias("_url"), payload.alias("_html"))
    rows = rows.withColumn("_digest", F.sha2("_html", 256))
    large = rows.filter(F.octet_length("_html") >= min_shared_bytes).select("_id", "_digest")
    first = (
        large.groupBy("_digest")
        .agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
        .filter("_n > 1 AND _first IS NOT NULL")
    )
    revisits = (
        large.join(first, "_digest")
        .filter(~F.col("_id").eqNullSafe(F.col("_first")))
        .select(F.col("_id").alias("_rid"), F.col("_digest").alias("_rdigest"), F.col("_first").alias("_refers_to"))
        .distinct()
    )
    same = F.col("_id").eqNullSafe(F.col("_rid")) & (F.col("_digest") == F.col("_rdigest"))
    linked = rows.join(revisits.hint("shuffle_merge"), same, "left").select(
        "_id", "_url", "_html", "_digest", "_refers_to"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, base = fs.FileSystem.from_uri(folder)
        target.create_dir(base, recursive=True)
        path, sink, records, size = "", None, 0, 0

        def close() -> pa.RecordBatch:
            sink.close()
            return pa.RecordBatch.from_pydict({"path": [path], "records": [records], "bytes": [size]})

        for ids, urls, htmls, digests, refers in common.slices(batches):
            for i, u, h, d, r in zip(ids, urls, htmls, digests, refers, strict=True):
                if sink is None:
                    path = f"{base}/{uuid.uuid4().hex}.warc.gz"
                    sink, records, size = target.open_output_stream(path, compression=None), 0, 0
                data = member(record(i, u, h.encode(), d, r))
                sink.write(data)
                records, size = records + 1, size + len(data)
                if size >= archive_bytes:
                    yield close()
                    sink = None
        if sink is not None:
            yield close()

    return materialize(linked.mapInArrow(run, MANIFEST), "manifest")


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per record, an archive per task; fails on the first bad record."""
    schema = pa.schema(
        [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
         ("record_type", pa.string()), ("refers_to", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, _ = fs.FileSystem.from_uri(folder)
        for paths, counts, _ in common.slices(batches):
            for path, declared in zip(paths, counts, strict=True):
                rows, read = [], 0
                with source.open_input_stream(path, compression=None) as stream:
                    for data in members(stream):
                        rows.append(result_row(*parse(data)))
                        read += 1
                        if len(rows) == 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                            rows = []
                if read != declared:
                    raise BadRecord(f"{path} has {read} records, not {declared}")
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return manifest.repartition(max(manifest.count(), 1)).mapInArrow(run, RECORD)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "warc")
    return read_archives(write_archives(common.table(spark, sf_dir, "pages"), folder), folder)


SQL = f"""
WITH payloads AS (SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS digest FROM pages),
firsts AS (SELECT digest, min(page_id) AS first FROM payloads GROUP BY digest)
SELECT page_id, strlen(html) AS payload_bytes, digest AS payload_digest,
    CASE WHEN strlen(html) >= {MIN_SHARED_BYTES} AND first IS NOT NULL AND page_id IS DISTINCT FROM first
        THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN strlen(html) >= {MIN_SHARED_BYTES} AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM payloads JOIN firsts USING (digest)
"""
