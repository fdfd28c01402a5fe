"""Archives: round trip, revisits, framing and digests."""

import gzip
import hashlib
import io

import pytest
from pyarrow import fs

from qirtas.llm import warc
from qirtas.storage import fresh_path
from tests.llm.sql import assert_same


def test_query(spark, small):
    assert_same(warc.op7_warc(spark, small), warc.SQL, small)


def round_trip(spark, rows, **options):
    df = spark.createDataFrame(rows, "page_id long, url string, html string, payload_digest string")
    folder = fresh_path(spark, "warc")
    manifest = warc.write_archives(df, folder, **options)
    return manifest, sorted(map(tuple, warc.read_archives(manifest, folder).collect()), key=str)


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def test_edge_rows(spark):
    long, big = "é" * 50, "x" * 700_000
    rows = [(1, "http://a/\r\nX: y", long, "c"), (2, None, long, "c"), (2, None, long, "c"), (3, "u", None, "c"), (4, "u", "", "c"),
            (5, "u", "z" * 99, "c"), (6, "u", "z" * 99, "c"), (None, "u", long, "c"), (7, "u", big, "c"), (9, "u", "\r\n\r\n" * 30, "c"), (None, None, "w" * 200, "c")]
    _, got = round_trip(spark, rows)
    want = []
    for i, _, html, _ in rows:
        first = 1 if html == long and i != 1 else None
        want.append((i, len((html or "").encode()), sha(html), "revisit" if first else "response", first))
    assert got == sorted(want, key=str)


def test_no_rows(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    folder = fresh_path(spark, "warc")
    assert warc.read_archives(warc.write_archives(df, folder), folder).count() == 0


def test_archives_are_plain_gzip_and_bounded(spark):
    manifest, got = round_trip(spark, [(i, f"http://h/{i}", f"{i} " * 500, "c") for i in range(40)], archive_bytes=4000)
    files = manifest.collect()
    assert len(files) > 1 and sum(f.records for f in files) == 40 == len(got)
    data = fs.LocalFileSystem().open_input_stream(files[0].path, compression=None).read()
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") == files[0].records


@pytest.mark.parametrize("read_bytes", [1, 7, 1 << 16])
def test_members(read_bytes):
    parts = [b"", b"a" * 100_000, b"end"]
    data = b"".join(map(warc.member, parts))
    assert list(warc.members(io.BytesIO(data), read_bytes)) == parts
    with pytest.raises(warc.BadRecord):
        list(warc.members(io.BytesIO(data[:-3]), read_bytes))


def test_bad_records():
    good = warc.record(1, "http://a/", b"payload", hashlib.sha256(b"payload").hexdigest(), None)
    assert warc.result_row(*warc.parse(good))[:2] == (1, 7)
    for bad in (good.replace(b"payload\r\n\r\n", b"payloaD\r\n\r\n"), good[:-2], good + b"x", good.replace(b"WARC/1.1", b"HTTP/1.1")):
        with pytest.raises(warc.BadRecord):
            warc.result_row(*warc.parse(bad))
