"""Substring dedup by content-defined chunks.

A gear rolling hash over the bytes chooses chunk ends by what the last 16 bytes
are, so an insertion changes only the chunks around it.  Chunks with the same
digest are the same text; the first of them, by document and place, stays.  Where
neighbouring chunks that are not the first add up to a passage of enough words,
it is cut out of its document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qirtas.llm import common

# Chunks end where the top bits of the hash are 0: every 32 bytes or so, behind the least size.
TOP_BITS, LEAST, MOST = 5, 16, 512
MIN_WORDS = 20
_random = np.random.default_rng(20_240)
GEAR = _random.integers(0, 1 << 16, 256, np.uint16)
BYTE = _random.integers(0, 1 << 64, 256, np.uint64)
PLACE = _random.integers(0, 1 << 64, MOST, np.uint64) | np.uint64(1)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def chunk_starts(data: np.ndarray) -> np.ndarray:
    """Where the chunks of ``data`` begin; none of an empty text."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64)
    h = GEAR[data]
    for k in (1, 2, 4, 8):  # the hash of 2k bytes from two of k: h(i) + (h(i - k) << k)
        h[k:] = h[k:] + (h[:-k] << np.uint16(k)) if n > k else h[k:]
    starts, last = [0], 0
    for p in (np.flatnonzero(h >> np.uint16(16 - TOP_BITS) == 0) + 1).tolist():
        while p - last > MOST:
            last += MOST
            starts.append(last)
        if p - last >= LEAST and p < n:
            last = p
            starts.append(p)
    while n - last > MOST:
        last += MOST
        starts.append(last)
    return np.array(starts, np.int64)


def digests(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """64 bits of each chunk, as signed numbers."""
    if not len(starts):
        return np.zeros(0, np.int64)
    sizes = np.diff([*starts, len(data)])
    place = np.arange(len(data)) - np.repeat(starts, sizes)
    h = np.add.reduceat(BYTE[data] * PLACE[place], starts) + sizes.astype(np.uint64)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return (h ^ (h >> np.uint64(32))).view(np.int64)


def repeated_spans(data: np.ndarray, starts: np.ndarray, repeated: np.ndarray, min_words: int) -> list[tuple[int, int]]:
    """Byte ranges of whole words in runs of repeated chunks with enough words."""
    flags = np.zeros(len(starts) + 2, np.int8)
    flags[1:-1][repeated] = 1
    turn = np.diff(flags)
    ends = np.append(starts, len(data))
    blank = SPACE[data]
    spans = []
    for a, b in zip(ends[np.flatnonzero(turn == 1)], ends[np.flatnonzero(turn == -1)], strict=True):
        a, b = int(a), int(b)
        if a and not blank[a - 1]:  # the run begins inside a word: the word stays
            rest = np.flatnonzero(blank[a:b])
            a = a + int(rest[0]) if len(rest) else b
        if b < len(data) and not blank[b]:
            rest = np.flatnonzero(blank[a:b])
            b = a + int(rest[-1]) + 1 if len(rest) else a
        if b > a and len(data[a:b].tobytes().split()) >= min_words:
            spans.append((a, b))
    return spans


def chunks_within(places: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> int:
    """How many of these chunks lie in a span, at least with one byte."""
    if not spans:
        return 0
    begin, end = np.array(spans).T
    at = np.searchsorted(end, ends[places], "right")
    at = np.minimum(at, len(end) - 1)
    return int(((ends[places + 1] > begin[at]) & (ends[places] < end[at])).sum())


def chunk_rows(df: DataFrame, key: str, text: str) -> DataFrame:
    """digest, key, digest of the whole text (it tells rows with one key apart) and number of every chunk."""
    rows = df.select(F.col(key).alias("_key"), F.xxhash64(text).alias("whole"), F.col(text).alias("_text"))
    declared, field = common.key_field(rows, "_key")
    schema = pa.schema([("digest", pa.int64()), field, ("whole", pa.int64()), ("number", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, common.SLICE_ROWS):
                part = batch.slice(start, common.SLICE_ROWS)
                found, counts = [np.zeros(0, np.int64)], []
                for t in part.column(2).to_pylist():
                    data = np.frombuffer((t or "").encode(), np.uint8)
                    found.append(digests(data, chunk_starts(data)))
                    counts.append(len(found[-1]))
                counts = np.array(counts)
                total = int(counts.sum())
                at = np.repeat(np.arange(len(counts)), counts)
                number = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
                whole = part.column(1).to_numpy()[at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(found)), part.column(0).take(pa.array(at)), pa.array(whole), pa.array(number, pa.int32())],
                    schema=schema,
                )

    return common.map_batches(rows, run, f"digest long, {declared}, whole long, number int")


def dedup(
    df: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, into: str = "dedup"
) -> DataFrame:
    """All columns, and a struct ``into``: n_bytes, n_chunks, n_known_chunks (met before),
    n_repeated_chunks (those of them in spans that went), removed_bytes, spans (byte
    ranges that went) and the text that stays.

    The first occurrence is the one with the smallest key, then place; null keys
    come last.  A row repeated as a whole is one document: each of its copies
    keeps what the document keeps.  A null text has no chunks and stays null; an
    empty one stays empty.  Digests are summed up before the shuffle, so one that
    a third of all chunks share arrives as a row per task, and the join splits it.
    """
    chunks = chunk_rows(df, key, text)
    order = F.struct(F.col("_key").isNull().alias("none"), "_key", "whole", "number")
    first = (
        chunks.groupBy("digest")
        .agg(F.min(order).alias("first"), F.max(order).alias("last"))
        .filter("first != last")
        .select("digest", *[F.col(f"first.{c}").alias(f"_first{c}") for c in ("_key", "whole", "number")])
    )
    is_first = F.col("_key").eqNullSafe(F.col("_first_key")) & (F.col("whole") == F.col("_firstwhole")) & (F.col("number") == F.col("_firstnumber"))
    repeated = (
        chunks.join(first.hint("shuffle_merge"), "digest")
        .filter(~is_first)
        .groupBy(F.col("_key").alias("_rkey"), F.col("whole").alias("_rwhole"))
        .agg(F.collect_set("number").alias("repeated"))
    )
    rows = df.select(
        F.col(key).alias("_key"),
        F.xxhash64(text).alias("_whole"),
        F.col(text).alias("_text"),
        F.struct(*[F.col(common.quoted(c)) for c in df.columns if c != text]).alias("_row"),
    )
    same = F.col("_key").eqNullSafe(F.col("_rkey")) & (F.col("_whole") == F.col("_rwhole"))
    met = rows.join(repeated.hint("shuffle_merge"), same, "left").select("_text", "repeated", "_row")
    counts = ["n_bytes", "n_chunks", "n_known_chunks", "n_repeated_chunks", "removed_bytes"]
    names = [*counts, "spans", "text"]
    types = [pa.int64()] * 5 + [pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])), pa.string()]

    def cut(t: str | None, places: list[int] | None) -> tuple:
        raw = (t or "").encode()
        data = np.frombuffer(raw, np.uint8)
        starts = chunk_starts(data)
        if not places:
            return len(raw), len(starts), 0, 0, 0, [], t
        spans = repeated_spans(data, starts, np.array(places), min_words)
        kept, at = [], 0
        for a, b in spans:
            kept.append(raw[at:a])
            at = b
        left = b"".join([*kept, raw[at:]])
        listed = [{"begin": a, "end": b} for a, b in spans]
        within = chunks_within(np.array(places), np.append(starts, len(data)), spans)
        return len(raw), len(starts), len(places), within, len(raw) - len(left), listed, left.decode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, common.SLICE_ROWS):
                part = batch.slice(start, common.SLICE_ROWS)
                found = list(map(cut, part.column(0).to_pylist(), part.column(1).to_pylist()))
                values = zip(*found, strict=True)
                made = pa.StructArray.from_arrays([pa.array(v, t) for v, t in zip(values, types, strict=True)], names)
                yield pa.RecordBatch.from_arrays([part.column(2), made], ["_row", "dedup"])

    span = T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())])
    kinds = [T.LongType()] * 5 + [T.ArrayType(span), T.StringType()]
    cut_type = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds, strict=True)])
    schema = T.StructType([T.StructField("_row", met.schema["_row"].dataType), T.StructField("dedup", cut_type)])
    out = common.map_batches(met, run, schema)
    kept = [F.col("dedup.text").alias(c) if c == text else F.col(f"_row.{common.quoted(c)}").alias(c) for c in df.columns]
    return out.select(*kept, F.col("dedup").alias(into))


def cut_documents(df: DataFrame, key: str = "doc_id", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The rows with repeated passages cut out of their text; columns as before."""
    into = common.free_name(df, "_dedup")
    out = dedup(df, key, text, into=into).drop(into)
    if n_chars in df.columns:
        out = out.withColumn(n_chars, F.length(text).cast(df.schema[n_chars].dataType))
    return out


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    fields = ["n_bytes", "n_chunks", "n_known_chunks", "n_repeated_chunks", "removed_bytes", "spans"]
    return dedup(docs).select("doc_id", *[F.col(f"dedup.{n}") for n in fields], "text")
