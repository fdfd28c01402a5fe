"""Chunking, digests and cuts against a plain version and planted passages."""

import random

import numpy as np
import pytest
import xxhash

from qirtas.llm import substring_dedup as sd


def raw(text):
    return np.frombuffer((text or "").encode(), np.uint8)


def plain_starts(data):
    starts, last = [0] if len(data) else [], 0
    for i in range(len(data)):
        h = 0
        for b in data[max(0, i - 15) : i + 1]:
            h = ((h << 1) + int(sd.GEAR[b])) & 0xFFFF
        if i - last >= sd.MOST:
            last += sd.MOST
            starts.append(last)
        if h >> (16 - sd.TOP_BITS) == 0 and i + 1 - last >= sd.LEAST and i + 1 < len(data):
            last = i + 1
            starts.append(last)
    return starts


@pytest.mark.parametrize("seed", range(20))
def test_chunks(seed):
    rng = random.Random(seed)
    alphabet = rng.choice(["a", "ab ", "abcdefgh é漢\n"])
    data = raw("".join(rng.choices(alphabet, k=rng.choice([0, 1, 15, 40, 3000]))))
    starts = sd.chunk_starts(data)
    assert starts.tolist() == plain_starts(data)
    assert all(np.diff([*starts, len(data)]) <= sd.MOST)


def test_insertions_change_few_chunks():
    rng = random.Random(1)
    text = "".join(rng.choices("abcdefghijklmnop qrst", k=20_000))
    whole = set(sd.digests(raw(text), sd.chunk_starts(raw(text))).tolist())
    moved = raw(text[:9_000] + "inserted" + text[9_000:])
    other = sd.digests(moved, sd.chunk_starts(moved)).tolist()
    assert sum(d not in whole for d in other) <= 6


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(n))


def plain_dedup(rows):
    """What dedup does, with dictionaries."""
    key = lambda i: (i is None, i or 0)
    whole = lambda t: np.uint64(xxhash.xxh64(t.encode(), seed=42).intdigest()).astype(np.int64)
    chunks, first = {}, {}
    for i, t in {(i, t or "") for i, t in rows}:
        data = raw(t)
        s = sd.chunk_starts(data)
        chunks[i, t] = [data[a:b].tobytes() for a, b in zip(s, [*s, len(data)][1:], strict=True)] if t else []
    for (i, t), parts in chunks.items():
        for k, part in enumerate(parts):
            place = (key(i), whole(t), k)
            first[part] = min(first.get(part, place), place)
    out = []
    for i, t in rows:
        parts = chunks[i, t or ""]
        repeated = [k for k, p in enumerate(parts) if first[p] != (key(i), whole(t or ""), k)]
        data = raw(t)
        spans = sd.repeated_spans(data, sd.chunk_starts(data), np.array(repeated, int), sd.MIN_WORDS) if repeated else []
        text, at = b"", 0
        for a, b in spans:
            text += data[at:a].tobytes()
            at = b
        ends = [*sd.chunk_starts(data), len(data)]
        within = sum(any(ends[k] < b and ends[k + 1] > a for a, b in spans) for k in repeated)
        out.append((i, None if t is None else (text + data[at:].tobytes()).decode(), len(repeated), within))
    return out


def test_planted_passages(spark):
    rng = random.Random(3)
    passage, line = words(rng, 55), words(rng, 10)
    rows = [(k, f"{words(rng, 80)} {passage}. {words(rng, 60)}\n{line}\n" + words(rng, 20)) for k in range(30)]
    rows += [(100 + k, words(rng, 90) + "\n" + line) for k in range(10)]
    rows += [(200, rows[0][1]), (None, None), (300, ""), (7, rows[7][1]), (None, rows[8][1]), (301, "x" * 4000), (302, "é " * 3000), (303, "é " * 3000)]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, dedup string, n_chars long")
    got = sd.dedup(df.drop("dedup")).collect()
    assert sorted(map(str, [(r.doc_id, r.text, r.dedup.n_known_chunks, r.dedup.n_repeated_chunks) for r in got])) == sorted(map(str, plain_dedup(rows)))
    text = {r.doc_id: r.text for r in got if r.doc_id is not None}
    kept = [k for k in range(30) if passage in text[k]]
    assert kept == [0]
    for k in range(1, 30):
        assert len(set(text[k].split()) & set(passage.split())) < 30
    assert all(text[k] == dict(rows)[k] for k in range(100, 110))
    assert len(text[200].split()) < 20 and text[300] == "" and text[7] != ""
    out = sd.cut_documents(df)
    assert out.dtypes == df.dtypes and out.count() == len(rows)
    assert sd.dedup(df.limit(0).drop("dedup")).count() == 0


def test_query(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    got = [(r.doc_id, r.text, r.n_known_chunks, r.n_repeated_chunks) for r in sd.op9_substring_dedup(spark, small).collect()]
    assert sorted(map(str, got)) == sorted(map(str, plain_dedup(rows)))


def test_many_rows_without_a_key(spark):
    """Rows are told apart by their whole texts: none is cut at another's places."""
    rng = random.Random(6)
    passage = words(rng, 60)
    rows = [(None, words(rng, 30)) for _ in range(200)] + [(None, f"{words(rng, 20)} {passage} {words(rng, 20)}") for _ in range(20)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id smallint, text string, `my col` int")
    got = [(r.doc_id, r.text, r.d.n_known_chunks, r.d.n_repeated_chunks) for r in sd.dedup(df, into="d").collect()]
    assert sorted(map(str, got)) == sorted(map(str, plain_dedup(rows)))
    assert sum(passage in t for _, t, _, _ in got) == 1
