"""Encoding and decoding through the word table against the library."""

import hashlib

import numpy as np
import public_tokenizers
import pytest

from qirtas.llm import bpe
from qirtas.llm.words import tokenizer
from tests.llm.test_token_counts import COMPOSING, texts

PATH = public_tokenizers.path("word_bpe_49k.json")


def expected(text):
    ids = tokenizer(PATH).encode(text or "", add_special_tokens=False).ids
    decoded = tokenizer(PATH).decode(ids, skip_special_tokens=False)
    blob = np.asarray(ids, "<u4").tobytes()
    return len(ids), hashlib.sha256(blob).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def test_numbers_round_trip():
    values = np.array([0, 1, 127, 128, 16383, 16384, 2097151, 2097152, 5], np.int64)
    assert bpe.unpack_numbers(bpe.pack_numbers(values)).tolist() == values.tolist()
    assert bpe.unpack_numbers(b"").tolist() == []


@pytest.mark.parametrize("hot", [0, 5, 1000])
def test_any_limit_gives_the_same(spark, hot):
    cases = texts(60, 80, 3) + [None, "", "Word " * 3000, "x" * 5000, "Word " * 3000]
    rows = [(k // 2, t, b"", "clash") for k, t in enumerate(cases)] + [(None, "no key", b"", "")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, ids binary, word string")
    got = bpe.digests(bpe.encode(df, PATH, hot_words=hot), PATH).collect()
    assert sorted(map(str, got)) == sorted(
        str(spark_row) for spark_row in [type(got[0])(doc_id=r[0], n_tokens=e[0], ids_sha256=e[1], decoded_sha256=e[2]) for r in rows for e in [expected(r[1])]]
    )
    assert bpe.digests(bpe.encode(df.limit(0), PATH), PATH).count() == 0


def test_each_word_is_encoded_once(spark):
    df = spark.createDataFrame([(1, "b a B a"), (2, "a  c")], "doc_id long, text string")
    assert {(r.word, r.n) for r in bpe.word_table(df, PATH).collect()} == {("a", 3), ("b", 2), ("c", 1)}


def test_query(spark, small):
    got = {r.doc_id: tuple(r)[1:] for r in bpe.op8_bpe(spark, small).collect()}
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    assert got == {d.doc_id: expected(d.text) for d in docs}


def test_blobs_round_trip():
    cases = [b"", np.array([1, 49407], "<u4").tobytes(), np.array([300], "<u4").tobytes(), b""]
    assert bpe.unpack_blobs(bpe.pack_blobs(cases)) == cases
    assert bpe.unpack_blobs(bpe.pack_blobs([])) == []
    ids = np.array([0, 127, 128, 16383, 16384, 2097152, (1 << 32) - 1], "<u4").tobytes()
    assert bpe.unpack_ids(bpe.pack_ids(ids)) == ids and bpe.unpack_ids(bpe.pack_ids(b"")) == b""


def test_hashes_are_those_of_spark(spark):
    words = ["a", "größe", "x" * 100, "日本"]
    rows = spark.createDataFrame([(w,) for w in words], "w string").selectExpr("w", "xxhash64(w) h").collect()
    assert bpe.word_hashes([r.w.encode() for r in rows]).view(np.int64).tolist() == [r.h for r in rows]


def test_full_bitmap_gives_the_same(spark, monkeypatch):
    monkeypatch.setattr(bpe, "WORD_BITS", 6)
    rows = [(k, t) for k, t in enumerate(texts(40, 80, 4))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in bpe.digests(bpe.encode(df, PATH, hot_words=3), PATH).collect()}
    assert got == {k: expected(t) for k, t in rows}


@pytest.mark.parametrize("hot", [0, 1000])
def test_capitals_that_compose(spark, hot):
    rows = [(k, f"A{c}r {c} {c}r Be") for k, c in enumerate([*COMPOSING, *COMPOSING])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in bpe.digests(bpe.encode(df, PATH, hot_words=hot), PATH).collect()}
    assert got == {k: expected(t) for k, t in rows}


def test_lists_are_packed_together():
    values, begin = np.array([0, 128, 5, 2097152, 7], np.int64), [0, 2, 2, 5]
    packed = bpe.pack_lists(values, begin)
    assert packed == [bpe.pack_numbers(values[i:j]) for i, j in zip(begin, begin[1:], strict=False)]
    back, at = bpe.unpack_lists(packed)
    assert back.tolist() == values.tolist() and at.tolist() == begin
    assert [x.tolist() for x in bpe.unpack_lists([b"", b""])] == [[], [0, 0, 0]]


def test_ids_of_several_texts_at_once():
    words = [b"often", b"seen", b"gr\xc3\xb6\xc3\x9fe"]
    hot = bpe.Ids([b"", b"", *bpe.encode_words(PATH, words)])
    cases = [("often seen", [2, 3]), ("", []), ("lone often xylo", [bpe.BESIDE, 2, bpe.FROM_TABLE]), ("größe zyx", [4, bpe.FROM_TABLE])]
    coded = bpe.pack_lists(np.array([c for _, codes in cases for c in codes], np.int64), [0, 2, 2, 5, 7])
    beside = bpe.pack_words(bpe.encode_words(PATH, [b"lone"]), [0, 0, 0, 1, 1])
    unmet = lambda place, word: (2 * place + 1).to_bytes(4, "big") + word
    found = (2).to_bytes(4, "big") + bpe.pack_ids(bpe.encode_words(PATH, [b"zyx"])[0])
    got = bpe.whole_ids(PATH, hot, coded, beside, [None, None, [unmet(2, b"xylo")], [found]])
    assert got == [np.asarray(tokenizer(PATH).encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t, _ in cases]


def test_texts_are_filled_in_parts(spark, monkeypatch):
    rows = [(k, t) for k, t in enumerate(texts(30, 60, 5))]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(bpe, "FILL_BYTES", 50)
    encode = bpe.encode(df, PATH, hot_words=20)
    got = {r.doc_id: tuple(r)[1:] for r in bpe.digests(encode, PATH).collect()}
    assert got == {k: expected(t) for k, t in rows}
