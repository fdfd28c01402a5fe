"""Token counts against the library on whole texts."""

import random

import public_tokenizers
import pytest

from qirtas.llm import token_counts as tc
from qirtas.llm.words import WordIds, tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = list("abcdeABZ'stre <|>.!#123\t\n\x0b\x0c\x1c\x85  éÉΣσßİıſ̸́ｆ漢字한가😀 ") + [
    "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "don't", " the ", " worthless",
]


def whole(text):
    return tokenizer(PATH).encode(text, add_special_tokens=False).ids


def texts(n, length, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(ALPHABET, k=rng.randint(0, length))) for _ in range(n)]


def test_word_ids_equal_the_library():
    cases = texts(400, 60, 1) + [None, "", " ", "\n\n"]
    ids = WordIds(PATH, memo_words=50)
    for k in range(0, len(cases), 40):
        part = cases[k : k + 40]
        for text, blob in zip(part, ids.blobs(part), strict=True):
            assert [int.from_bytes(blob[i : i + 4], "little") for i in range(0, len(blob), 4)] == whole(text or "")


@pytest.mark.parametrize("chunk, overlap", [(16, 4), (40, 8), (200, 30)])
def test_chunks_equal_the_whole(chunk, overlap):
    cases = texts(60, 400, 2) + ["a" * 300, "ab " * 200, "x" * 90 + " y " + "z" * 90, "  " * 200]
    for text in cases:
        assert tc.spliced_ids(PATH, text, chunk, overlap) == whole(text)


def test_rows(spark):
    rows = [(1, "Hello world", 7), (1, "Hello world", 7), (None, None, None), (2, "", 0), (3, "word " * 9000, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = [tuple(r) for r in tc.count_tokens(df, PATH).collect()]
    assert got == [(1, 11, 2, False), (1, 11, 2, False), (None, 0, 0, False), (2, 0, 0, False), (3, 45000, 9000, True)]
    assert tc.count_tokens(df.limit(0), PATH).count() == 0


def test_model_files(spark):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    df = spark.createDataFrame([(1, "Hello  world"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in tc.count_tokens(df, path).collect()}
    assert got == {1: len(sp.encode("Hello  world")), 2: 0}


def test_query(spark, small):
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in tc.op5_token_counts(spark, small).collect()}
    for r in spark.read.parquet(f"{small}/documents.parquet").collect():
        n = len(whole(r.text or ""))
        assert got[r.doc_id] == (len((r.text or "").encode()), n, n > 2048)


def test_letters_and_punctuation_apart_are_the_word():
    cases = [a + b for a in ("a", "don", "größe", "ñÿß", "µm", "é", "×", "éİ") for b in ("", ".", "'s", "$$$", "<|", "'", "<|endoftext|>")]
    got = WordIds(PATH).blobs(cases)
    assert [list(memoryview(b).cast("I")) for b in got] == [whole(c) for c in cases]


# Capitals whose composite exists in lower case only, and some that compose behind another mark.
COMPOSING = ["H\u0331", "J\u030c", "T\u0308", "W\u030a", "Y\u030a", "T\u0344"]


def test_capitals_that_compose(spark):
    cases = [a + c + b for c in [*COMPOSING, "H\u05b0\u0331", "\u00c9J\u030cA"] for a in ("", "Wa", "Le ") for b in ("", "r", "R.", " End")]
    got = WordIds(PATH).blobs(cases)
    assert [list(memoryview(b).cast("I")) for b in got] == [whole(c) for c in cases]
    df = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    sizes = [{r.doc_id: r.n_tokens for r in tc.count_tokens(df, PATH, chunk=n).collect()} for n in (tc.CHUNK, 1)]
    assert sizes[0] == sizes[1] == {k: len(whole(c)) for k, c in enumerate(cases)}
