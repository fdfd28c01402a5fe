"""Quality rules against SQL, a plain count and edge rows."""

import random
from collections import Counter

import pytest

from qirtas.llm import quality_rules as qr
from tests.llm.sql import assert_same


def test_query(spark, small):
    assert_same(qr.op2_quality_rules(spark, small), qr.SQL, small)


def plain_repeats(words, w=5):
    grams = Counter(tuple(words[i : i + w]) for i in range(len(words) - w + 1))
    return len({i + k for i in range(len(words) - w + 1) if grams[tuple(words[i : i + w])] > 1 for k in range(w)})


@pytest.mark.parametrize("seed", range(30))
def test_repeats(seed):
    rng = random.Random(seed)
    words = [rng.choice("abcdefgh"[: rng.randint(1, 8)]).encode() for _ in range(rng.randint(0, 400))]
    assert qr.repeated_words(words) == plain_repeats(words)
    many = [str(rng.randint(0, 9000)).encode() for _ in range(9000)]
    many[100:160] = many[7000:7060]
    assert qr.repeated_words(many) == plain_repeats(many)


@pytest.mark.parametrize(
    "line, fails",
    [
        ("A plain sentence, with a stop.", False),
        ("short heading", False),
        ("Home | News | Sport | About", True),
        ("Home » News » Sport", True),
        ("He paid 3/4 of it and/or more.", False),
        ("© 2020 Example", True),
        ("Click here to subscribe", True),
        ("This work is licensed under the GNU General Public License, version 3.", True),
        ("Licensed under the Apache License, Version 2.0.", True),
        ("Licensed under CC BY-NC 4.0.", True),
        ("Alle Rechte vorbehalten.", True),
        ("They read more books in winter because the analog input was broken and cold.", False),
        ("The gardener will spread more evenly the seeds that grow along in spring time.", False),
        ("She signed the design up to the last page; he would log in later from the catalog index.", False),
        ("spread more", False),
        ("WOW!! BUY!! NOW!!", True),
        ("It was great!! We went home.", False),
        ("of%%% the&&& in***", True),
        ("A footnote *** ends it.", False),
        (" ".join(["word"] * 100), True),
        (" ".join(["word"] * 99), False),
        (" ".join(["word"] * 120) + ".", False),
    ],
)
def test_lines(line, fails):
    assert qr.line_fails(line) is fails


def test_edge_rows(spark):
    sentence = " ".join(f"w{i}" for i in range(12)) + "."
    rows = [
        (1, None), (1, None), (2, ""), (None, sentence), (3, f"{sentence}\nA | B | C\n\n"),
        (4, "A | B | C | D | E | F | G | H | I | J\n" * 9 + sentence), (5, " \n\t"), (6, "x\x1cy " * 6000),
    ]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, kept string, n_chars int")
    got = qr.judge(df).select("doc_id", "judged.*").collect()
    assert [(r.doc_id, r.n_words, r.kept, r.n_failed_lines) for r in got] == [
        (1, 0, False, 0), (1, 0, False, 0), (2, 0, False, 0), (None, 12, True, 0), (3, 17, True, 1),
        (4, 183, False, 9), (5, 0, False, 0), (6, 6000, False, 1),
    ]
    kept = qr.clean_documents(df)
    assert kept.columns == df.columns and kept.dtypes == df.dtypes
    assert [tuple(r) for r in kept.collect()] == [(None, sentence, "clash", len(sentence)), (3, sentence + "\n\n", "clash", len(sentence) + 2)]
    assert qr.judge(df.limit(0)).count() == 0
