"""Text expressions against plain Python on random and boundary strings."""

import random

import pytest
from pyspark.sql import functions as F

from qirtas.functions import rules, stem, style, text, tokens
from qirtas.functions.lexicons import RULE_WORDS, TOP_WORDS
from qirtas.operators.features import with_cleaned, with_features
from tests import brute

LETTERS = "ابتثجحخدذرزسشصضطظعغفقكلمنهويةىءآأؤإئ"
OTHER = " \n\t،؟؛.!?aZé7٣ـٰ  ​😀"
MARKS = "".join(map(chr, [*range(0x610, 0x61B), *range(0x64B, 0x656)]))
EDGES = [
    None, "", " ", "\n\n", "abc", "ـ", "،", "ًٌٍ", "ا", "ا ا", "ا. ب\n \nج؟ د، هـ",
    " \n ا", "　. ", "كلمة  كلمة", "و" * 300, "لا ا", "بنى", "a،b", "ا\r\nب",
]


def _random_text(rng):
    words = []
    for _ in range(rng.randint(0, 40)):
        pool = rng.choice([LETTERS, LETTERS, LETTERS + MARKS, LETTERS + OTHER, "اوت", OTHER])
        words.append("".join(rng.choice(pool) for _ in range(rng.randint(1, 9))))
    words += rng.sample(TOP_WORDS, rng.randint(0, 8))
    rng.shuffle(words)
    return rng.choice([" ", "  ", "\n", ". ", "، "]).join(words)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    return EDGES + [_random_text(rng) for _ in range(1500)]


@pytest.fixture(scope="module")
def table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "i int, text string").repartition(3)


def _values(df):
    return dict(df.collect())


def test_cleaners(table, texts):
    stop = ["ا", "اوت", "تو", "علم", "أب"]
    checks = {
        "plain": (text.clean_text("text"), brute.clean),
        "stopped": (text.clean_text("text", stop), lambda t: brute.clean(t, stop)),
        "stemmed": (
            text.clean_text("text", stop, stem=True),
            lambda t: brute.clean(t, stop, stem=True),
        ),
        "light": (text.stream_clean("text"), brute.light),
    }
    rows = table.select("i", *[c.alias(n) for n, (c, _) in checks.items()]).collect()
    assert len(rows) == len(texts)
    for row in rows:
        for name, (_, expected) in checks.items():
            assert row[name] == expected(texts[row["i"]]), (name, texts[row["i"]])


def test_single_steps(table, texts):
    steps = table.select(
        "i",
        text.strip_diacritics("text"),
        text.normalize_letters("text"),
        text.script_filter("text"),
    )
    for i, stripped, folded, filtered in steps.collect():
        raw = texts[i]
        if raw is None:
            assert (stripped, folded, filtered) == (None, None, None)
            continue
        assert stripped == brute.fold(raw, {})
        assert folded == "".join(brute.BATCH.get(c, c) for c in raw)
        assert filtered == brute.script(raw)


def test_stem_of_random_words(spark):
    rng = random.Random(3)
    words = {"".join(rng.choice("استمنويهكةفعلئأو") for _ in range(rng.randint(1, 9))) for _ in range(6000)}
    affixes = ["", "ال", "وال", "بال", "لل", "است", "مست"], ["", "ون", "ات", "تان", "ها", "ه"]
    words |= {rng.choice(affixes[0]) + w[:4] + rng.choice(affixes[1]) for w in list(words)}
    words |= brute.KEPT
    df = spark.createDataFrame([(w,) for w in words if w], "w string")
    for w, s in df.select("w", stem.stem_text(F.col("w"), folded=False)).collect():
        assert s == brute.root(w), w


def test_known_stems(spark):
    pairs = {
        "النتيجه": "نتج", "نتايج": "تيج", "الجزاير": "جزير", "استخدام": "خدم",
        "الدراسات": "درس", "بحوث": "بحث", "يكون": "يكون",
    }
    df = spark.createDataFrame([(" ".join(pairs),)], "t string")
    assert df.select(stem.stem_text(F.col("t"))).first()[0] == " ".join(pairs.values())


def test_features(table, texts):
    df = table.withColumn("cleaned_text", text.clean_text("text"))
    for row in with_features(df).collect():
        words = row["cleaned_text"].split()
        assert row["f15_word_len_variance"] == pytest.approx(brute.variance(words), rel=1e-6, abs=1e-6)
        assert row["f36_avg_sent_per_para"] == pytest.approx(brute.sentences(row["text"]), rel=1e-6)
        assert row["f57_top50_words_count"] == len(set(words) & set(TOP_WORDS))
        assert row["f78_perplexity"] == pytest.approx(brute.entropy(words), rel=1e-5, abs=1e-6)
    assert dict(with_features(df).dtypes)["f78_perplexity"] == "float"
    assert dict(with_features(df).dtypes)["f57_top50_words_count"] == "int"


def test_rule(table, texts):
    df = table.withColumn("c", text.stream_clean("text"))
    for i, label in df.select("i", rules.rule_label("c")).collect():
        assert label == brute.rule(brute.light(texts[i]), RULE_WORDS)


@pytest.mark.parametrize(
    "overlap, length, expected",
    [(0, 3, "human"), (0, 2, "ai"), (1, 3, "ai"), (1, 4, "human"), (3, 5, "ai"), (3, 6, "human"),
     (5, 19, "ai"), (5, 20, "human"), (6, 300, "ai")],
)
def test_rule_thresholds(spark, overlap, length, expected):
    """Words of one mean length, some of them listed."""
    words = [chr(0x627 + k) * length for k in range(10)]
    df = spark.createDataFrame([(" ".join(words),)], "c string")
    assert df.select(rules.rule_label("c", words[:overlap])).first()[0] == expected


def test_token_arrays(spark):
    df = spark.createDataFrame(
        [(0, ""), (1, "ا"), (2, "ب ا ب"), (3, " ب  ا ")], "i int, c string"
    ).withColumn("t", tokens.tokenize("c"))
    pairs = {
        r["i"]: [tuple(p) for p in r["b"]]
        for r in df.select("i", tokens.bigrams(F.col("t")).alias("b")).collect()
    }
    assert pairs == {0: [], 1: [], 2: [("ب", "ا"), ("ا", "ب")], 3: [("ب", "ا")]}
    counts = {
        r["i"]: {p["term"]: p["tf"] for p in r["n"]}
        for r in df.select("i", tokens.token_counts(F.col("t")).alias("n")).collect()
    }
    assert counts == {0: {}, 1: {"ا": 1}, 2: {"ب": 2, "ا": 1}, 3: {"ب": 1, "ا": 1}}
    assert _values(df.select("i", tokens.type_token_ratio(F.col("t")))) == {
        0: 0.0, 1: 1.0, 2: pytest.approx(2 / 3), 3: 1.0,
    }
    assert _values(df.select("i", tokens.single_space_word_count("c"))) == {0: 1, 1: 1, 2: 3, 3: 5}


def test_long_document(spark):
    """A row far beyond the usual length: counting stays linear in memory."""
    words = [LETTERS[i % 7] * (1 + i % 5) for i in range(60_000)]
    df = spark.createDataFrame([(" ".join(words),)], "text string")
    row = with_features(with_cleaned(df)).first()
    cleaned = brute.clean(" ".join(words)).split()
    assert row["f78_perplexity"] == pytest.approx(brute.entropy(cleaned), rel=1e-5)
    assert row["f15_word_len_variance"] == pytest.approx(brute.variance(cleaned), rel=1e-6)


def test_one_huge_word(spark):
    """No blank for two million letters: no stack overflow, no quadratic scan."""
    word = "وال" + "كتبها" * 400_000
    df = spark.createDataFrame([(word + " ال" + " " * 50_000 + "الدراسات",)], "text string")
    row = with_cleaned(df, stem=True, stopwords=["ال"]).first()
    assert row["cleaned_text"] == brute.root(word) + " درس"


def test_empty_rows_go(table, texts):
    stop = ["ا", "اوت"]
    for stopwords in ([], stop):
        kept = {r["i"] for r in with_cleaned(table, stopwords=stopwords).collect()}
        assert kept == {i for i, t in enumerate(texts) if brute.clean(t, stopwords)}


def test_dead_stopwords():
    assert text.fold_words(["إلى", "آخَر", "ً"]) == {"الي", "اخر"}


def test_lexicon_shape():
    assert len(TOP_WORDS) == len(set(TOP_WORDS)) == 50
    assert RULE_WORDS == TOP_WORDS[:20]


def test_no_python_in_plans(table):
    df = with_features(with_cleaned(table, stopwords=["ا"], stem=True))
    df = df.withColumn("p", rules.rule_label("cleaned_text"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "MapInPandas" not in plan
    assert plan.count("explode(array_remove(array(") == 1
