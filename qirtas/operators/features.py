"""Document-level cleaning and feature tables; both are narrow projections."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qirtas.functions import style
from qirtas.functions.lexicons import TOP_WORDS
from qirtas.functions.text import BATCH, Profile, clean_text, has_script
from qirtas.functions.tokens import tokenize


def with_cleaned(
    df: DataFrame,
    text: str = "text",
    stopwords: Iterable[str] = (),
    stem: bool = False,
    profile: Profile = BATCH,
) -> DataFrame:
    """Add ``cleaned_text`` and keep the rows where it is not empty.

    The cleaner runs once per row.  Texts without any kept character go by a
    test on the raw column.  Stopword removal can still empty a text, and a
    filter on the cleaned column would run the cleaner a second time, so those
    rows go with an ``explode`` of a zero- or one-element array instead.
    """
    words = frozenset(stopwords)
    cleaned = clean_text(text, words, stem, profile)
    kept = df.filter(has_script(text))
    if not words:
        return kept.withColumn("cleaned_text", cleaned)
    return kept.select("*", F.explode(F.array_remove(F.array(cleaned), "")).alias("cleaned_text"))


def with_features(
    df: DataFrame,
    text: str = "text",
    cleaned: str = "cleaned_text",
    lexicon: Iterable[str] = TOP_WORDS,
) -> DataFrame:
    """Add the four stylometric features.

    ``f78_perplexity`` holds the token entropy in bits; the name is kept for
    schema parity.
    """
    tokens = F.col("_tokens")
    return (
        df.withColumn("_tokens", tokenize(cleaned))
        .withColumns(
            {
                "f15_word_len_variance": style.word_length_variance(tokens),
                "f36_avg_sent_per_para": style.sentences_per_paragraph(text),
                "f57_top50_words_count": style.lexicon_hits(tokens, lexicon),
                "f78_perplexity": style.token_entropy(tokens),
            }
        )
        .drop("_tokens")
    )
