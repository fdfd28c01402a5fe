"""The lexicon rule that labels a cleaned text without a trained model."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from qirtas.functions.lexicons import RULE_WORDS
from qirtas.functions.style import lexicon_hits
from qirtas.functions.tokens import let, tokenize

# Fixed values of the rule.
OVERLAP_WEIGHT = 0.6
LENGTH_WEIGHT = 10.0
THRESHOLD = 3.5


def rule_score(cleaned: Column | str, lexicon: Iterable[str] = RULE_WORDS) -> Column:
    """0.6 * lexicon hits + 10 / mean length of the distinct tokens (at least 1)."""

    def score(words: Column) -> Column:
        letters = F.aggregate(words, F.lit(0.0), lambda a, w: a + F.length(w))
        mean = letters / F.greatest(F.size(words), F.lit(1))
        short = LENGTH_WEIGHT / F.greatest(mean, F.lit(1.0))
        return lexicon_hits(words, lexicon) * OVERLAP_WEIGHT + short

    return let(F.array_distinct(tokenize(cleaned)), score)


def rule_label(cleaned: Column | str, lexicon: Iterable[str] = RULE_WORDS) -> Column:
    text = F.col(cleaned) if isinstance(cleaned, str) else cleaned
    return (
        F.when(F.coalesce(text, F.lit("")) == "", "unknown")
        .when(rule_score(text, lexicon) > THRESHOLD, "ai")
        .otherwise("human")
    )
