"""Token arrays: splitting, stopwords, bigrams and row-local counting."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it several times in ``body``."""
    return F.transform(F.array(value), body).getItem(0)


def tokenize(col: Column | str) -> Column:
    return F.array_remove(F.split(col, " "), "")


def remove_stopwords(tokens: Column, words: Iterable[str]) -> Column:
    """Drop listed tokens, keep order and repeats (``array_except`` would dedup)."""
    listed = sorted(words)
    if not listed:
        return tokens
    return F.filter(tokens, lambda t: ~t.isin(listed))


def single_space_word_count(col: Column | str) -> Column:
    """Pieces between single spaces; the empty string counts as one."""
    return F.size(F.split(col, " "))


def bigrams(tokens: Column) -> Column:
    """Adjacent pairs as structs of ``first`` and ``second``; none below two tokens."""
    pairs = F.greatest(F.size(tokens) - 1, F.lit(0))
    return F.arrays_zip(
        F.slice(tokens, F.lit(1), pairs).alias("first"),
        F.slice(tokens, F.lit(2), pairs).alias("second"),
    )


def type_token_ratio(tokens: Column) -> Column:
    n = F.size(tokens)
    return F.when(n == 0, F.lit(0.0)).otherwise(F.size(F.array_distinct(tokens)) / n)


def run_starts(ordered: Column) -> Column:
    """1-based positions where a run of equal tokens starts in a sorted array."""
    n = F.size(ordered)
    return F.when(n == 0, F.array().cast("array<int>")).otherwise(
        F.filter(
            F.sequence(F.lit(1), n),
            lambda i: (i == 1) | (F.get(ordered, i - 1) != F.get(ordered, i - 2)),
        )
    )


def token_counts(tokens: Column) -> Column:
    """``array<struct<term, tf>>`` of one row, by sorting its tokens.

    Counting inside the row costs n log n and no shuffle; exploding and grouping
    by document would move every token over the network.
    """
    return let(
        F.sort_array(tokens),
        lambda s: let(
            run_starts(s),
            lambda at: F.transform(
                at,
                lambda p, j: F.struct(
                    F.get(s, p - 1).alias("term"),
                    (F.coalesce(F.get(at, j + 1), F.size(s) + 1) - p).cast("long").alias("tf"),
                ),
            ),
        ),
    )


def run_lengths(tokens: Column) -> Column:
    """How often each distinct token occurs, without the tokens themselves."""
    return let(
        F.sort_array(tokens),
        lambda s: let(
            run_starts(s),
            lambda at: F.transform(
                at, lambda p, j: F.coalesce(F.get(at, j + 1), F.size(s) + 1) - p
            ),
        ),
    )
