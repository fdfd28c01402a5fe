"""The four stylometric features of a document."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from qirtas.functions.lexicons import TOP_WORDS
from qirtas.functions.tokens import let, run_lengths

# Whitespace as str.strip() sees it.
BLANK = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\u00A0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200A"
    "\u2028\u2029\u202F\u205F\u3000"
)

# Sentence ends.  The Arabic comma is one, the semicolon is not.
SENTENCE_END = ".!?؟،"


def word_length_variance(tokens: Column) -> Column:
    """Population variance of token lengths, 0 below two tokens (f15).

    (n * sum(l*l) - sum(l)^2) / n^2: one pass, and exact while the products
    stay below 2^53.
    """
    n = F.size(tokens).cast("double")
    total = F.aggregate(tokens, F.lit(0.0), lambda a, t: a + F.length(t))
    squares = F.aggregate(tokens, F.lit(0.0), lambda a, t: a + F.length(t) * F.length(t))
    variance = let(total, lambda s: (n * squares - s * s) / (n * n))
    return F.when(F.size(tokens) < 2, F.lit(0.0)).otherwise(variance).cast("float")


def sentences_per_paragraph(text: Column | str) -> Column:
    """Non-blank sentences per non-blank line of the raw text (f36).

    A line break ends a sentence too, so the sentences of all lines together
    are the non-blank pieces between any of the marks: two flat splits, no
    nested arrays.
    """
    raw = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    sentences = _non_blank(F.split(raw, f"[\n{SENTENCE_END}]"))
    paragraphs = _non_blank(F.split(raw, "\n"))
    return (sentences / F.greatest(paragraphs, F.lit(1))).cast("float")


def _non_blank(pieces: Column) -> Column:
    return F.size(F.array_remove(F.transform(pieces, lambda p: F.btrim(p, F.lit(BLANK))), ""))


def lexicon_hits(tokens: Column, lexicon: Iterable[str] = TOP_WORDS) -> Column:
    """Number of distinct lexicon words present (f57)."""
    listed = F.array(*[F.lit(w) for w in lexicon])
    return F.size(F.array_intersect(tokens, listed))


def token_entropy(tokens: Column) -> Column:
    """Shannon entropy in bits of the token distribution, 0 when empty (f78).

    log2(n) - sum(c * log2(c)) / n over the token counts c.
    """
    n = F.size(tokens)
    weighted = F.aggregate(run_lengths(tokens), F.lit(0.0), lambda a, c: a + c * F.log2(c))
    entropy = F.log2(n) - weighted / n
    return F.when(n == 0, F.lit(0.0)).otherwise(entropy).cast("float")
