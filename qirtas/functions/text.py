"""Cleaning of Arabic-script text as native string expressions.

The composite cleaner needs no token array: diacritics and letter variants are
handled by one ``translate`` pass, and every run of characters that are not
kept becomes one space.  A token array is built only for stopword removal.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from qirtas.functions import stem as stemming
from qirtas.functions.tokens import remove_stopwords, tokenize

# Code points that the cleaner deletes.  U+0640 (tatweel) and
# U+0670 (superscript alef) stay.
DIACRITICS = (
    "\u0617\u0618\u0619\u061A"
    "\u064B\u064C\u064D\u064E\u064F\u0650\u0651\u0652"
)

# The Arabic block, the only characters kept beside the space.
ARABIC = "\u0600-\u06FF"


@dataclass(frozen=True)
class Profile:
    """Which letters are folded together; ``letters[i]`` becomes ``folded[i]``."""

    letters: str
    folded: str


# Alef with hamza or madda to alef, alef maksura to yeh, hamza on
# waw to waw, hamza on yeh to yeh, teh marbuta to heh.
BATCH = Profile("إأآىؤئة", "ااايويه")

# The streaming profile leaves hamza on waw and on yeh alone.
STREAM = Profile("إأآىة", "ااايه")


def _text(col: Column | str) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def strip_diacritics(col: Column | str) -> Column:
    return F.translate(col, DIACRITICS, "")


def normalize_letters(col: Column | str, profile: Profile = BATCH) -> Column:
    return F.translate(col, profile.letters, profile.folded)


def fold(col: Column | str, profile: Profile = BATCH) -> Column:
    """Diacritics and letters in one pass; characters beyond ``folded`` are deleted."""
    return F.translate(col, profile.letters + DIACRITICS, profile.folded)


def script_filter(col: Column | str) -> Column:
    """Each run outside the Arabic block and the space becomes one space."""
    return F.regexp_replace(col, f"[^{ARABIC} ]+", " ")


def clean_text(
    col: Column | str,
    stopwords: Iterable[str] = (),
    stem: bool = False,
    profile: Profile = BATCH,
) -> Column:
    """Folded tokens joined by one space; null and empty give the empty string.

    Stopwords are matched after folding and before stemming.
    """
    words = frozenset(stopwords)
    cleaned = F.trim(F.regexp_replace(fold(_text(col), profile), f"[^{ARABIC}]+", " "))
    if words:
        cleaned = F.array_join(remove_stopwords(tokenize(cleaned), words), " ")
    return stemming.stem_text(cleaned) if stem else cleaned


def stream_clean(col: Column | str) -> Column:
    """The light cleaner of the stream: no stopwords, no stemming, inner spaces stay."""
    return F.trim(script_filter(fold(_text(col), STREAM)))


def has_script(col: Column | str) -> Column:
    """True when cleaning without stopwords leaves anything.

    Looks at the raw text and stops at the first kept character, so a scan can
    drop empty rows without running the cleaner twice (filter and projection).
    """
    return F.rlike(_text(col), F.lit(f"[{ARABIC}&&[^{DIACRITICS}]]"))


def fold_words(words: Iterable[str], profile: Profile = BATCH) -> frozenset[str]:
    """Driver-side folding of a word list, for lists stored un-normalised."""
    table = str.maketrans(profile.letters, profile.folded, DIACRITICS)
    return frozenset(w for w in (word.translate(table) for word in words) if w)
