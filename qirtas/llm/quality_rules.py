"""Quality rules, lines first.

Each line is judged for itself: marks of navigation, boilerplate phrases, broken
punctuation.  Failing lines go, and a document that loses too much text with them
is rejected.  Before that, two rules look at the whole text: it must have enough
words, and not too many of them in passages that it repeats.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qirtas.llm import common

SPACE = "\x20\x09-\x0d"
MIN_WORDS = 10
MAX_REPEATED = 20  # hundredths of the words
MAX_LOST = 50  # hundredths of the characters in lines
# In a short text one boilerplate line weighs much: so much more may go, up to a share.
MORE_LOST, MAX_LOST_SHORT = 60, 80
WINDOW = 5

# Fixed values of the line rules.
MARKS = ["|", "»", "›", ">", ">>", "·", "•", "/", "::"]
PHRASES = [
    "all rights reserved", "accept cookies", "cookie policy", "we use cookies", "privacy policy",
    "terms of use", "terms of service", "enable javascript", "javascript is disabled", "lorem ipsum",
    "click here", "sign up", "log in", "subscribe now", "skip to content", "back to top", "read more",
    "this work is licensed under", "licensed under the apache license", "licensed under the mit license",
    "licensed under cc", "is licensed under", "licensed under",
    "alle rechte vorbehalten", "cookies akzeptieren", "mehr erfahren", "weiterlesen", "jetzt anmelden",
    "tous droits réservés", "accepter les cookies", "en savoir plus", "lire la suite", "mentions légales",
    "todos los derechos reservados", "aceptar cookies", "leer más", "aviso legal", "política de privacidad",
]
COPYRIGHTS = ["copyright (c)", "©"]  # a year may follow
PHRASE_SHARE = 40  # at least so many hundredths of the words are phrases
MARK_SHARE = 20  # at least so many hundredths of the words are marks of navigation
BROKEN_SHARE = 30  # ... have a run of symbols
SHOUTED_SHARE = 50  # ... end in two exclamation marks
UNSTOPPED_WORDS = 100  # words of a line without any punctuation

_WORD = re.compile(rf"[^{SPACE}]+")
_BROKEN = re.compile(r"[#*$%&]{3}")
_STOP = re.compile(r"[.!?,;:…。！？，、؟،।]")
_PHRASE_PATTERN = "|".join(
    [rf"\b{p}\b" for p in PHRASES] + [rf"{re.escape(p).replace(chr(92) + ' ', ' ')}(?: [0-9]{{4}})?" for p in COPYRIGHTS]
)
_PHRASE = re.compile(_PHRASE_PATTERN, re.ASCII)
_LITERALS = [*PHRASES, *COPYRIGHTS]
_ASCII_LOWER = {c: c + 32 for c in range(65, 91)}
_MARKS = frozenset(MARKS)


def may_hold_phrase(text: str) -> bool:
    """False only if no phrase is anywhere in the text: plain searches are much quicker than the pattern."""
    lower = text.lower()
    return any(p in lower for p in _LITERALS)


def line_fails(line: str, search: bool = True) -> bool:
    """``search``: could the line hold a phrase?"""
    words = _WORD.findall(line)
    n = len(words)
    marks = sum(w in _MARKS for w in words)
    if marks >= 2 and 100 * marks >= MARK_SHARE * n:
        return True
    if search and may_hold_phrase(line):
        phrases = sum(m.count(" ") + 1 for m in _PHRASE.findall(line.translate(_ASCII_LOWER)))
        if phrases and 100 * phrases >= PHRASE_SHARE * n:
            return True
    if "!!" in line and 100 * sum(w.endswith("!!") for w in words) >= SHOUTED_SHARE * n and n >= 3:
        return True
    if _BROKEN.search(line):
        broken = sum(1 for w in words if _BROKEN.search(w))
        if broken >= 2 and 100 * broken >= BROKEN_SHARE * n:
            return True
    return n >= UNSTOPPED_WORDS and not _STOP.search(line)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of which the text has two or more."""
    n = len(words)
    if n <= window:
        return 0
    number: dict[bytes, int] = {}
    code = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    if len(number) == n:
        return 0
    grams = code[: n - window + 1]
    for k in range(1, window):
        # Numbers of distinct shorter windows, so that the product fits 64 bits.
        grams = np.unique(grams, return_inverse=True)[1] if k > 1 and n**k >= 1 << 40 else grams
        grams = grams * n + code[k : n - window + 1 + k]
    _, inverse, counts = np.unique(grams, return_inverse=True, return_counts=True)
    twice = counts[inverse] > 1
    edge = np.zeros(n + 1, np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int((np.cumsum(edge[:n]) > 0).sum())


def judge_text(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    n_lines, n_failed_lines, lost_chars and the text without its failing lines."""
    text = text or ""
    words = text.encode().split()
    n = len(words)
    chars = len(text) - sum(map(text.count, " \t\n\x0b\x0c\r"))
    symbols = sum(map(text.count, "#*$%&|<>"))
    search = may_hold_phrase(text)
    seen: set[str] = set()
    duplicates = lines = failed = total = lost = 0
    good = []
    for line in text.split("\n"):
        if not _WORD.search(line):
            good.append(line)
            continue
        lines += 1
        total += len(line)
        if line in seen:
            duplicates += 1
        seen.add(line)
        if line_fails(line, search):
            failed += 1
            lost += len(line)
        else:
            good.append(line)
    repeated = repeated_words(words)
    base_failed = n < MIN_WORDS or 100 * repeated > MAX_REPEATED * n
    limit = min(MAX_LOST_SHORT * total, MAX_LOST * total + 100 * MORE_LOST)
    kept = not base_failed and 100 * lost <= limit
    return (n, chars, symbols, duplicates, repeated, base_failed, kept, lines, failed, lost, "\n".join(good))


FIELDS = [
    ("n_words", "long"), ("word_chars", "long"), ("n_symbols", "long"), ("n_dup_lines", "long"),
    ("n_repeat_words", "long"), ("base_failed", "boolean"), ("kept", "boolean"), ("n_lines", "long"),
    ("n_failed_lines", "long"), ("lost_chars", "long"), ("cleaned", "string"),
]
_ARROW = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}
_TYPES = {"long": T.LongType(), "boolean": T.BooleanType(), "string": T.StringType()}
_JUDGED = T.StructType([T.StructField(n, _TYPES[t]) for n, t in FIELDS])


def judge(df: DataFrame, text: str = "text", keep: list[str] | None = None, into: str = "judged") -> DataFrame:
    """``keep`` columns (default: all) and a struct ``into`` of each row; no row moves.

    A null or empty text has no words and is rejected.  Repeated rows and null
    keys are judged like any other; other columns pass through unchanged, whatever
    their names.
    """
    keep = df.columns if keep is None else keep
    rows = df.select(F.col(text).alias("_text"), F.struct(*[F.col(common.quoted(c)) for c in keep]).alias("_row"))

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, common.SLICE_ROWS):
                part = batch.slice(start, common.SLICE_ROWS)
                found = list(zip(*map(judge_text, part.column(0).to_pylist()), strict=True))
                judged = pa.StructArray.from_arrays(
                    [pa.array(v, _ARROW[t]) for v, (_, t) in zip(found, FIELDS, strict=True)],
                    [n for n, _ in FIELDS],
                )
                yield pa.RecordBatch.from_arrays([part.column(1), judged], ["_row", "judged"])

    schema = T.StructType([T.StructField("_row", rows.schema["_row"].dataType), T.StructField("judged", _JUDGED)])
    out = common.map_batches(rows, run, schema)
    return out.select(*common.fields_of("_row", keep), F.col("judged").alias(into))


def clean_documents(df: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The kept rows with their failing lines removed; columns as before."""
    into = common.free_name(df, "judged")
    cleaned = judge(df, text, into=into).filter(F.col(f"{into}.kept"))
    cleaned = cleaned.withColumn(text, F.col(f"{into}.cleaned")).drop(into)
    if n_chars in df.columns:
        cleaned = cleaned.withColumn(n_chars, F.length(text).cast(df.schema[n_chars].dataType))
    return cleaned


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(common.table(spark, sf_dir, "documents"), keep=["doc_id"])
    return judged.select("doc_id", *[f"judged.{n}" for n, _ in FIELDS if n != "cleaned"])


_Q = lambda s: s.replace("'", "''")
_PHRASES_SQL = _Q(_PHRASE_PATTERN)
_MARKS_SQL = ", ".join(f"'{m}'" for m in MARKS)
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SQL = rf"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
docs AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM texts),
positions AS (SELECT doc_id, words, unnest(generate_series(1, len(words) - {WINDOW - 1})) AS pos
    FROM docs WHERE len(words) >= {WINDOW}),
grams AS (SELECT doc_id, pos, words[pos:pos + {WINDOW - 1}] AS gram FROM positions),
twice AS (SELECT doc_id, pos FROM (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM grams) WHERE n > 1),
repeated AS (SELECT doc_id, count(DISTINCT pos + k) AS n_repeat_words
    FROM twice, (SELECT unnest(range({WINDOW})) AS k) GROUP BY doc_id),
split_ AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM texts),
lines AS (SELECT doc_id, pos, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS words FROM split_
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
counted AS (SELECT doc_id, pos, line, len(words) AS n, length(line) AS chars,
    len(list_filter(words, lambda w: w IN ({_MARKS_SQL}))) AS marks,
    len(list_filter(words, lambda w: regexp_matches(w, '[#*$%&]{{3}}'))) AS broken,
    len(list_filter(words, lambda w: ends_with(w, '!!'))) AS shouted,
    list_sum(list_transform(regexp_extract_all(translate(line, '{_UPPER}', '{_UPPER.lower()}'), '{_PHRASES_SQL}'),
        lambda m: len(string_split(m, ' ')))) AS phrases,
    regexp_matches(line, '{_STOP.pattern}') AS stopped,
    row_number() OVER (PARTITION BY doc_id, line ORDER BY pos) > 1 AS duplicate FROM lines),
judged AS (SELECT *, (marks >= 2 AND 100 * marks >= {MARK_SHARE} * n) OR coalesce(100 * phrases >= {PHRASE_SHARE} * n, false)
    OR (n >= 3 AND shouted > 0 AND 100 * shouted >= {SHOUTED_SHARE} * n)
    OR (broken >= 2 AND 100 * broken >= {BROKEN_SHARE} * n)
    OR (n >= {UNSTOPPED_WORDS} AND NOT stopped) AS fails FROM counted),
per_doc AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (fails) AS n_failed_lines,
    coalesce(sum(chars) FILTER (fails), 0)::BIGINT AS lost_chars, sum(chars) AS total,
    count(*) FILTER (duplicate) AS n_dup_lines FROM judged GROUP BY doc_id),
base AS (SELECT doc_id, len(words) AS n_words, list_aggregate(list_concat([0], list_transform(words, lambda w: length(w))), 'sum')::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols FROM docs)
SELECT doc_id, n_words, word_chars, n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
    coalesce(n_failed_lines, 0) AS n_failed_lines, coalesce(lost_chars, 0) AS lost_chars,
    n_words < {MIN_WORDS} OR 100 * coalesce(n_repeat_words, 0) > {MAX_REPEATED} * n_words AS base_failed,
    NOT (n_words < {MIN_WORDS} OR 100 * coalesce(n_repeat_words, 0) > {MAX_REPEATED} * n_words)
        AND 100 * coalesce(lost_chars, 0) <= least({MAX_LOST_SHORT} * coalesce(total, 0), {MAX_LOST} * coalesce(total, 0) + {100 * MORE_LOST}) AS kept
FROM base LEFT JOIN repeated USING (doc_id) LEFT JOIN per_doc USING (doc_id)
"""
