"""Ranked lexical search, hybrid of term at a time and document at a time.

One pass over the texts counts the terms that queries ask for and writes a row per
document.  Document frequencies come from those rows.  Then each task turns blocks of
its rows into posting lists and answers every query on them.  Of a query's lists
the short ones are added up term at a time; the sums then are one more list, with
bounds of its own, beside the long ones.  Windows of document numbers are visited in
order: one whose bounds cannot reach the worst score kept is skipped, and in the
others documents from the sums go through the long lists by search, those with
the highest bound first, until what is left cannot lift them.  Only where the long
lists alone could reach that score are their other documents scored.

Queries go in sets of bounded size, each against all documents.  No term, however
common, is a key of a shuffle.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from qirtas.llm import common
from qirtas.storage import materialize

K = 10
# Characters of the queries of one set.
SET_CHARS = 4 << 20
# A block of posting lists: documents and postings at most (one document more).
BLOCK_DOCS, BLOCK_POSTINGS = 1 << 14, 1 << 20
WINDOW = 512
# A list is short if it has less than this share of the block's documents.
SHORT = 1 / 32

_terms = "".join(map(chr, range(128)))
# ASCII letters in lower case and digits stay, other ASCII separates, the bytes of other characters stay.
TERM_BYTES = bytes(ord(c.lower()) if c.isalnum() else 32 for c in _terms) + bytes(range(128, 256))


def term_counts(text: str | None) -> Counter:
    counts: Counter = Counter()
    for words in common.word_lists((text or "").encode().translate(TERM_BYTES)):
        counts.update(words)
    return counts


@dataclass
class Queries:
    """A set of queries: ``names[i]`` asks for the terms ``of[i]``, numbers by ``vocabulary``."""

    names: list
    of: list[np.ndarray]
    vocabulary: dict[bytes, int]


def query_sets(queries: DataFrame, name: str, text: str, set_chars: int) -> Iterator[Queries]:
    """Rows with one name are one query with the terms of them all."""
    spark = queries.sparkSession
    schema = pa.schema([("_row", pa.int64()), ("term", pa.binary())])

    def work(columns: list[list]) -> list[list]:
        found = [(r, t) for r, x in zip(*columns, strict=True) for t in term_counts(x)]
        return [list(c) for c in zip(*found, strict=True)] or [[], []]

    rows = materialize(queries.select(name, text, F.monotonically_increasing_id().alias("_row")), "queries")
    chars = rows.agg(F.sum(F.length(text))).first()[0] or 0
    sets = -(-chars // set_chars)
    for k in range(sets):
        some = rows.filter(F.pmod(F.xxhash64(name), F.lit(sets)) == k)
        terms = common.map_rows(some.select("_row", text), work, "_row bigint, term binary", schema)
        found = terms.join(some.select("_row", name), "_row").select(name, "term").distinct().collect()
        vocabulary: dict[bytes, int] = {}
        of: dict = {}
        for query, term in found:
            of.setdefault(query, []).append(vocabulary.setdefault(bytes(term), len(vocabulary)))
        if vocabulary:
            yield Queries(list(of), [np.array(sorted(t), np.int64) for t in of.values()], vocabulary)


def counted(docs: DataFrame, key: str, text: str, vocabulary: dict[bytes, int]) -> DataFrame:
    """key, n (terms of the text) and the numbers and counts of the terms asked for; texts without a term go."""
    declared, own = common.key_field(docs, key)
    lists = [("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int64()))]
    schema = pa.schema([own, ("n", pa.int64()), *lists])
    spark = docs.sparkSession
    number = spark.sparkContext.broadcast(vocabulary)

    def work(columns: list[list]) -> list[list]:
        out: list[list] = [[], [], [], []]
        known = number.value.get
        for k, t in zip(*columns, strict=True):
            counts = term_counts(t)
            if counts:
                met = [(i, tf) for term, tf in counts.items() if (i := known(term)) is not None]
                for values, v in zip(out, (k, counts.total(), [i for i, _ in met], [tf for _, tf in met]), strict=True):
                    values.append(v)
        return out

    rows = common.map_rows(docs.select(key, text), work, f"{declared}, n bigint, terms array<int>, tfs array<bigint>", schema)
    return materialize(rows, "counted")


class Block:
    """Posting lists of some documents: per term documents ascending, impacts, and highest impacts by window."""

    def __init__(self, terms: np.ndarray, tfs: np.ndarray, sizes: np.ndarray, lengths: np.ndarray, total: tuple[int, int]):
        self.docs = len(lengths)
        documents, words = total
        m = 100 - 90 + (90 * lengths * documents) // words
        owner = np.repeat(np.arange(self.docs), sizes)
        order = np.argsort(terms, kind="stable")
        self.doc, terms, tf = owner[order], terms[order], tfs[order]
        self.impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m[self.doc])
        window = self.doc // WINDOW
        new = np.flatnonzero((np.diff(terms, prepend=-1) != 0) | (np.diff(window, prepend=-1) != 0))
        self.run_window, self.run_begin = window[new], np.append(new, len(terms))
        self.run_most = np.maximum.reduceat(self.impact, new) if len(new) else new
        self.present = np.unique(terms)
        self.begin = np.searchsorted(terms, self.present)
        self.end = np.searchsorted(terms, self.present, "right")
        self.runs = np.searchsorted(new, np.append(self.begin, len(terms)))

    def places(self, terms: np.ndarray) -> np.ndarray:
        """Which of the lists that are there are asked for."""
        at = np.searchsorted(self.present, terms)
        at = np.minimum(at, len(self.present) - 1)
        return at[self.present[at] == terms] if len(self.present) else at[:0]


@dataclass
class Best:
    """The k best of a query so far: (-score, no key, key)."""

    k: int
    rows: list[tuple] = field(default_factory=list)

    @property
    def floor(self) -> int:
        """The least score that could still come in."""
        return max(1, -self.rows[-1][0]) if len(self.rows) == self.k else 1

    def offer(self, scores: np.ndarray, docs: np.ndarray, keys: list) -> None:
        fits = scores >= self.floor
        scores, docs = scores[fits], docs[fits]
        if len(scores) > self.k:
            fits = scores >= np.partition(scores, -self.k)[-self.k]
            scores, docs = scores[fits], docs[fits]
        found = [(-s, keys[d] is None, keys[d]) for s, d in zip(scores.tolist(), docs.tolist(), strict=True)]
        if found:
            # A null key meets only other nulls in the last place.
            self.rows = sorted(self.rows + found, key=lambda r: (r[0], r[1], 0 if r[1] else r[2]))[: self.k]


def search(block: Block, terms: np.ndarray, weight: np.ndarray, best: Best, keys: list) -> int:
    """Offer the block's documents to ``best``; returns how many windows were visited."""
    lists = block.places(terms)
    if not len(lists):
        return 0
    w = weight[block.present[lists]]
    length = block.end[lists] - block.begin[lists]
    short = length < SHORT * block.docs
    # Term at a time: one list of sums, with its bounds.
    sums = np.zeros(block.docs, np.int64)
    for x, at in zip(w[short].tolist(), lists[short].tolist(), strict=True):
        some = slice(block.begin[at], block.end[at])
        sums[block.doc[some]] += x * block.impact[some]
    windows = -(-block.docs // WINDOW)
    edges = np.arange(0, block.docs, WINDOW)
    sum_most = np.maximum.reduceat(sums, edges)
    long = [(x, slice(block.runs[at], block.runs[at + 1])) for x, at in zip(w[~short].tolist(), lists[~short].tolist(), strict=True)]
    long_most = np.zeros((len(long), windows), np.int64)
    begins = np.zeros((len(long), windows), np.int64)
    ends = np.zeros((len(long), windows), np.int64)
    for row, (x, runs) in enumerate(long):
        at = block.run_window[runs]
        long_most[row, at] = x * block.run_most[runs]
        begins[row, at] = block.run_begin[runs]
        ends[row, at] = block.run_begin[runs.start + 1 : runs.stop + 1]
    alone = long_most.sum(0)
    visited = 0
    # Document at a time, in windows; bounds below the floor are passed over.
    ahead = np.flatnonzero(sum_most + alone >= best.floor)
    for v in ahead.tolist():
        floor = best.floor
        if sum_most[v] + alone[v] < floor:
            continue
        visited += 1
        first = v * WINDOW
        here = sums[first : first + WINDOW]
        if alone[v] >= floor:
            scores = here.copy()
            for row, (x, _) in enumerate(long):
                some = slice(begins[row, v], ends[row, v])
                scores[block.doc[some] - first] += x * block.impact[some]
            docs = np.arange(first, first + len(scores))
        else:
            docs = first + np.flatnonzero((here > 0) & (here + alone[v] >= floor))
            scores, rest = sums[docs], alone[v]
            for row in np.argsort(-long_most[:, v], kind="stable").tolist():
                if not len(docs) or not long_most[row, v]:
                    break
                x, low, high = long[row][0], begins[row, v], ends[row, v]
                at = low + np.searchsorted(block.doc[low:high], docs)
                hit = at < high
                hit[hit] = block.doc[at[hit]] == docs[hit]
                scores[hit] += x * block.impact[at[hit]]
                rest -= long_most[row, v]
                fits = scores + rest >= floor
                docs, scores = docs[fits], scores[fits]
        best.offer(scores, docs, keys)
    return visited


def blocks(batches: Iterator[pa.RecordBatch], total: tuple[int, int], limits: tuple[int, int]) -> Iterator[tuple[Block, list]]:
    """Blocks of counted rows, and the keys of their documents; ``limits`` of documents and postings."""

    def made(parts: list) -> tuple[Block, list]:
        keys = [k for p in parts for k in p[0]]
        return Block(*[np.concatenate([p[i] for p in parts]) for i in (2, 3, 4, 1)], total), keys

    most_docs, most_postings = limits
    parts, docs, postings = [], 0, 0
    for batch in batches:
        ends = batch.column(2).offsets.to_numpy().astype(np.int64)
        start = 0
        while start < batch.num_rows:
            most = int(np.searchsorted(ends, ends[start] + most_postings - postings, "right")) - 1
            stop = min(batch.num_rows, max(start + 1, most), start + max(1, most_docs - docs))
            some = batch.slice(start, stop - start)
            at = slice(ends[start], ends[stop])
            flat = [batch.column(c).values.to_numpy(zero_copy_only=False)[at].astype(np.int64) for c in (2, 3)]
            parts.append((some.column(0).to_pylist(), some.column(1).to_numpy(), flat[0], flat[1], np.diff(ends[start : stop + 1])))
            docs, postings, start = docs + stop - start, postings + int(ends[stop] - ends[start]), stop
            if docs >= most_docs or postings >= most_postings:
                yield made(parts)
                parts, docs, postings = [], 0, 0
    if parts:
        yield made(parts)


def answers(
    rows: DataFrame, key: str, queries: Queries, weight: np.ndarray, total: tuple[int, int], k: int, limits: tuple[int, int]
) -> DataFrame:
    """query (place in the set), key, score: of each task the k best per query."""
    declared, own = common.key_field(rows, key)
    schema = pa.schema([("query", pa.int32()), own, ("score", pa.int64())])
    sent = rows.sparkSession.sparkContext.broadcast((queries.of, weight))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, weights = sent.value
        best = [Best(k) for _ in of]
        for block, keys in blocks(batches, total, limits):
            for terms, kept in zip(of, best, strict=True):
                search(block, terms, weights, kept, keys)
        found = [(i, key, -score) for i, b in enumerate(best) for score, _, key in b.rows]
        columns = list(zip(*found, strict=True)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return rows.select(key, "n", "terms", "tfs").mapInArrow(run, f"query int, {declared}, score bigint")


def top_documents(
    docs: DataFrame,
    queries: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    name: str = "item_id",
    query_text: str = "text",
    k: int = K,
    set_chars: int = SET_CHARS,
    limits: tuple[int, int] = (BLOCK_DOCS, BLOCK_POSTINGS),
) -> DataFrame:
    """Per query its k documents of the highest score above 0: name, rank, key, score.

    Equal scores rank by key, a null key last.  A null or empty text has no term: as a
    document it counts nowhere, as a query it has no answer.  Rows of ``queries`` with one
    name (null too) are one query; rows of ``docs`` are documents each, repeated
    ones and ones with equal keys too.  Texts are counted whole, a bounded part at
    a time.  An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    kind = queries.schema[name]
    out = None
    for some in query_sets(queries, name, query_text, set_chars):
        rows = counted(docs, key, text, some.vocabulary)
        n, words = rows.agg(F.count("*"), F.sum("n")).first()
        # As many rows as the set has terms.
        seen = rows.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).collect()
        weight = np.zeros(len(some.vocabulary), np.int64)
        for t, df in seen:
            weight[t] = math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))
        found = answers(rows, key, some, weight, (n, words or 1), k, limits)
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last(key))
        ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        names = spark.createDataFrame(list(enumerate(some.names)), f"query int, name {kind.dataType.simpleString()}")
        ranked = ranked.join(names, "query").select(F.col("name").alias(name), "rank", F.col(key), "score")
        out = ranked if out is None else out.unionByName(ranked)
    if out is None:
        key_kind = docs.schema[key].dataType.simpleString()
        return spark.createDataFrame([], f"`{name}` {kind.dataType.simpleString()}, rank int, `{key}` {key_kind}, score bigint")
    return out


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_documents(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


SQL = r"""
WITH lowered AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
),
docs AS (SELECT r, doc_id, len(terms)::BIGINT AS n, terms FROM lowered WHERE len(terms) > 0),
totals AS (SELECT count(*) AS total, sum(n)::BIGINT AS words FROM docs),
tfs AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM docs) GROUP BY r, term),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
),
weights AS (
  SELECT term, floor(1000 * ln((2 * total + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM tfs CROSS JOIN totals WHERE term IN (SELECT term FROM asked) GROUP BY term, total
),
scored AS (
  SELECT a.item_id, d.r, d.doc_id,
    sum(w.w * ((1000000000 * t.tf) // (1000 * t.tf + 8 * (100 - 90 + (90 * d.n * total) // words))))::BIGINT AS score
  FROM asked a JOIN weights w ON w.term = a.term JOIN tfs t ON t.term = a.term JOIN docs d ON d.r = t.r CROSS JOIN totals
  GROUP BY a.item_id, d.r, d.doc_id
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0
) WHERE rank <= 10
"""
