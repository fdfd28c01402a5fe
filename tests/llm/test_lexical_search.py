"""Ranked lexical search: SQL, a plain scorer, and what the bounds may and may not skip."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from qirtas.llm import lexical_search as ls
from tests.llm.sql import assert_same

DOCS = "doc_id long, text string, score int, n int, terms string"
ITEMS = "item_id long, text string, rank int"


def test_query(spark, small):
    assert_same(ls.op12_lexical_search(spark, small), ls.SQL, small)


def words(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", text)


def plain(docs, items, k):
    counted = [(i, Counter(words(t))) for i, t in docs if words(t)]
    n, total = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(words(t))
    out = []
    for item, terms in asked.items():
        scored = []
        for i, c in counted:
            m = 100 - 90 + (90 * c.total() * n) // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms if c[t]
            )
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def corpus(n, seed):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "Straße", "é́", "x1"] + [f"w{i}" for i in range(300)]
    def text():
        picks = [vocabulary[min(int(rng.expovariate(0.03)), 304)] for _ in range(rng.randint(0, 60))]
        return rng.choice([" ", ", ", "\n", "-"]).join(picks).replace("w1", rng.choice(["w1", "W1"]))
    docs = [(i, text()) for i in range(n)]
    docs += [(None, docs[3][1]), (None, None), (5, "other text of key five the w7 w8"), docs[9], docs[9], (n, ""), (n + 1, "the " * 40)]
    items = [(i, " ".join(rng.sample(vocabulary, rng.randint(1, 12)))) for i in range(25)]
    items += [(3, "w9 w200"), (None, "the w4"), (None, "w5"), (90, None), (91, ""), (92, "nowhere else"), (93, docs[3][1]), items[0]]
    return docs, items


@pytest.mark.parametrize("k,set_chars,limits", [(10, 1 << 20, (1 << 14, 1 << 20)), (2, 200, (50, 1 << 20)), (3, 1 << 20, (1000, 99))])
def test_equals_plain(spark, k, set_chars, limits):
    docs, items = corpus(400, 11)
    rows = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in docs], DOCS).repartition(3)
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], ITEMS)
    got = ls.top_documents(rows, asked, k=k, set_chars=set_chars, limits=limits)
    assert sorted(map(tuple, got.collect()), key=str) == plain(docs, items, k)


def test_empty_tables(spark):
    docs, items = corpus(20, 1)
    rows = spark.createDataFrame([(*d, 1, 2, "x") for d in docs], DOCS)
    asked = spark.createDataFrame([(*i, 1) for i in items], ITEMS)
    assert ls.top_documents(rows.limit(0), asked).count() == 0
    none = ls.top_documents(rows, asked.limit(0))
    assert none.count() == 0 and none.columns == ["item_id", "rank", "doc_id", "score"]
    assert ls.top_documents(rows, asked.filter("item_id in (90, 91)")).count() == 0


def posting_block(rng, docs, terms):
    sizes, flat, tfs = [], [], []
    for _ in range(docs):
        own = np.flatnonzero(rng.random(terms) < np.geomspace(0.9, 0.001, terms))
        sizes.append(len(own))
        flat.append(own)
        tfs.append(rng.integers(1, 5, len(own)))
    lengths = np.array([t.sum() + 1 for t in tfs], np.int64)
    return np.concatenate(flat), np.concatenate(tfs), np.array(sizes), lengths


def test_blocks_are_exact_and_skip():
    """All scores by matrices; the search skips windows once better documents are known."""
    rng = np.random.default_rng(2)
    docs, terms = 6000, 60
    flat, tfs, sizes, lengths = posting_block(rng, docs, terms)
    block = ls.Block(flat, tfs, sizes, lengths, (docs, int(lengths.sum())))
    m = 10 + (90 * lengths * docs) // int(lengths.sum())
    owner = np.repeat(np.arange(docs), sizes)
    weight = rng.integers(0, 9000, terms)
    for asked in (np.arange(terms), np.array([0, 1, 2]), np.array([50, 59]), np.array([0, 40, 55]), np.array([7, 70])):
        dense = np.zeros(docs, np.int64)
        mask = np.isin(flat, asked)
        np.add.at(dense, owner[mask], (weight[flat[mask]]) * ((10**9 * tfs[mask]) // (1000 * tfs[mask] + 8 * m[owner[mask]])))
        best = ls.Best(10)
        windows = ls.search(block, asked, np.append(weight, np.zeros(20, np.int64)), best, list(range(docs)))
        want = [(-int(dense[i]), i) for i in np.lexsort((np.arange(docs), -dense))[:10] if dense[i] > 0]
        assert [(s, i) for s, _, i in best.rows] == want
        over = ls.Best(1, [(-int(dense.max()) - 1, False, -1)])
        again = ls.search(block, asked, np.append(weight, np.zeros(20, np.int64)), over, list(range(docs)))
        assert again <= windows and (asked[0] != 50 or again < windows) and len(over.rows) == 1
