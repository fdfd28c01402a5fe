"""The join against brute force over all pairs."""

import random

import numpy as np
import pytest

from qirtas.llm import ngram_join as nj
from qirtas.llm.components import components


def plain_sets(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    w = min(5, len(words))
    return frozenset(tuple(words[i : i + w]) for i in range(len(words) - w + 1))


def brute(rows):
    """doc -> (set size, smallest reachable id), by all pairs."""
    sets = {i: plain_sets(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            a, b = sets[i], sets[j]
            if a and b and 4 * min(len(a), len(b)) >= 3 * max(len(a), len(b)) and 100 * len(a & b) >= 75 * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def edited(rng, words, rate):
    return [rng.choice("abcdefghijkl") + str(rng.randint(0, 99)) if rng.random() < rate else w for w in words]


def planted(seed, n=260):
    rng = random.Random(seed)
    line = [f"line{i}" for i in range(14)]
    out = []
    for _ in range(12):
        base = [f"w{rng.randint(0, 4000)}" for _ in range(rng.choice([3, 8, 30, 90, 200]))]
        for _ in range(n // 13):
            body = edited(rng, base, rng.choice([0, 0.005, 0.02, 0.04, 0.06]))
            out.append(" ".join((line if rng.random() < 0.6 else []) + body))
    out += [" ".join(line)] * 3 + ["", " \n", "One two", "one TWO", "one two three four five", "ÉCOLE école x y z"]
    rng.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("seed, tile", [(1, 1000), (2, 7)])
def test_planted(spark, seed, tile):
    rows = planted(seed)
    df = spark.createDataFrame([(*r, "clash", 0) for r in rows], "doc_id long, text string, cid string, n int")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in nj.near_duplicates(df, tile=tile).collect()}
    assert got == brute(rows)
    assert len(set(c for _, c in got.values())) < 0.8 * len(rows)


def test_one_large_group(spark):
    rng = random.Random(9)
    base = [f"w{i}" for i in range(70)]
    rows = [(i, " ".join(edited(rng, base, rng.choice([0.0, 0.02, 0.05, 0.08])))) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in nj.near_duplicates(df, tile=50).collect()} == brute(rows)


def test_no_table_of_pairs(spark, monkeypatch):
    """Two groups that nearly link: what is written on the way grows with the rows, not with their pairs."""
    base = [f"w{i}" for i in range(100)]
    other = [f"v{i}" if i in (20, 45, 70) else w for i, w in enumerate(base)]
    rows = [(i, " ".join([*(base if i % 2 else other), f"end{i}"])) for i in range(600)]
    written = []

    def recorded(df, name, plain=nj.materialize):
        out = plain(df, name)
        written.append((out.count(), name))
        return out

    monkeypatch.setattr(nj, "materialize", recorded)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in nj.near_duplicates(df).collect()} == brute(rows)
    assert max(written)[0] < 40 * len(rows), max(written)


def test_edge_rows(spark):
    long = " ".join(f"x{i % 7000}" for i in range(20_000))
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (3, "A  b c d e\tf"), (None, "a b c d e f"), (None, None), (9, None), (9, None), (4, ""), (8, long), (7, long + " end"), (None, "q r s")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(str, (tuple(r) for r in nj.near_duplicates(df).collect())))
    assert got == sorted(map(str, [(5, 2, 3), (5, 2, 3), (3, 2, 3), (None, 2, 3), (None, 0, None), (9, 0, 9), (9, 0, 9), (4, 0, 4), (8, 7000, 7), (7, 7001, 7), (None, 1, None)]))
    kept = nj.one_of_each(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [3, 4, 7, 9]
    assert nj.near_duplicates(df.limit(0)).count() == 0


def test_query(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in nj.op3_ngram_join(spark, small).collect()} == brute(rows)


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, k) for k in range(1001, 1100)] + [(2001, 2000), (2000, 2001)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parts = [range(301), range(1000, 1100), range(2000, 2002)]
    assert len(got) == sum(map(len, parts))
    assert [len({got[i] for i in part}) for part in parts] == [1, 1, 1]
    assert len(set(got.values())) == 3


def brute_links(rows):
    """All pairs of different sets at the threshold."""
    sets = sorted({s for _, t in rows if (s := plain_sets(t))}, key=sorted)
    return {(a, b) for k, a in enumerate(sets) for b in sets[:k] if 100 * len(a & b) >= 75 * len(a | b)}


@pytest.mark.parametrize("tile", [1000, 7])
def test_every_link_is_counted(spark, tile):
    rng = random.Random(4)
    base = [f"w{i}" for i in range(70)]
    rows = [(i, " ".join(edited(rng, base, rng.choice([0.0, 0.02, 0.05, 0.08])))) for i in range(150)]
    rows += [(1000 + i, t) for i, t in planted(3, 100)]
    pairs = brute_links(rows)
    n_links = {i: sum(plain_sets(t) in p for p in pairs) for i, t in rows}
    df = spark.createDataFrame([(*r, "clash", 0) for r in rows], "doc_id long, text string, cid string, n_links int")
    got = nj.near_duplicate_links(df, tile=tile).collect()
    assert {r.doc_id: r.n_links for r in got} == n_links and len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows)
    docs, found = nj.join(df, tile=tile)
    of = {r.doc_id: r.cid for r in docs.collect()}
    texts = {plain_sets(t): of[i] for i, t in rows}
    listed = [tuple(r) for r in found.collect()]
    assert sorted(listed) == sorted((min(texts[a], texts[b]), max(texts[a], texts[b])) for a, b in pairs)


def test_overlaps():
    rng = np.random.default_rng(2)
    for n, m, top in ((1, 1, 5), (40, 30, 60), (300, 200, 5000)):
        left, right = ([np.unique(rng.integers(0, top, rng.integers(0, 50))) for _ in range(k)] for k in (n, m))
        want = [[len(np.intersect1d(x, y)) for y in right] for x in left]
        assert nj.overlaps(left, right).tolist() == want


def test_one_of_each_keeps_null_and_repeated_ids(spark):
    a, near, other = ("x " + " ".join(f"{c}{i}" for i in range(60)) for c in "aab")
    rows = [(None, a), (2, near + " end"), (None, other), (None, "q r s"), (None, "q r s"), (None, "t u v"), (None, None), (None, ""), (9, None), (9, None),
            (5, "one two three"), (5, "four five six"), (5, "four five six"), (7, "ONE two three"), (None, "l m n"), (None, "L  m n")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, cid string")
    kept = nj.one_of_each(df)
    got = sorted(map(str, [(r.doc_id, r.text) for r in kept.collect()]))
    once = [g for g in got if "m n" not in g]
    assert once == sorted(map(str, [(2, near + " end"), (None, other), (None, "q r s"), (None, "t u v"), (None, None), (None, ""), (9, None), (5, "one two three"), (5, "four five six")]))
    assert len(got) == len(once) + 1 and kept.columns == df.columns


def test_each_order_rejects_pairs_that_the_others_let_through():
    """Sets around 80 common tokens: no pair that links fails, and each prefix filter has its own say."""
    rng = np.random.default_rng(12)
    base = rng.integers(0, 1 << 63, 80, np.uint64)
    sets = []
    for k in range(150):
        common, alone = (rng.integers(72, 81), rng.integers(0, 5)) if k % 3 == 0 else (rng.integers(8, 80), rng.integers(2, 60))
        own = np.concatenate([rng.permutation(base)[:common], rng.integers(0, 1 << 63, alone, np.uint64)])
        sets.append(np.unique(own))
    facts = [nj.describe(x, 75) for x in sets]
    tile = {n: np.array([f[k] for f in facts], np.int64) for k, n in ((0, "n"), (3, "low"), (4, "edge2"), (5, "edge3"))}
    tile |= {"tokens": [x.view(np.int64) for x in sets], "below": [np.zeros(0, np.int64)] * len(sets)}
    both = nj.overlaps(tile["tokens"], tile["tokens"])
    links = 100 * both >= 75 * (np.add.outer(tile["n"], tile["n"]) - both)
    np.fill_diagonal(links, False)
    kept = nj.candidates_of(tile, tile, True, 75)
    assert links.any() and not (links & ~kept).any()
    by = [nj.overlaps(p(tile), p(tile)) > 0 for p in (nj.hash_prefix, nj.second_prefix)]
    fits = nj.not_yet_met(tile, tile, True, 75)
    assert (fits & by[0] & ~by[1]).any() and (fits & by[1] & ~by[0]).any()
    assert not (links & ~(by[0] & by[1])).any()
