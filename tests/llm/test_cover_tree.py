"""Cover-tree search against SQL and brute force."""

import math

import numpy as np
import pytest

from qirtas.llm import cover_tree as ct
from tests.llm.sql import assert_same


def test_query(spark, small):
    assert_same(ct.op10_cover_tree(spark, small), ct.SQL, small)


def clustered(rng, n, dim, spread):
    centres = rng.normal(0, 100, (6, dim))
    return np.floor(centres[rng.integers(0, 6, n)] + rng.normal(0, spread, (n, dim))).astype(np.int64)


@pytest.mark.parametrize("spread", [0, 1, 60])
def test_trees(spread):
    rng = np.random.default_rng(3)
    x, q = clustered(rng, 900, 8, spread), clustered(rng, 70, 8, spread)
    data, queries = ct.CoverTree(np.arange(900), x.copy(), 32), ct.CoverTree(np.arange(70) + 5, q.copy(), 32)
    for tree in (data, queries):
        for b, e, r, kids in zip(tree.begin, tree.end, tree.radius, tree.children, strict=True):
            d = np.sqrt(((tree.x[b:e] - tree.x[b]) ** 2).sum(1))
            assert d.max() <= r + 1e-9
            assert not kids or sum(tree.end[c] - tree.begin[c] for c in kids) == e - b
    best = ct.Best(70, 5)
    met = ct.search(queries, data, best)
    for at, number in enumerate(queries.ids):
        scores = q[number - 5] @ x.T
        want = sorted((-int(s), i) for i, s in enumerate(scores) if i != number)[:5]
        assert best.of(at) == [(-s, i) for s, i in want]
    if spread == 1:
        assert met < 0.6 * len(data.begin) * len(queries.begin)


def test_edge_rows(spark):
    nan, inf = math.nan, math.inf
    rows = [(0, [1.0, 0.5]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (2, [0.5, 0.5]), (3, None), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [1.0, inf]),
            (7, [1.0, 2.0, 3.0]), (8, [-1.0, 0.003]), (50, [0.25, -0.25]), (None, [1.0, 1.0]), (100, [9.0] * 3), (150, []), (151, [])]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "vec_id long, embedding array<float>, score string")
    got = sorted(map(tuple, ct.top_k(df, k=3, data_block=2, query_block=1, pivots=2).collect()))
    assert got == [
        (0, 1, 1, 256 * 128 + 128 * 128), (0, 2, 2, 256 * 128 + 128 * 128), (0, 3, 50, 256 * 64 - 128 * 64),
        (50, 1, 0, 64 * 256 - 64 * 128), (50, 2, 1, 0), (50, 3, 2, 0),
        (100, 1, 7, 2304 * 256 * 6), (150, 1, 151, 0),
    ]
    assert ct.top_k(df.limit(0)).count() == 0


def test_a_third_is_one_vector(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [0.5, 0.25, 0.0, 0.1] if i % 3 == 0 else rng.normal(0, 0.2, 4).tolist()) for i in range(900)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in ct.top_k(df, data_block=64, query_block=4).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    ints = np.floor(np.array([r[1] for r in rows], np.float32).astype(float) * 256).astype(np.int64)
    for q in range(0, 900, 50):
        want = sorted(((-int(s), i) for i, s in enumerate(ints @ ints[q]) if i != q))[:5]
        assert sorted(got[q]) == [(k + 1, i, -s) for k, (s, i) in enumerate(want)]


def test_different_vectors_of_one_key(spark):
    rng = np.random.default_rng(8)
    rows = [(int(i), rng.normal(0, 0.3, 4).tolist()) for i in rng.integers(0, 120, 500)]
    rows += [(50, [3.0, 0.0, 0.0, 0.0]), (50, [0.01, 0.0, 0.0, 0.0]), (50, [0.01, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in ct.top_k(df, data_block=64, query_block=4, pivots=3).collect())
    whole = {(i, tuple(np.floor(np.array(v, np.float32).astype(float) * 256).astype(int).tolist())) for i, v in rows}
    want = []
    for q in (0, 50, 100):
        scores = sorted((-sum(a * b for a, b in zip(v, x, strict=True)), i) for j, v in whole if j == q for i, x in whole if i != q)[:5]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scores)]
    assert got == want


def test_huge_components_take_part(spark):
    """Beyond what doubles multiply exactly, beyond 64 bits, and the largest doubles there are."""
    rows = [(0, [1e15, 1.0]), (1, [3.0, -1.0]), (2, [1e-3, 5.0]), (3, [-1e300, 1.0]), (4, [1.7e308, 0.0]), (5, [2e9, 0.1]), (50, [0.5, 0.25]), (6, [-0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, ct.top_k(df, k=7, data_block=3, query_block=1, pivots=3).collect()))

    def ints(v):
        return [int(min(max(c, -1e300), 1e300)) * 256 if abs(c) > 1e15 else math.floor(256 * c) for c in v]

    want = []
    for q in (0, 50):
        products = [(i, sum(a * b for a, b in zip(ints(dict(rows)[q]), ints(v), strict=True))) for i, v in rows if i != q]
        clipped = sorted((-max(min(p, 2**63 - 1), -(2**63) + 1), i) for i, p in products)
        want += [(q, n, i, -s) for n, (s, i) in enumerate(clipped, 1)]
    assert got == want
