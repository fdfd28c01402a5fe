"""Packing: whole, gapless, within capacity, close to the lower bound."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

from qirtas.llm import packing
from qirtas.llm.words import tokenizer
from tests.llm.test_token_counts import COMPOSING

PATH = public_tokenizers.path("word_bpe_49k.json")


def check_whole(rows, capacity):
    sequences, docs = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        docs[r.doc_id].append((r.start, r.length, r.doc_tokens))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return sequences, docs


@pytest.mark.parametrize("seed", range(4))
def test_places(seed):
    rng = np.random.default_rng(seed)
    sizes = np.sort(rng.choice(np.arange(1, 65), 20, replace=False))
    demand = rng.integers(1, 3000, 20)
    table = packing.places(sizes, demand, 64)
    ranks = np.arange(demand.sum())
    at = table[np.searchsorted(table[:, 0], ranks, "right") - 1]
    sequence = at[:, 1] + (ranks - at[:, 0]) // at[:, 2]
    np.testing.assert_array_less(np.bincount(sequence, np.repeat(sizes, demand)), 65)
    _, x = packing.solve(sizes, demand.astype(float), 64)
    assert len(set(sequence)) <= x.sum() + len(sizes)


def test_linear_program_is_optimal():
    # Widths 3, 5, 6, 9 on rolls of 10: the optimum is known to be integral here.
    sizes, demand = np.array([3, 5, 6, 9]), np.array([90.0, 120, 60, 30])
    patterns, x = packing.solve(sizes, demand, 10)
    assert (patterns @ sizes <= 10).all() and (patterns.T @ x >= demand - 1e-6).all()
    # 30 rolls for 9; 60 for 6 with 3; 60 for pairs of 5; the other 30 of 3 by threes.
    assert 160 - 1e-6 <= x.sum() <= 160 + packing.GAP_SEQUENCES


def test_edge_rows(spark):
    rows = [(1, "a b c"), (1, "a b c"), (2, None), (3, ""), (None, "x"), (4, "word " * 100), (5, "same " * 32)]
    df = spark.createDataFrame([(*r, "e") for r in rows], "doc_id long, text string, start string")
    got = packing.pack(df, PATH, capacity=32).collect()
    sequences, docs = check_whole(got, 32)
    assert sum(r.length for r in got) == 4 + 4 + 1 + 1 + 2 + 101 + 33
    assert sorted(docs[4])[-1] == (96, 5, 101)
    assert packing.pack(df.limit(0), PATH).count() == 0


def test_query(spark, small):
    got = packing.op6_packing(spark, small).collect()
    sequences, docs = check_whole(got, 2048)
    by_doc = defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
    for d in spark.read.parquet(f"{small}/documents.parquet").collect():
        ids = np.asarray([*tokenizer(PATH).encode(d.text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(by_doc[d.doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    used = sum(r.length for r in got)
    assert used / (2048 * len(sequences)) > 0.97


def test_capitals_that_compose(spark):
    df = spark.createDataFrame([(k, f"A{c}r Be") for k, c in enumerate(COMPOSING)], "doc_id long, text string")
    got = {r.doc_id: (r.length, r.ids_crc32) for r in packing.pack(df, PATH, capacity=64).collect()}
    for k, c in enumerate(COMPOSING):
        ids = np.asarray([*tokenizer(PATH).encode(f"A{c}r Be", add_special_tokens=False).ids, 1], "<u4")
        assert got[k] == (len(ids), zlib.crc32(ids.tobytes()))
