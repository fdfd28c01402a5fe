"""SimHash: plain fingerprints, all pairs within two bits, crowded buckets."""

import itertools
import random
import re

import numpy as np
import pytest
import xxhash

from qirtas.llm import common, simhash


def plain_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(r.encode(), seed=42).intdigest() for r in runs]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def plain(fps):
    """Smallest key reachable for rows (key, fp); a null is the last choice."""
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(fps)), 2):
        if (fps[i][1] ^ fps[j][1]).bit_count() <= 2:
            parent[find(i)] = find(j)
    groups = {}
    for i, (k, _) in enumerate(fps):
        groups.setdefault(find(i), []).append(k)
    return [min((k for k in groups[find(i)] if k is not None), default=None) for i in range(len(fps))]


def check(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string, fp int, fingerprint string")
    got = simhash.near_duplicates(df, **options).collect()
    fps = [(r[0], plain_fingerprint(r[1])) for r in rows]
    want = [(k, f"{fp:016x}", c) for (k, fp), c in zip(fps, plain(fps), strict=True)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def texts(n, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeß", k=rng.randint(1, 6))) for _ in range(400)]
    out = []
    while len(out) < n:
        base = rng.choices(words, k=rng.choice([0, 1, 2, 3, 5, 40, 300]))
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, 2) if base else 0):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append(rng.choice([" ", "\n", "\t "]).join(copy).replace("a", rng.choice("aA")))
    return out[:n]


@pytest.mark.parametrize("crowded", [2, 3, 1000])
def test_equals_plain(spark, crowded):
    rows = [(i, t, 1, "x") for i, t in enumerate(texts(150, 5))]
    rows += [(None, None, 1, "x"), (None, "", 1, "x"), (3, " \n", 1, "x"), (900, "Ä B ÄÖ\x85c d", 1, "x"), rows[0], rows[1]]
    check(spark, rows, crowded=crowded)


def test_no_rows_and_one(spark):
    check(spark, [])
    check(spark, [(None, "one two three four", 1, "x")])


def test_long_text_in_pieces(monkeypatch):
    text = " ".join(texts(60, 9)) + " \x0b " + "w" * 500
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(common.word_lists, "__defaults__", (64,))
    assert simhash.fingerprint(text) == whole == simhash.signed(plain_fingerprint(text))


def test_every_pair_within_the_radius_meets():
    masks = simhash.masks()
    assert len(masks) == 7 and all(m.bit_count() in (36, 37) for m in masks)
    for i, j in itertools.combinations_with_replacement(range(64), 2):
        assert any(not m & (1 << i | 1 << j) for m in masks)


@pytest.mark.parametrize("crowded", [2, 32])
def test_crowded_bucket_keeps_every_component(spark, crowded):
    """Hundreds of fingerprints in one bucket, chains by single and double flips."""
    rng = np.random.default_rng(3)
    hidden = [i for i in range(64) if not simhash.masks()[0] >> i & 1]
    base, fps = 0x0123456789ABCDEF, set()
    for _ in range(300):
        x = base
        for i in rng.choice(hidden, rng.integers(0, 6), replace=False):
            x ^= 1 << int(i)
        fps.add(x)
    fps |= {int(x) for x in rng.integers(0, 1 << 63, 50)}
    rows = sorted(fps)
    df = spark.createDataFrame([(simhash.signed(x),) for x in rows], "fp long")
    found = simhash.links(df, crowded).collect()
    mask = (1 << 64) - 1
    assert all(((a & mask) ^ (b & mask)).bit_count() <= 2 for a, b in found)
    parent = {x: x for x in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in found:
        parent[find(a & mask)] = find(b & mask)
    own = {}
    for x in rows:
        own.setdefault(find(x), []).append(rows.index(x))
    want = plain(list(enumerate(rows)))
    assert {i: min(g) for g in own.values() for i in g} == dict(enumerate(want))


def test_query(spark, small):
    rows = common.table(spark, small, "documents").select("doc_id", "text").collect()
    fps = [(r[0], plain_fingerprint(r[1])) for r in rows]
    want = [(k, f"{fp:016x}", c) for (k, fp), c in zip(fps, plain(fps), strict=True)]
    assert sorted(map(tuple, simhash.op13_simhash(spark, small).collect())) == sorted(want)
