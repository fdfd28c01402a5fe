"""Merkle manifest: SQL, a plain tree in Python, and the edges."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from qirtas.llm import merkle
from qirtas.storage import materialize
from tests.llm.sql import assert_same

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, branch string, leaf int, `my col` int"


def test_query(spark, small):
    assert_same(merkle.op11_merkle_manifest(spark, small), merkle.SQL, small)


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]])


def tree(nodes, fanout):
    """Root, and for each node its (left, right) siblings upwards."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + fanout] for i in range(0, len(nodes), fanout)]
        for path, i in zip(paths, at, strict=True):
            run, slot = runs[i // fanout], i % fanout
            path.append(("".join(run[:slot]), "".join(run[slot + 1 :])))
        nodes, at = [sha(*run) for run in runs], [i // fanout for i in at]
    return nodes[0], paths


def brute(rows, fanout):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    parts = {x: sorted((r for r in rows if r[2] == x), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for x in langs}
    done = {x: tree([leaf(r) for r in parts[x]], fanout) for x in langs}
    root, tops = tree([done[x][0] for x in langs], fanout)
    out = []
    for x, top in zip(langs, tops, strict=True):
        for r, path in zip(parts[x], done[x][1], strict=True):
            path = path + top
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None
            h = leaf((*r[:3], r[3] + 1, r[4])) if hit else leaf(r)
            for left, right in path:
                h = sha(left, h, right)
            out.append((r[0], leaf(r), done[x][0], root, sha(*[a + b for a, b in path]), h, h == root))
    return sorted(out, key=str)


def rows_of(n):
    langs = ["en"] * 5 + ["de", None, "", "é"]
    rows = [(i, f"s{i % 3}", langs[i % 9] if i % 4 else "en", i * 7 if i % 5 else None, f"text {i}") for i in range(n)]
    rows += [rows[3], (3, "s", "en", 1, "other text, same key"), (None, None, None, None, None), (None, "", "en", 0, "")]
    rows += [(n + 5, "s", "alone", 3, "x" * 300_000), (n + 6, "ü:1", "12:-", 3, "é\n")]
    return [(*r, "b", 1, 2) for r in rows]


@pytest.mark.parametrize("fanout,levels,n", [(2, 8, 40), (2, 2, 70), (3, 1, 30)])
def test_equals_plain_tree(spark, fanout, levels, n):
    rows = rows_of(n)
    docs = spark.createDataFrame(rows, SCHEMA)
    hit = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    leaves = materialize(merkle.leaves_of(docs, "doc_id", "lang", list(merkle.FIELDS), "n_chars", hit), "leaves")
    proofs = merkle.build(leaves, ["doc_id"], fanout, levels).proofs()
    got = proofs.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")),
        merkle.folded(F.coalesce("changed", "leaf"), F.col("path")).alias("h"), (F.col("h") == F.col("root")),
    )
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, fanout)


def test_tampering_is_found_and_nothing_else(spark):
    got = merkle.verified(spark.createDataFrame(rows_of(60), SCHEMA)).collect()
    hit = {i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 0 and i % 5}
    assert {r["doc_id"] for r in got if not r["verified"]} - {65, 66} == hit


@pytest.mark.parametrize("rows", [[], [(1, "s", "en", 2, "t")], [(1, "s", "en", 2, "t"), (2, "s", "de", 2, "t")]])
def test_few_rows(spark, rows):
    rows = [(*r, "b", 1, 2) for r in rows]
    got = merkle.verified(spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(tuple, got.collect()), key=str) == (brute(rows, 2) if rows else [])
