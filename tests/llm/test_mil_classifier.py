"""Gradients, held-out accuracy, attention, edge rows."""

import numpy as np
import pytest

from qirtas.llm import mil_classifier as mil

MIDDLE = "/root/testdata/sf0.01"


def test_gradient_is_the_slope():
    rng = np.random.default_rng(0)
    bags = [rng.normal(size=(n, mil.N_FEATURES)) for n in (1, 4, 2)]
    x, starts, y = np.concatenate(bags), np.array([0, 1, 5]), np.array([0.0, 1, 1])
    w = mil.fit_bags(bags, y, epochs=1).weights

    def loss(w):
        p = mil.forward(w, x, starts)["score"]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    for name, slope in mil.gradient(w, x, starts, y).items():
        for at in np.ndindex(*w[name].shape):
            up, down = ({k: v.copy() for k, v in w.items()} for _ in range(2))
            up[name][at] += 1e-5
            down[name][at] -= 1e-5
            assert (loss(up) - loss(down)) / 2e-5 == pytest.approx(slope[at], abs=1e-6)


def test_attention_finds_the_bad_passage():
    good = "The cat sat on the mat, and it was quiet there. " * 8
    bad = "BUY!! NOW!! FREE!! " * 30
    texts = [good * 3] * 40 + [good + bad + good] * 40 + [good] * 20 + [bad] * 20
    y = np.array([1] * 40 + [0] * 40 + [1] * 20 + [0] * 20)
    model = mil.fit_bags([mil.passages(t) for t in texts], y)
    assert model.scores([mil.passages(good * 9), mil.passages(good * 2 + bad)]).round().tolist() == [1, 0]


def test_edge_rows(spark):
    rows = [(1, None), (1, None), (2, ""), (None, "text"), (3, "word " * 30000), (4, "ok then."), (5, "\x00é")]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, score double")
    for labels in ([], [(1, 1), (1, None)], [(i, i % 2) for i in range(6)] + [(None, 1), (2, 1)]):
        frame = spark.createDataFrame(labels, "doc_id long, quality int")
        got = mil.score(docs, mil.fit(docs, frame)).collect()
        assert [r.doc_id for r in got] == [r[0] for r in rows]
        assert all(0 <= r._score <= 1 for r in got) and got[0]._score == got[2]._score
    assert mil.score(docs.limit(0), mil.fit(docs.limit(0), frame)).count() == 0


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in mil.op4_mil_classifier(spark, MIDDLE).collect()}
    assert len(got) == spark.read.parquet(f"{MIDDLE}/documents.parquet").count()
    labels = [r for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect() if got[r.doc_id].held_out]
    s, y = np.array([got[r.doc_id].score for r in labels]), np.array([r.quality for r in labels])
    auc = np.mean(s[y == 1][:, None] > s[y == 0]) + 0.5 * np.mean(s[y == 1][:, None] == s[y == 0])
    assert auc > 0.95 and np.mean((s >= 0.5) == y) > 0.93
    import zlib

    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())


def test_fit_reads_whole_documents_once(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(mil, "fit_bags", lambda bags, labels: seen.append((bags, labels)))
    ids = [i for i in range(40) if __import__("zlib").crc32(str(i).encode()) % 3 != 1]
    long, *rest = ids
    texts = {long: " ".join(f"w{k}" for k in range(64 * 500))} | {i: f"word{i} " * (70 + i) for i in rest}
    rows = [*texts.items(), *[(rest[0], texts[rest[0]])] * 20]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in texts], "doc_id long, quality int")
    mil.fit(docs, labels)
    mil.fit(docs, labels, sample_docs=40, fit_passages=10)
    (bags, y), (fewer, _) = seen
    assert [len(b) for b in bags] == [len(mil.passages(texts[i])) for i in ids] and y.tolist() == [i % 2 for i in ids]
    assert [len(b) for b in fewer] == [len(mil.passages(texts[i])) for i in rest]
