"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words.  Each passage is described by
shares of its characters and words and encoded by a learned layer; gated
attention, learned from document labels only, weighs the passages, and a linear
layer scores their weighted sum.  The fit reads a bounded sample of labelled rows;
scoring reads every whole text where it lies and moves no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qirtas.llm import common
from qirtas.storage import materialize

PASSAGE = 64
# The fit reads at most so many labelled documents, those with the smallest digests.
SAMPLE_DOCS = 6_000
# ... and of these, in that order, whole ones while they have so many passages for each document at most.
FIT_PASSAGES = 200
HIDDEN, ATTENTION, EPOCHS, BATCH, RATE, DECAY = 16, 12, 40, 256, 0.01, 1e-4

# Kinds of bytes; what a passage is described by counts them.
SPACES, LOWER, UPPER, DIGIT, SYMBOL, BAR, BANG, STOP, COMMA, OTHER, LETTER, TAIL, BREAK = range(13)
KINDS = np.full(256, OTHER, np.uint8)
for chars, kind in [
    (b" \t\x0b\x0c\r", SPACES), (b"\n", BREAK), (bytes(range(97, 123)), LOWER), (bytes(range(65, 91)), UPPER),
    (b"0123456789", DIGIT), (b"#*$%&<>@~^=_{}[]\\", SYMBOL), (b"|", BAR), (b"!", BANG), (b".?", STOP),
    (b",;:", COMMA), (bytes(range(0x80, 0xC0)), TAIL), (bytes(range(0xC0, 0x100)), LETTER),
]:
    KINDS[np.frombuffer(chars, np.uint8)] = kind
N_FEATURES = 17


def passages(text: str | None) -> np.ndarray:
    """A row of features per passage; an empty text has one passage of zeros."""
    raw = (text or "").encode()
    words = raw.split()
    n = len(words)
    if not n:
        return np.zeros((1, N_FEATURES), np.float32)
    data = np.frombuffer(raw, np.uint8)
    kinds = KINDS[data]
    blank = (kinds == SPACES) | (kinds == BREAK)
    begins = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
    firsts = begins[::PASSAGE]
    m = len(firsts)
    of = np.repeat(np.arange(m), np.diff([*firsts, len(data)]))
    counts = np.bincount(of * 13 + kinds[firsts[0] :], minlength=13 * m).reshape(m, 13).astype(float)

    number: dict[bytes, int] = {}
    code = np.full(m * PASSAGE, -1, np.int64)
    code[:n] = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    code[n:] = -1 - np.arange(m * PASSAGE - n)  # each filler differs
    size = np.full(m, PASSAGE, float)
    size[-1] = n - (m - 1) * PASSAGE
    rows = code.reshape(m, PASSAGE)
    again = (rows[:, 1:] == rows[:, :-1]).sum(1)
    ordered = np.sort(rows, axis=1)
    repeats = (ordered[:, 1:] == ordered[:, :-1]).sum(1)
    pairs = rows[:, :-1] * (len(number) + PASSAGE + 1) + rows[:, 1:]
    ordered = np.sort(pairs, axis=1)
    repeated_pairs = (ordered[:, 1:] == ordered[:, :-1]).sum(1)

    letters = counts[:, LOWER] + counts[:, UPPER] + counts[:, LETTER]
    chars = np.maximum(counts.sum(1) - counts[:, TAIL] - counts[:, SPACES] - counts[:, BREAK], 1)
    out = [
        np.log1p(size) / 4,
        np.minimum(chars / size / 10, 3),
        counts[:, UPPER] / np.maximum(letters, 1),
        counts[:, LETTER] / chars,
        10 * counts[:, DIGIT] / chars,
        np.minimum(counts[:, SYMBOL] / size, 3),
        np.minimum(4 * counts[:, BAR] / size, 4),
        np.minimum(2 * counts[:, BANG] / size, 4),
        np.minimum(5 * counts[:, STOP] / size, 5),
        np.minimum(5 * counts[:, COMMA] / size, 5),
        np.minimum(5 * counts[:, OTHER] / size, 5),
        letters / chars,
        np.minimum(5 * counts[:, BREAK] / size, 5),
        2 * again / size,
        repeats / size,
        2 * repeated_pairs / size,
        (size < 10).astype(float),
    ]
    return np.stack(out, 1).astype(np.float32)


@dataclass(frozen=True)
class Model:
    """Standardisation and weights; ``rate`` alone where only one class was seen."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]
    rate: float | None = None

    def scores(self, bags: list[np.ndarray]) -> np.ndarray:
        if self.rate is not None:
            return np.full(len(bags), self.rate)
        x = (np.concatenate(bags) - self.mean) / self.scale
        starts = np.cumsum([0, *[len(b) for b in bags[:-1]]])
        return forward(self.weights, x, starts)["score"]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def forward(w: dict[str, np.ndarray], x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
    """Scores of bags whose passages begin at ``starts``, and what the gradient needs."""
    sizes = np.diff([*starts, len(x)])
    h = np.tanh(x @ w["encode"] + w["encode_bias"])
    t, g = np.tanh(h @ w["attend"]), sigmoid(h @ w["gate"])
    energy = (t * g) @ w["attention"]
    energy = energy - np.repeat(np.maximum.reduceat(energy, starts), sizes)
    share = np.exp(energy)
    share /= np.repeat(np.add.reduceat(share, starts), sizes)
    z = np.add.reduceat(share[:, None] * h, starts)
    score = sigmoid(z @ w["out"] + w["out_bias"])
    return {"h": h, "t": t, "g": g, "share": share, "z": z, "score": score, "sizes": sizes}


def gradient(w, x, starts, y) -> dict[str, np.ndarray]:
    f = forward(w, x, starts)
    h, t, g, share, sizes = f["h"], f["t"], f["g"], f["share"], f["sizes"]
    d = (f["score"] - y) / len(y)
    out = {"out": f["z"].T @ d, "out_bias": np.array([d.sum()])}
    dz = np.repeat(d[:, None] * w["out"], sizes, axis=0)
    dh = share[:, None] * dz
    dshare = (dz * h).sum(1)
    denergy = share * (dshare - np.repeat(np.add.reduceat(share * dshare, starts), sizes))
    out["attention"] = (t * g).T @ denergy
    dtg = denergy[:, None] * w["attention"]
    dt, dg = dtg * g * (1 - t * t), dtg * t * g * (1 - g)
    out["attend"], out["gate"] = h.T @ dt, h.T @ dg
    dh += dt @ w["attend"].T + dg @ w["gate"].T
    dh *= 1 - h * h
    out["encode"], out["encode_bias"] = x.T @ dh, dh.sum(0)
    return out


def fit_bags(bags: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Model:
    """Adam on minibatches of whole bags; the same bags in the same order give one model."""
    labels = np.asarray(labels, float)
    if not len(labels) or labels.min() == labels.max():
        rate = float(labels[0]) * 0.98 + 0.01 if len(labels) else 0.5
        return Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), {}, rate)
    every = np.concatenate(bags)
    mean, scale = every.mean(0), every.std(0) + 1e-3
    bags = [(b - mean) / scale for b in bags]
    rng = np.random.default_rng(seed)
    shape = {"encode": (N_FEATURES, HIDDEN), "encode_bias": (HIDDEN,), "attend": (HIDDEN, ATTENTION), "gate": (HIDDEN, ATTENTION), "attention": (ATTENTION,), "out": (HIDDEN,), "out_bias": (1,)}
    w = {k: rng.normal(0, 0.3, s) if "bias" not in k else np.zeros(s) for k, s in shape.items()}
    first = {k: np.zeros(s) for k, s in shape.items()}
    second = {k: np.zeros(s) for k, s in shape.items()}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        rate = RATE * (0.5 + 0.5 * np.cos(np.pi * epoch / epochs))
        for start in range(0, len(bags), BATCH):
            batch = order[start : start + BATCH]
            x = np.concatenate([bags[k] for k in batch])
            starts = np.cumsum([0, *[len(bags[k]) for k in batch[:-1]]])
            step += 1
            for k, d in gradient(w, x, starts, labels[batch]).items():
                d = d + DECAY * w[k]
                first[k] = 0.9 * first[k] + 0.1 * d
                second[k] = 0.999 * second[k] + 0.001 * d * d
                m, v = first[k] / (1 - 0.9**step), second[k] / (1 - 0.999**step)
                w[k] = w[k] - rate * m / (np.sqrt(v) + 1e-8)
    return Model(mean, scale, w)


def remainder(key: str) -> Column:
    return F.crc32(F.col(key).cast("string").cast("binary")) % 3


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample_docs: int = SAMPLE_DOCS,
    fit_passages: int = FIT_PASSAGES,
) -> Model:
    """Learns from labelled rows whose crc32(key as text) mod 3 is not 1.

    At most ``sample_docs`` documents, those with the smallest digest of their key,
    each with all its passages; one with which the sample would have more than
    ``sample_docs * fit_passages`` of them is left out: a bounded sample, the only
    thing collected.  Rows without key or label say nothing; repeated labels are
    averaged, and of rows that share a key the text with the smallest digest counts.
    """
    chosen = (
        labels.filter((remainder(key) != 1) & F.col(label).isNotNull())
        .groupBy(F.col(key).alias("_id"))
        .agg(F.round(F.avg(label)).alias("_y"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(sample_docs)
    )
    rows = docs.join(F.broadcast(chosen), F.col(key) == F.col("_id")).select(
        F.col("_id").cast("long").alias("_id"), "_y", F.col(text).alias("_text"), F.xxhash64(text).alias("_digest")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, ys, texts, digests in common.slices(batches):
            bags = [passages(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()), pa.array(ys, pa.float64()), pa.array(digests, pa.int64()),
                    pa.array([len(b) for b in bags], pa.int64()), pa.array([b.tobytes() for b in bags], pa.binary()),
                ],
                ["id", "y", "digest", "n", "bag"],
            )

    bags = common.map_batches(rows, run, "id long, y double, digest long, n long, bag binary")
    best = F.min(F.struct("digest", "n", "y", "bag")).alias("best")
    bags = materialize(bags.groupBy("id").agg(best).select("id", "best.y", "best.n", "best.bag"), "fit-bags")
    left, whole = sample_docs * fit_passages, []
    for r in bags.select("id", "n").orderBy(F.xxhash64("id"), "id").collect():
        if r.n <= left:
            left -= r.n
            whole.append((r.id,))
    sample = docs.sparkSession.createDataFrame(whole, "id long")
    found = bags.join(F.broadcast(sample), "id").select("id", "y", "bag").collect()
    found.sort(key=lambda r: (r.id, bytes(r.bag)))
    bags = [np.frombuffer(r.bag, np.float32).reshape(-1, N_FEATURES) for r in found]
    return fit_bags(bags, np.array([r.y for r in found]))


def score(df: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None, into: str = "_score") -> DataFrame:
    """``keep`` columns (default: all, whatever their names) and ``into``; null and empty texts are scored too."""
    keep = df.columns if keep is None else keep
    rows = df.select(F.col(text).alias("_text"), F.struct(*[F.col(common.quoted(c)) for c in keep]).alias("_row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, common.SLICE_ROWS):
                part = batch.slice(start, common.SLICE_ROWS)
                scores = model.scores([passages(t) for t in part.column(0).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array(scores, pa.float64())], ["_row", "_score"])

    schema = T.StructType([T.StructField("_row", rows.schema["_row"].dataType), T.StructField("_score", T.DoubleType())])
    return common.map_batches(rows, run, schema).select(*common.fields_of("_row", keep), F.col("_score").alias(into))


def keep_good(docs: DataFrame, labels: DataFrame, min_score: float = 0.5) -> DataFrame:
    """The rows that the model, fitted on them and their labels, scores at least so high."""
    into = common.free_name(docs, "_score")
    return score(docs, fit(docs, labels), into=into).filter(F.col(into) >= min_score).drop(into)


def op4_mil_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    model = fit(docs, common.table(spark, sf_dir, "labels"))
    return score(docs, model, keep=["doc_id"]).select(
        "doc_id",
        F.coalesce(remainder("doc_id") == 1, F.lit(False)).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= 0.5).cast("int").alias("predicted"),
    )
