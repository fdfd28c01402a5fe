"""The feed-forward network by its written weights: blocked matrix products over sparse rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.sql import DataFrame

# Rows of a block, and the bytes of weights that may be broadcast.
BLOCK_ROWS = 256
MAX_BYTES = 256 << 20


def layers_of(model: Model) -> list[tuple[np.ndarray, np.ndarray]]:
    """(inputs x outputs, bias) of each layer, from the flat vector: weights column by column of outputs x inputs."""
    sizes, flat, at = model.getLayers(), model.weights.toArray(), 0
    out = []
    for n, m in zip(sizes[:-1], sizes[1:], strict=True):
        out.append((flat[at : at + n * m].reshape(n, m), flat[at + n * m : at + n * m + m]))
        at += n * m + m
    return out


def forward(block: np.ndarray, layers: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Class probabilities: logistic layers, the last one normalised."""
    for weights, bias in layers[:-1]:
        block = 1 / (1 + np.exp(-(block @ weights + bias)))
    weights, bias = layers[-1]
    last = block @ weights + bias
    grown = np.exp(last - last.max(1, keepdims=True))
    return grown / grown.sum(1, keepdims=True)


def probabilities(vectors: DataFrame, key: str, model: Model) -> DataFrame:
    """key, probabilities of sparse rows (key, slots, values); the weights' size is fixed by the layers and checked."""
    layers = layers_of(model)
    size = sum(w.nbytes + b.nbytes for w, b in layers)
    if size > MAX_BYTES:
        raise ValueError(f"{size} bytes of weights; {MAX_BYTES} may be broadcast")
    sent = vectors.sparkSession.sparkContext.broadcast(layers)
    kind = vectors.schema[key].dataType.simpleString()
    inputs = layers[0][0].shape[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                block = np.zeros((part.num_rows, inputs))
                slots, values = part.column(1), part.column(2)
                sizes = np.diff(slots.offsets.to_numpy())
                row = np.repeat(np.arange(part.num_rows), sizes)
                block[row, slots.flatten().to_numpy()] = values.flatten().to_numpy()
                found = forward(block, sent.value)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found.tolist(), pa.list_(pa.float64()))], ["key", "p"])

    result = vectors.select(key, "slots", "values").mapInArrow(run, f"`{key}` {kind}, probabilities array<double>")
    return result
