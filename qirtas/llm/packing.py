"""Packs token sequences by cutting-stock column generation.

Documents are cut into full pieces and one remainder; the piece lengths, in
units of ``UNIT`` tokens, form a histogram of at most 256 classes.  On it a linear
program chooses how often each filling pattern is used: the simplex method starts
from one pattern per class and a knapsack dynamic program prices new ones.  The
rounded patterns give numbered places per class, and the pieces, ranked within
their class, take them.  Only the histogram reaches the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from qirtas.llm import common
from qirtas.llm.words import word_ids
from qirtas.operators.skew import running_totals
from qirtas.storage import materialize

CAPACITY = 2_048
END_ID = 1
UNIT = 8
MAX_PIVOTS = 5_000
# The program is solved when it is proven this close to its optimum.
GAP, GAP_SEQUENCES = 1e-4, 0.5


def cut_pieces(
    df: DataFrame, path: str, key: str = "doc_id", text: str = "text",
    capacity: int = CAPACITY, end_id: int = END_ID,
) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens.

    Every text, a null or empty one too, has at least the end id.
    """
    column, field = common.key_field(df, key)
    names = ["start", "length", "ids_crc32", "doc_tokens"]
    schema = pa.schema([field, *[(n, pa.int64()) for n in names]])
    end = np.asarray([end_id], "<u4").tobytes()

    def work(columns: list[list]) -> list[list]:
        out: list[list] = [[], [], [], [], []]
        for k, blob in zip(columns[0], word_ids(path).blobs(columns[1]), strict=True):
            ids = memoryview(blob + end)
            total = len(ids) // 4
            for start in range(0, total, capacity):
                length = min(capacity, total - start)
                crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                for column_values, value in zip(out, (k, start, length, crc, total), strict=True):
                    column_values.append(value)
        return out

    declared = ", ".join([column, *[f"{n} long" for n in names]])
    return common.map_rows(df.select(key, text), work, declared, schema)


def best_pattern(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Knapsack with repetition: the pattern of greatest value that fits."""
    best, taken = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        fits = np.flatnonzero(sizes <= c)
        if len(fits):
            total = best[c - sizes[fits]] + values[fits]
            k = int(np.argmax(total))
            if total[k] > best[c] + 1e-12:
                best[c], taken[c] = total[k], fits[k]
    pattern, c = np.zeros(len(sizes)), capacity
    while c > 0:
        if taken[c] < 0:
            c -= 1
        else:
            pattern[taken[c]] += 1
            c -= sizes[taken[c]]
    return float(best[capacity]), pattern


def solve(sizes: np.ndarray, demand: np.ndarray, capacity: int, max_pivots: int = MAX_PIVOTS):
    """Patterns (rows) and their fractional numbers, least in sum and covering ``demand``.

    Revised simplex on the columns met so far; a column is a pattern (cost 1) or
    the surplus of a class (cost 0).  Tiny distinct additions to the demand keep
    ties from making the method turn in circles.  Its prices divided by the best
    pattern's value are feasible for the dual program and so bound the optimum
    from below; near that bound it ends.  Ending early still gives a cover.
    """
    m = len(sizes)
    demand = demand + 1e-4 * (1 + np.arange(m) * 0.618 % 1)
    columns = np.diag((capacity // sizes).astype(float))
    cost = np.ones(m)
    inverse = np.diag(1.0 / np.diag(columns))
    x = demand * np.diag(inverse)
    for _ in range(max_pivots):
        price = (cost[:, None] * inverse).sum(0)
        k = int(np.argmin(price))
        if price[k] < -1e-9:
            column, own_cost = np.zeros(m), 0.0
            column[k] = -1
        else:
            value, column = best_pattern(sizes, np.maximum(price, 0), capacity)
            own_cost = 1.0
            bound = demand @ np.maximum(price, 0) / max(value, 1.0)
            if cost @ x - bound <= max(GAP_SEQUENCES, GAP * bound) or value <= 1 + 1e-7:
                break
        step = (inverse * column).sum(1)
        rising = step > 1e-9
        if not rising.any():
            break
        ratio = np.full(m, np.inf)
        ratio[rising] = np.maximum(x[rising], 0) / step[rising]
        out = int(np.argmin(ratio))
        columns[:, out], cost[out] = column, own_cost
        row = inverse[out] / step[out]
        inverse -= np.outer(step, row)
        inverse[out] = row
        share = ratio[out]
        x -= share * step
        x[out] = share
    kept = (cost > 0) & (x > 1e-9)
    return columns[:, kept].T.astype(int), x[kept]


def rounded(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Whole numbers of patterns that hold exactly ``demand``.

    Fractions are rounded down and the rest is solved again; what no whole
    pattern holds any more, less than one sequence for each class and pattern,
    goes first-fit by falling size.
    """
    left, chosen = demand.copy(), []
    while True:
        open_ = np.flatnonzero(left)
        if not len(open_):
            break
        found = 0
        patterns, numbers = solve(sizes[open_], left[open_].astype(float), capacity)
        for part, number in zip(patterns, np.floor(numbers + 1e-3).astype(np.int64), strict=True):
            pattern = np.zeros(len(sizes), np.int64)
            pattern[open_] = part
            used = pattern > 0
            number = int(min(number, np.min(left[used] // pattern[used])))
            if number > 0:
                chosen.append((pattern, number))
                left -= number * pattern
                found += number
        if not found:
            break
    bins: list[tuple[int, np.ndarray]] = []
    for k in np.argsort(-sizes):
        for _ in range(left[k]):
            at = next((i for i, (free, _) in enumerate(bins) if free >= sizes[k]), None)
            if at is None:
                bins.append((capacity, np.zeros(len(sizes), int)))
                at = len(bins) - 1
            free, pattern = bins[at]
            pattern[k] += 1
            bins[at] = (free - int(sizes[k]), pattern)
    return chosen + [(pattern, 1) for _, pattern in bins]


def places(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> np.ndarray:
    """Rows (first rank, first sequence, pieces per sequence), by rank.

    Ranks count the pieces of all classes, smaller classes first.
    """
    class_start = np.concatenate([[0], np.cumsum(demand)[:-1]]).astype(np.int64)
    rows, sequence = [], 0
    for pattern, number in rounded(sizes, demand, capacity):
        for k in np.flatnonzero(pattern):
            rows.append((class_start[k], sequence, pattern[k]))
            class_start[k] += number * pattern[k]
        sequence += number
    return np.array(sorted(rows), np.int64).reshape(-1, 3)


def pack(
    df: DataFrame, path: str, key: str = "doc_id", text: str = "text",
    capacity: int = CAPACITY, end_id: int = END_ID, unit: int = UNIT,
) -> DataFrame:
    """One row per piece with its sequence_id and its offset there.

    Columns: key, start, length, ids_crc32, doc_tokens, sequence_id, offset.
    Repeated rows are packed each; a null key is a key like any other; no input
    rows give no pieces.  A sequence holds at most ``capacity`` tokens, so the
    window over its pieces is bounded.  Ranks come from a range partitioning, so
    a length that a third of all pieces share is spread over many tasks.
    """
    if capacity % unit:
        raise ValueError("unit must divide capacity")
    size = F.ceil(F.col("length") / unit).cast("int")
    pieces = materialize(
        cut_pieces(df, path, key, text, capacity, end_id)
        .withColumn("_size", size)
        .withColumn("_rank_by", F.struct("_size", key, "start", F.monotonically_increasing_id())),
        "pieces",
    )
    if pieces.isEmpty():
        return pieces.drop("_size", "_rank_by").withColumns(
            {"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}
        )
    histogram = sorted(tuple(r) for r in pieces.groupBy("_size").count().collect())
    sizes = np.array([s for s, _ in histogram], np.int64)
    demand = np.array([n for _, n in histogram], np.int64)
    table = places(sizes, demand, capacity // unit)
    ranked = running_totals(pieces.withColumn("_one", F.lit(1)), "_rank_by", ["_one"]).select(
        key, "start", "length", "ids_crc32", "doc_tokens", F.col("_one_before").alias("_rank")
    )
    column, field = common.key_field(df, key)
    names = ["start", "length", "ids_crc32", "doc_tokens", "_rank", "sequence_id"]
    schema = pa.schema([field, *[(n, pa.int64()) for n in names]])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column(5).to_numpy()
            at = table[np.searchsorted(table[:, 0], rank, "right") - 1]
            sequence = at[:, 1] + (rank - at[:, 0]) // at[:, 2]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sequence)], schema=schema)

    assigned = ranked.withColumn("_rank", F.col("_rank").cast("long")).mapInArrow(
        assign, ", ".join([column, *[f"{n} long" for n in names]])
    )
    before = (
        Window.partitionBy("sequence_id")
        .orderBy(F.desc("_rank"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offset = F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long")
    return assigned.withColumn("offset", offset).drop("_rank")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return pack(common.table(spark, sf_dir, "documents"), path)
