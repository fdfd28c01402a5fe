"""Small helpers that the operators of this folder share."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

# Rows, and about so many bytes of text, that are Python objects at the same time.
SLICE_ROWS = 512
SLICE_BYTES = 16 << 20
# About so many bytes of rows go to a Python worker at a time, unless the session says otherwise.
BATCH_BYTES = 4 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
# About so many bytes of a text are split into words at a time.
PIECE_BYTES = 1 << 20
BLANK = re.compile(rb"[\x20\x09-\x0D]")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(
    batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS, size: int = SLICE_BYTES
) -> Iterator[list[list]]:
    """The columns of each batch as Python lists, a bounded number of rows and bytes at a time.

    A row is never cut: one that is longer than ``size`` comes alone.
    """
    for batch in batches:
        texts = [c for c in batch.columns if pa.types.is_string(c.type) or pa.types.is_binary(c.type)]
        sizes = [pc.fill_null(pc.binary_length(c), 0).to_numpy(zero_copy_only=False) for c in texts]
        ends = np.cumsum(np.sum(sizes, axis=0)) if sizes else np.zeros(batch.num_rows, np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            fits = int(np.searchsorted(ends, before + size, "right"))
            end = min(start + rows, max(start + 1, fits), batch.num_rows)
            yield [column.to_pylist() for column in batch.slice(start, end - start).columns]
            start = end


def word_lists(data: bytes, size: int = PIECE_BYTES) -> Iterator[list[bytes]]:
    """The words between ASCII white space, in order, a bounded number at a time; a word is never cut."""
    start = 0
    while start < len(data):
        end = start + size
        if end < len(data):
            rest = BLANK.search(data, end)
            end = rest.start() if rest else len(data)
        yield data[start:end].split()
        start = end


def give_back() -> None:
    """Returns memory that is free inside Arrow's pool and the C library to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def bound_batches(spark: SparkSession) -> None:
    """Bounds Arrow's batches by bytes too: ten thousand texts at once lie outside the heap, twice while a buffer grows."""
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def map_batches(
    df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType
) -> DataFrame:
    """``mapInArrow`` in bounded batches, and a task gives back the memory that it no longer needs.

    Python workers serve many tasks and stages; else each keeps its highest peak.
    """
    bound_batches(df.sparkSession)

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return df.mapInArrow(tidy, schema)


def map_rows(
    df: DataFrame, work: Callable[[list[list]], list[list]], schema: str, arrow: pa.Schema
) -> DataFrame:
    """``work`` turns the columns of a slice of rows into the columns of the result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in slices(batches):
            out = work(columns)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(out, arrow, strict=True)], schema=arrow
            )

    return map_batches(df, run, schema)


ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}


def key_field(df: DataFrame, key: str) -> tuple[str, tuple[str, pa.DataType]]:
    """A key column's declaration for Spark and for Arrow; any type that Arrow can carry."""
    kind = df.schema[key].dataType
    return f"{quoted(key)} {kind.simpleString()}", (key, to_arrow_type(kind))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it as long as a column of ``df`` has it (in whatever case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def fields_of(row: str, names: list[str]) -> list[Column]:
    """The fields of a struct column as columns, whatever their names."""
    return [F.col(f"{row}.{quoted(c)}").alias(c) for c in names]
