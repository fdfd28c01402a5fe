"""Batches that go to Python."""

import pyarrow as pa

from qirtas.llm import common


def test_batches_are_bounded_by_bytes(spark):
    rows = spark.range(8000).selectExpr("repeat('x', 3000) as text").coalesce(1)
    sizes = lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"]) for b in batches)
    found = [r.n for r in common.map_batches(rows, sizes, "n long").collect()]
    assert sum(found) >= 24_000_000 and max(found) <= common.BATCH_BYTES + 10_000
