"""Joins and running totals that stay whole and balanced under skew."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from qirtas.storage import materialize

# At most this many lookup rows are broadcast, each with a key of at most
# HOT_KEY_CHARS characters: a fixed bound that does not grow with the data.
HOT_ROWS = 200_000
HOT_KEY_CHARS = 64


def join_lookup(
    facts: DataFrame, lookup: DataFrame, key: str, weight: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``facts`` joined to ``lookup`` (unique ``key``; ``weight`` = its rows in facts).

    Both are read several times, so pass written tables.
    The heaviest keys are broadcast, so their rows never move.  What is left is
    shuffled; there no short key has more than a ``2 / hot_rows`` share of the
    facts, and adaptive execution splits what a very long key may still pile up.

    The cutoff is the smallest power of two that at most ``hot_rows`` keys reach.
    It comes from a histogram of the weights by bit length, which has a fixed
    number of rows; a sorted top-n would pass through one task.
    """
    short = F.length(key) <= HOT_KEY_CHARS
    bits = F.length(F.bin(F.col(weight).cast("long")))
    histogram = lookup.groupBy(short.alias("short"), bits.alias("bits")).count().collect()
    keys = sum(row["count"] for row in histogram)
    by_bits = {row["bits"]: row["count"] for row in histogram if row["short"]}
    cutoff, size = 1 << 62, 0
    for n in range(62, 0, -1):
        if size + by_bits.get(n, 0) > hot_rows:
            break
        cutoff, size = 1 << (n - 1), size + by_bits.get(n, 0)
    hot = lookup.filter(short & (F.col(weight) >= cutoff))
    mapped = facts.join(F.broadcast(hot), key)
    if size == keys:
        return mapped
    cold_lookup = lookup.filter(~short | (F.col(weight) < cutoff))
    cold_facts = facts.join(F.broadcast(hot.select(key)), key, "left_anti")
    return mapped.unionByName(cold_facts.join(cold_lookup, key))


def running_totals(df: DataFrame, order: str, values: list[str], by: str | None = None) -> DataFrame:
    """Exclusive running sums over a global order with distinct ``order`` values, or one order for each ``by``.

    A window without partitions (or with one for each of a few groups) would pull
    all rows into few tasks.  Here the rows are range-partitioned and written;
    totals per range and group give each range its offset, and the window runs
    inside a range.
    """
    groups = [by] if by else []
    ranged = materialize(
        df.repartitionByRange(*groups, order).withColumn("_range", F.spark_partition_id()), "ranges"
    )
    # One row per shuffle partition and group in it.
    before = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(*groups, "_range")
        .agg(*[F.sum(v).alias(f"_{v}") for v in values])
        .select(
            *groups,
            "_range",
            *[F.coalesce(F.sum(f"_{v}").over(before), F.lit(0)).alias(f"_{v}") for v in values],
        )
    )
    inside = (
        Window.partitionBy(*groups, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    )
    # Without groups the offsets are as many as the ranges, a fixed bound; with groups Spark decides.
    met = ranged.join(offsets if by else F.broadcast(offsets), [*groups, "_range"])
    return met.withColumns(
        {
            f"{v}_before": F.col(f"_{v}") + F.coalesce(F.sum(v).over(inside), F.lit(0))
            for v in values
        }
    ).drop("_range", *[f"_{v}" for v in values])


def first_in_order(df: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` rows with the smallest (md5 of key, key), numbered from 0 as ``id``; for any ``n``.

    A sort with a limit holds ``n`` rows in one task, and a window over them too.
    Here the rows are counted by the first four digits of the digest (65,536 counts at
    most), what lies beyond the n-th goes, and ranges of the rest are numbered by
    offsets, as ``running_totals`` does.
    """
    digest = F.md5(F.col(key).cast("string"))
    head = F.coalesce(F.conv(F.substring(digest, 1, 4), 16, 10).cast("int"), F.lit(-1))
    last, seen = -2, 0
    for row in sorted(df.groupBy(head.alias("head")).count().collect()):
        if seen >= n:
            break
        last, seen = row["head"], seen + row["count"]
    near = df.filter(head <= last).withColumns({"_digest": digest})
    cut = near.repartitionByRange("_digest", key).sortWithinPartitions("_digest", key)
    cut = materialize(
        cut.drop("_digest").withColumns({"_range": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}), "ranges"
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    parts = cut.groupBy("_range").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    shift = (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift")
    # One row per shuffle partition: a fixed bound.
    rows = cut.join(F.broadcast(parts.select("_range", shift)), "_range")
    return rows.withColumn("id", F.col("_at") + F.col("_shift")).filter(F.col("id") < n).drop("_range", "_at", "_shift")
