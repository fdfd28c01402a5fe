"""Connected components by contraction, with written tables between the rounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qirtas.storage import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b); one root per component.

    In each round a node joins the neighbour with the smallest random rank, or
    stays if its own is smaller, and the links between what is left go on.  The
    ranks change with the rounds, so long chains shrink by a constant factor too.
    Nothing is collected; a node with very many links is one row per task.
    """
    edges = materialize(links.select("a", "b").filter("a != b").distinct(), "links")
    roots, turn = None, 0
    while True:
        def rank(c: str, turn: int = turn) -> Column:
            return F.struct(F.xxhash64(F.lit(turn), c).alias("rank"), F.col(c).alias("node"))

        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        moves = both.groupBy("a").agg(F.least(F.min(rank("b")), F.first(rank("a"))).alias("best"))
        moves = materialize(moves.select(F.col("a").alias("node"), F.col("best.node").alias("to")), "moves")
        if roots is None:
            roots = moves.withColumnRenamed("to", "root")
        else:
            moved = roots.join(moves.withColumnRenamed("node", "root"), "root", "left")
            roots = moved.select("node", F.coalesce("to", "root").alias("root"))
        roots = materialize(roots, "roots")
        edges = (
            edges.join(moves.select(F.col("node").alias("a"), F.col("to").alias("to_a")), "a")
            .join(moves.select(F.col("node").alias("b"), F.col("to").alias("to_b")), "b")
            .select(F.col("to_a").alias("a"), F.col("to_b").alias("b"))
            .filter("a != b")
            .distinct()
        )
        edges = materialize(edges, "links")
        turn += 1
        if edges.isEmpty():
            return roots
