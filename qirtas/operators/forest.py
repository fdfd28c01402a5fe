"""Forests as node tables: votes by walking the trees with joins, importances from gains."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qirtas.operators.models import save_model
from qirtas.storage import fresh_path, materialize


def node_table(model: Model, like: DataFrame) -> DataFrame:
    """tree, node, slot, threshold, left, right, stats, gain: the nodes as the model's own writer puts them down.

    A leaf has the slot -1.  As many rows as the model has nodes, however much data it saw.
    """
    path = fresh_path(like.sparkSession, "forest")
    save_model(model, path)
    node = F.col("nodeData")
    return like.sparkSession.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        node["id"].alias("node"),
        node["split"]["featureIndex"].alias("slot"),
        F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
        node["leftChild"].alias("left"),
        node["rightChild"].alias("right"),
        node["impurityStats"].alias("stats"),
        node["gain"].alias("gain"),
    )


def votes(values: DataFrame, keys: DataFrame, key: str, nodes: DataFrame, depth: int) -> DataFrame:
    """key, votes: per class the sum over the trees of the shares in the leaf that a row reaches.

    ``values`` are long rows (key, slot, value) of written tables, zeros left out; ``keys``
    are unique.  Level by level: the node of each (row, tree), its slot's value by an
    equi-join, the child.  Only slots that some node asks for take part.
    """
    asked = nodes.filter("slot >= 0").select("slot").distinct()
    known = materialize(values.join(F.broadcast(asked), "slot").select(key, "slot", "value"), "asked-values")
    trees = nodes.filter("node = 0").select("tree")
    at = keys.select(key).crossJoin(F.broadcast(trees)).withColumn("node", F.lit(0))
    steps = F.broadcast(nodes.select("tree", "node", "slot", "threshold", "left", "right"))
    for _ in range(depth):
        met = at.join(steps, ["tree", "node"]).join(known, [key, "slot"], "left")
        goes_left = F.coalesce("value", F.lit(0.0)) <= F.col("threshold")
        child = F.when(F.col("slot") < 0, F.col("node")).when(goes_left, F.col("left")).otherwise(F.col("right"))
        at = met.select(key, "tree", child.alias("node"))
    total = F.aggregate("stats", F.lit(0.0), lambda a, x: a + x)
    leaves = nodes.select("tree", "node", F.posexplode(F.transform("stats", lambda x: x / total)).alias("class", "share"))
    classes = nodes.agg(F.max(F.size("stats"))).first()[0]
    counted = at.join(F.broadcast(leaves), ["tree", "node"]).groupBy(key)
    sums = [F.sum(F.when(F.col("class") == k, F.col("share")).otherwise(0.0)) for k in range(classes)]
    return counted.agg(F.array(*sums).alias("votes"))


def importances(nodes: DataFrame) -> DataFrame:
    """slot, importance: gains times rows of the nodes that split on it; one per tree, then one in all."""
    weight = F.col("gain") * F.aggregate("stats", F.lit(0.0), lambda a, x: a + x)
    gains = nodes.filter("slot >= 0").groupBy("tree", "slot").agg(F.sum(weight).alias("gained"))
    trees = gains.groupBy("tree").agg(F.sum("gained").alias("of_tree"))
    share = F.try_divide("gained", "of_tree")
    slots = gains.join(trees, "tree").filter("of_tree > 0").groupBy("slot").agg(F.sum(share).alias("share"))
    whole = slots.agg(F.sum("share").alias("whole"))
    return slots.crossJoin(F.broadcast(whole)).select("slot", (F.col("share") / F.col("whole")).alias("importance"))
