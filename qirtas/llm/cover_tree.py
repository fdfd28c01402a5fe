"""Exact top-k inner products by a dual-tree search over cover trees.

Rows go to the nearest of a fixed number of pivots and from there into blocks of
bounded size, queries and data apart.  Each block is indexed as a cover tree: a
node has a centre, children whose balls are smaller, and the radius that covers
its points.  A query tree and a data tree are searched together; a pair of nodes
is pruned when not even their closest points could beat the worst kth score of
the queries in the node.  Whole blocks are pruned by the same bound before they
are sent to a query block.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from qirtas.llm import common
from qirtas.storage import materialize

PIVOTS = 16
DATA_BLOCK, QUERY_BLOCK = 1024, 128
# Leaves are large enough for one product of matrices to outweigh what a pair of nodes costs.
LEAF, CHILDREN, SHRINK = 128, 4, 1.3
# Tasks that share the data blocks of a query block.
PARTS = 16
SCALE = 256
LARGEST = 1e300  # components beyond count as this
NONE = np.iinfo(np.int64).min  # the score of an empty place


def finite(vector: str) -> Column:
    """The components as doubles; null if one is null or not finite."""
    x = F.col(vector)
    good = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.when(good, F.transform(x, lambda v: v.cast("double")))


def whole(x: np.ndarray) -> np.ndarray:
    """floor(256 x): whole numbers, exact in doubles however large."""
    return np.floor(np.clip(x, -LARGEST, LARGEST) * SCALE)


class CoverTree:
    """Points (rows of ``x``, reordered), their numbers, and nodes over ranges of them."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, leaf: int = LEAF):
        self.ids, self.x = ids, x
        self.begin, self.end, self.radius, self.children = [], [], [], []
        self.leaf = leaf
        if len(ids):
            self._build(0, len(ids))
        self.centre = self.x[np.array(self.begin, int)].astype(float)
        self.length = np.sqrt((self.centre**2).sum(1))
        far = np.sqrt((self.x.astype(float) ** 2).sum(1))
        self.longest = np.array([far[b:e].max() for b, e in zip(self.begin, self.end, strict=True)])

    def _build(self, begin: int, end: int) -> int:
        """A node over a range whose first point is its centre; returns its number."""
        part = self.x[begin:end].astype(float)
        far = np.sqrt(((part - part[0]) ** 2).sum(1))
        radius = float(far.max())
        me = len(self.begin)
        self.begin.append(begin)
        self.end.append(end)
        self.radius.append(radius)
        self.children.append([])
        if end - begin <= self.leaf or radius == 0 or not np.isfinite(radius):
            return me
        owner, near = np.zeros(len(part), int), far
        chosen = 1
        while chosen < CHILDREN and near.max() > radius / SHRINK or chosen < 2:
            new = int(np.argmax(near))
            to_new = np.sqrt(((part - part[new]) ** 2).sum(1))
            closer = to_new < near
            owner[closer], near = chosen, np.where(closer, to_new, near)
            chosen += 1
        # Members of a child together, its centre (at distance 0) first.
        order = np.lexsort((self.ids[begin:end], near, owner))
        self.x[begin:end], self.ids[begin:end] = self.x[begin:end][order], self.ids[begin:end][order]
        sizes = np.bincount(owner, minlength=chosen)
        at = begin
        for size in sizes[sizes > 0].tolist():
            self.children[me].append(self._build(at, at + size))
            at += size
        return me


def exact_products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers; by floating point only where that is exact.

    A product beyond 64 bits counts as the nearest number within them.
    """
    largest = max(np.abs(q).max(initial=0), 1) * max(np.abs(x).max(initial=0), 1) * max(q.shape[1], 1)
    if largest < 1 << 52:
        return (q.astype(float) @ x.T.astype(float)).astype(np.int64)
    exact = np.vectorize(int, otypes=[object])
    products = (exact(q) if q.size else q.astype(object)) @ (exact(x) if x.size else x.astype(object)).T
    return np.clip(products, NONE + 1, np.iinfo(np.int64).max).astype(np.int64)


class Best:
    """The k best (score, smaller id first) of each query so far, best first."""

    def __init__(self, n: int, k: int, floor: np.ndarray | None = None):
        self.scores = np.full((n, k), NONE)
        self.ids = np.full((n, k), np.iinfo(np.int64).max)
        self.floor = np.full(n, NONE) if floor is None else floor
        self.worst = self.floor.copy()

    def offer(self, begin: int, own: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Scores of the queries from ``begin`` on, whose ids are ``own``, with the rows ``ids``."""
        end = begin + len(own)
        fits = (scores >= self.worst[begin:end, None]) & (own[:, None] != ids[None])
        at, some = np.flatnonzero(fits.any(1)), np.flatnonzero(fits.any(0))
        if not len(at):
            return
        rows = begin + at
        new = np.where(fits[np.ix_(at, some)], scores[np.ix_(at, some)], NONE)
        both = np.concatenate([self.scores[rows], new], 1)
        names = np.concatenate([self.ids[rows], np.broadcast_to(ids[some], new.shape)], 1)
        order = np.lexsort((names, ~both), axis=1)[:, : self.scores.shape[1]]  # ~ turns the order around and cannot overflow
        self.scores[rows] = np.take_along_axis(both, order, 1)
        self.ids[rows] = np.take_along_axis(names, order, 1)
        self.worst[rows] = np.maximum(self.floor[rows], self.scores[rows, -1])

    def of(self, at: int) -> list[tuple[int, int]]:
        """(score, id) of a query, best first."""
        full = self.scores[at] != NONE
        return list(zip(self.scores[at][full].tolist(), self.ids[at][full].tolist(), strict=True))


def search(queries: CoverTree, data: CoverTree, best: Best) -> int:
    """Searches both trees together; returns how many pairs of nodes were met."""
    if not len(queries.ids) or not len(data.ids) or queries.x.shape[1] != data.x.shape[1]:
        return 0

    def bound(q: int, d: int) -> float:
        """No product of the nodes is larger: by the radii, and by how far their points are apart at least.

        A bound that is no number, from lengths beyond doubles, prunes nothing.
        """
        rq, rd = queries.radius[q], data.radius[d]
        apart = float(np.sqrt(((queries.centre[q] - data.centre[d]) ** 2).sum()))
        centre = float(queries.centre[q] @ data.centre[d])
        most = centre + queries.length[q] * rd + data.length[d] * rq + rq * rd
        square = queries.longest[q] ** 2 + data.longest[d] ** 2
        least = max(0.0, apart - rq - rd)
        return min(most, (square - least * least) / 2) + 1e-9 * (square + 1)

    met = 0
    stack = [(-bound(0, 0), 0, 0)]
    while stack:
        negative, q, d = heapq.heappop(stack)
        met += 1
        begin, end = queries.begin[q], queries.end[q]
        if -negative < best.worst[begin:end].min():
            continue
        cq, cd = queries.children[q], data.children[d]
        if cq and (not cd or queries.radius[q] >= data.radius[d]):
            pairs = [(c, d) for c in cq]
        elif cd:
            pairs = [(q, c) for c in cd]
        else:
            x, ids = data.x[data.begin[d] : data.end[d]], data.ids[data.begin[d] : data.end[d]]
            best.offer(begin, queries.ids[begin:end], exact_products(queries.x[begin:end], x), ids)
            continue
        for a, b in pairs:
            value = bound(a, b)
            if not value < best.worst[queries.begin[a] : queries.end[a]].min():
                heapq.heappush(stack, (-value, a, b))
    return met


def blocks(cells: DataFrame, size: int, name: str) -> DataFrame:
    """One written row per block: its tree, its centre, radius and number of points."""
    sizes = cells.groupBy("cell", "dim").agg(F.ceil(F.count("*") / size).alias("parts"))
    numbered = cells.join(F.broadcast(sizes), ["cell", "dim"]).withColumn(  # a row per pivot and length
        "block", F.struct("cell", "dim", F.expr("pmod(xxhash64(id, x), parts)").alias("part"))
    )

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        with np.errstate(over="ignore", invalid="ignore"):
            tree = CoverTree(pdf["id"].to_numpy().copy(), np.stack([np.frombuffer(v) for v in pdf["x"]]))
        facts = {"n": len(pdf), "dim": tree.x.shape[1], "radius": tree.radius[0], "longest": tree.longest[0]}
        return pd.DataFrame([facts | {"tree": pickle.dumps(tree, 5), "centre": tree.centre[0].tolist()}])[list(names)]

    names = {"dim": "long", "tree": "binary", "n": "long", "radius": "double", "longest": "double", "centre": "array<double>"}
    schema = ", ".join(f"{n} {t}" for n, t in names.items())
    found = numbered.select("block", "id", "x").groupBy("block").applyInPandas(build, schema)
    return materialize(found.withColumn("number", F.monotonically_increasing_id()), name)


def scored(pairs: DataFrame, k: int, floors: bool) -> DataFrame:
    """Best rows of each query block and part over the pairs named; a task meets one data tree at a time."""
    schema = pa.schema(
        [("q", pa.int64()), ("query_id", pa.int64()), ("rank", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, queries, best = None, None, None

        def result() -> pa.RecordBatch:
            rows = []
            for at, query in enumerate(queries.ids.tolist()):
                rows += [(number[0], query, rank, row, score) for rank, (score, row) in enumerate(best.of(at), 1)]
            values = list(zip(*rows, strict=True)) or [[]] * 5
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, schema, strict=True)], schema=schema)

        for q, part, query_tree, floor, data_tree in (r for some in common.slices(batches, 16) for r in zip(*some, strict=True)):
            if (q, part) != number:
                if number is not None:
                    yield result()
                number, queries = (q, part), pickle.loads(query_tree)
                # k rows of an id's one vector bound what its others may add.
                known: dict[int, int] = {}
                for f in floor or []:
                    known[f["query_id"]] = max(f["score"], known.get(f["query_id"], NONE))
                best = Best(len(queries.ids), k, np.array([known.get(int(i), NONE) for i in queries.ids], np.int64))
            with np.errstate(over="ignore", invalid="ignore"):
                search(queries, pickle.loads(data_tree), best)
        if number is not None:
            yield result()

    floor = F.col("floor") if floors else F.lit(None).cast("array<struct<query_id:bigint,score:bigint>>")
    ordered = pairs.withColumn("part", F.pmod("d", F.lit(PARTS)))
    ordered = ordered.repartition("q", "part").sortWithinPartitions("q", "part", F.desc("bound"))
    return ordered.select("q", "part", "query_tree", floor.alias("floor"), "data_tree").mapInArrow(
        run, "q long, query_id long, rank int, vec_id long, score long"
    )


def top_k(
    df: DataFrame, k: int = 5, key: str = "vec_id", vector: str = "embedding", every: int = 50,
    pivots: int = PIVOTS, data_block: int = DATA_BLOCK, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows of every query.

    Queries are the rows whose key ``every`` divides.  Vectors that are null, hold a
    null or a number that is not finite, and rows without a key take no part; empty
    vectors do, with products of 0.  Vectors of unlike length are not compared.
    Rows repeated as a whole count once; other rows of the query's own key are
    never its neighbours.  Different vectors of a query's key are one query: their
    scores are ranked together, k rows for the key.  Fewer than k candidates give fewer rows, an empty table none.
    Components beyond 1e300 count as 1e300, scores beyond 64 bits as the nearest number within them.

    The first round searches the data blocks of a query block's own pivot; their
    kth scores are floors that prune blocks and nodes of the second round.
    """
    usable = df.select(F.col(key).cast("long").alias("id"), finite(vector).alias("v")).filter(
        "id IS NOT NULL AND v IS NOT NULL"
    )
    chosen = [whole(np.array(r.v, float)) for r in usable.orderBy(F.xxhash64("id"), "id").limit(pivots).select("v").collect()]

    def nearest(columns: list[list]) -> list[list]:
        cells, dims, blobs = [], [], []
        with np.errstate(over="ignore", invalid="ignore"):
            for v in columns[1]:
                x = whole(np.array(v, float)) + 0.0  # no negative zero: equal vectors have equal bytes
                same = [(float(((x - p) ** 2).sum()), c) for c, p in enumerate(chosen) if len(p) == len(x)]
                cells.append(min(same)[1] if same else -1)
                dims.append(len(x))
                blobs.append(x.tobytes())
        return [columns[0], cells, dims, blobs]

    cells = common.map_rows(
        usable, nearest, "id long, cell int, dim int, x binary",
        pa.schema([("id", pa.int64()), ("cell", pa.int32()), ("dim", pa.int32()), ("x", pa.binary())]),
    )
    cells = materialize(cells.dropDuplicates(["id", "x"]), "cells")
    keep = ["number", "dim", "n", "radius", "longest", "centre", "tree"]
    data = blocks(cells, data_block, "data-blocks").select(*[F.col(c).alias(f"data_{c}") for c in keep])
    queries = blocks(cells.filter(F.col("id") % every == 0), query_block, "query-blocks").select(
        *[F.col(c).alias(f"query_{c}") for c in keep]
    )
    norm = lambda c: F.sqrt(F.aggregate(c, F.lit(0.0), lambda a, v: a + v * v))
    product = F.aggregate(F.zip_with("query_centre", "data_centre", lambda a, b: a * b), F.lit(0.0), lambda a, v: a + v)
    most = (
        product
        + norm("query_centre") * F.col("data_radius")
        + norm("data_centre") * F.col("query_radius")
        + F.col("query_radius") * F.col("data_radius")
    )
    # As in ``search``, of whole blocks.
    apart = F.aggregate(F.zip_with("query_centre", "data_centre", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, v: a + v)
    least = F.greatest(F.lit(0.0), F.sqrt(apart) - F.col("query_radius") - F.col("data_radius"))
    square = F.col("query_longest") * F.col("query_longest") + F.col("data_longest") * F.col("data_longest")
    bound = F.least(most, (square - least * least) / 2) + 1e-9 * (square + 1)
    # Blocks with blocks, by their summaries only; rows are not paired here.
    pairs = (
        queries.drop("query_tree")
        .join(data.drop("data_tree"), F.col("query_dim") == F.col("data_dim"))
        .select(
            F.col("query_number").alias("q"),
            F.col("data_number").alias("d"),
            bound.alias("bound"),
        )
    )
    pairs = materialize(pairs, "block-pairs")
    near = Window.partitionBy("q").orderBy(F.desc("bound"), "d")
    first = pairs.withColumn("_near", F.row_number().over(near)).filter("_near <= 2")
    trees = lambda p: p.join(data.select(F.col("data_number").alias("d"), "data_tree"), "d").join(
        queries.select(F.col("query_number").alias("q"), "query_tree"), "q"
    )
    kth = scored(trees(first), k, floors=False).filter(F.col("rank") == k).select("q", "query_id", "score")
    floors = kth.groupBy("q").agg(
        F.collect_list(F.struct("query_id", "score")).alias("floor"),
        F.min("score").alias("least"),
        F.countDistinct("query_id").alias("known"),
    )
    known = queries.select(F.col("query_number").alias("q"), "query_n").join(materialize(floors, "floors"), "q", "left")
    # A block with a query that has not met k rows yet keeps all its pairs.
    open_ = F.col("known").isNull() | (F.col("known") < F.col("query_n"))
    kept = pairs.join(known, "q").filter(open_ | (F.col("bound") >= F.col("least")))
    # The vectors of a key may lie in several blocks.
    of_key = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = scored(trees(kept), k, floors=True).drop("q", "rank")
    ranked = found.withColumn("rank", F.row_number().over(of_key)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op10_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(common.table(spark, sf_dir, "embeddings"))


SQL = f"""
WITH rows_ AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
    FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, x.vec_id AS vec_id,
    list_aggregate(list_transform(list_zip(q.v, x.v), lambda p: p[1] * p[2]), 'sum')::BIGINT AS score
    FROM rows_ q JOIN rows_ x ON q.vec_id % 50 = 0 AND q.vec_id != x.vec_id AND len(q.v) = len(x.v)),
ranked AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
    vec_id, score FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
