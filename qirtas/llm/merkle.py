"""Merkle manifest of a dataset: slot columns by conditional aggregates.

A node's place among its siblings is its slot.  Conditional aggregates spread the
children of a parent into one column per slot; all columns together, hashed, are
the parent, and all but a node's own column are its siblings.

Each branch (here: a language) is a tree over its leaves in order, and the branch
roots are the leaves of one more tree.  Trees are built in strips of LEVELS levels:
nodes are dealt once by block of ``FANOUT ** LEVELS`` neighbours, and every level of
the strip is aggregated where its rows are.  So a tree over n leaves moves its
leaves once, its blocks once, and so on, and no task holds more than its share
of blocks, however large a branch is.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from qirtas.llm import common
from qirtas.storage import materialize

FANOUT = 2
LEVELS = 8  # of a strip
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def framed(value: Column) -> Column:
    """``-`` for null, else the UTF-8 length, a colon and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf(values: list[Column]) -> Column:
    return digest(*[framed(v) for v in values])


def branch_name(group: str) -> Column:
    """``-`` for null, else ``:`` and the value: null comes first in the order of the bytes."""
    return F.coalesce(F.concat(F.lit(":"), F.col(group).cast("string")), F.lit("-"))


def placed(leaves: DataFrame, order: list[str]) -> DataFrame:
    """Add ``pos``, the place within ``branch`` from 0 by ``order``, and ``size`` of the branch.

    ``leaves`` is a written table.  It is cut into ranges of (branch, order); a row's
    place is its place in the range, and what the ranges before hold of its branch.
    """
    cut = leaves.repartitionByRange("branch", *order).sortWithinPartitions("branch", *order)
    cut = materialize(
        cut.withColumn("_range", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), "ranges"
    )
    parts = cut.groupBy("branch", "_range").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    # A row for each branch and for each range: of a branch at most as many as there are ranges.
    whole = Window.partitionBy("branch")
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        "branch",
        "_range",
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(whole).alias("size"),
    )
    offsets = materialize(offsets, "offsets")
    rows = cut.join(offsets, ["branch", "_range"]).withColumn("pos", F.col("_at") + F.col("_shift"))
    return materialize(rows.drop("_range", "_at", "_shift"), "placed")


def no_path() -> Column:
    return F.array().cast("array<struct<left:string,right:string>>")


def slots(node: str, slot: Column, fanout: int, over: Window | None = None) -> dict[str, Column]:
    """A column for each slot: the one child there, or null."""
    one = [F.max(F.when(slot == k, F.col(node))) for k in range(fanout)]
    return {f"_slot{k}": c.over(over) if over is not None else c for k, c in enumerate(one)}


def joined(first: int, last: int) -> Column:
    """The slots from ``first`` to before ``last`` in one text; slots without a child add nothing."""
    return F.concat_ws("", *[F.col(f"_slot{k}") for k in range(first, last)]) if last > first else F.lit("")


def block_tops(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """(branch, pos, size, node) of the next strip: the tops of the blocks of this one.

    Dealt by block once; each level's aggregation finds its rows already together.
    A branch that is down to one node stays as it is through the levels left.
    """
    rows = nodes.select("branch", "size", F.expr(f"pos div {fanout**levels}").alias("block"), "pos", "node")
    rows = rows.repartition("branch", "block")
    for level in range(levels):
        grown = rows.groupBy("branch", "size", "block", F.expr(f"pos div {fanout}").alias("pos")).agg(
            *[c.alias(n) for n, c in slots("node", F.col("pos") % fanout, fanout).items()]
        )
        parent = F.when(F.col("size") > fanout**level, digest(joined(0, fanout))).otherwise(F.col("_slot0"))
        rows = grown.select("branch", "size", "block", "pos", parent.alias("node"))
    size = F.expr(f"(size + {fanout**levels - 1}) div {fanout**levels}").alias("size")
    return rows.select("branch", F.col("block").alias("pos"), size, "node")


def strips(nodes: DataFrame, fanout: int, levels: int) -> list[DataFrame]:
    """Written tables (branch, pos, size, node), from the leaves up; in the last each branch is one node."""
    found = [nodes]
    while found[-1].filter("size > 1").limit(1).count():
        found.append(materialize(block_tops(found[-1], fanout, levels), "strip"))
    return found


def block_paths(rows: DataFrame, fanout: int, levels: int) -> DataFrame:
    """Add ``path``: (left, right) siblings of each level inside the block, upwards.

    ``rows`` have branch, size, block, pos, node.  The windows of the levels are the
    parents, from the block down; sorted once, every level finds its order.  A level
    above the branch's top has no entry.
    """
    digit = {k: f"_digit{k}" for k in range(levels)}
    rows = rows.withColumns({digit[k]: F.expr(f"pos div {fanout**k} % {fanout}") for k in range(levels)})
    rows = rows.withColumn("_up", F.col("node")).withColumn("path", no_path())
    for k in range(levels):
        parent = Window.partitionBy("branch", "block", *[digit[j] for j in range(levels - 1, k, -1)])
        own = F.col(digit[k])
        rows = rows.withColumns(slots("_up", own, fanout, parent))
        left, right = F.lit(""), F.lit("")
        for s in range(fanout):
            left = F.when(own == s, joined(0, s)).otherwise(left)
            right = F.when(own == s, joined(s + 1, fanout)).otherwise(right)
        exists = F.col("size") > fanout**k
        step = F.array(F.struct(left.alias("left"), right.alias("right")))
        rows = rows.withColumns(
            {
                "path": F.when(exists, F.concat("path", step)).otherwise(F.col("path")),
                "_up": F.when(exists, digest(joined(0, fanout))).otherwise(F.col("_slot0")),
            }
        )
    return rows.drop("_up", *digit.values(), *[f"_slot{k}" for k in range(fanout)])


def paths(found: list[DataFrame], ends: DataFrame, fanout: int, levels: int) -> DataFrame:
    """The rows of ``found[0]`` with ``path`` to the root, from the top strip down.

    ``ends`` has a row for each branch: its path above its top, and what all its rows
    get beside.  Rows are joined by block, so no task holds a branch.
    """
    beside = [c for c in ends.columns if c not in ("branch", "path")]
    above = ends.withColumn("pos", F.lit(0).cast("long"))
    for k in range(max(len(found) - 2, 0), -1, -1):
        within = levels if len(found) > 1 else 0
        higher = above.select("branch", F.col("pos").alias("block"), F.col("path").alias("_higher"), *beside)
        rows = found[k].withColumn("block", F.expr(f"pos div {fanout**within}"))
        rows = block_paths(rows.join(higher.hint("shuffle_merge"), ["branch", "block"]), fanout, within)
        above = rows.withColumn("path", F.concat("path", "_higher")).drop("_higher", "block")
        if k:
            above = materialize(above.select("branch", "pos", "path", *beside), "paths")
    return above


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, start, lambda h, s: digest(s["left"], h, s["right"]))


def proof_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


@dataclass
class Manifest:
    """Written tables: the strips of the branches, and of the tree over the branches."""

    strips: list[DataFrame]
    tops: list[DataFrame]
    fanout: int
    levels: int

    def root(self) -> DataFrame:
        """One row ``root``; no row for a dataset without rows."""
        return self.tops[-1].select(F.col("node").alias("root"))

    def branches(self) -> DataFrame:
        """branch, its place among the branches, subroot, root, and ``path`` from the subroot to the root."""
        end = self.tops[-1].select("branch", F.col("node").alias("root"), no_path().alias("path"))
        found = paths(self.tops, end, self.fanout, self.levels)
        return found.select(F.col("name").alias("branch"), F.col("pos").alias("place"), F.col("node").alias("subroot"), "root", "path")

    def proofs(self) -> DataFrame:
        """The leaves' rows with subroot, root and ``path`` (left and right siblings, upwards to the root)."""
        ends = materialize(self.branches().select("branch", "subroot", "root", "path"), "branches")
        return paths(self.strips, ends, self.fanout, self.levels)


def build(leaves: DataFrame, order: list[str], fanout: int = FANOUT, levels: int = LEVELS) -> Manifest:
    """The manifest of ``leaves``, a written table with ``branch``, ``leaf`` and the columns of ``order``.

    Leaves of a branch ascend by ``order`` and, where that is equal, by ``leaf``; a
    null is smaller than any value.  Rows that are equal in both are leaves of their own.
    """
    lines = strips(placed(leaves.withColumn("node", F.col("leaf")), [*order, "leaf"]), fanout, levels)
    names = lines[-1].select(F.lit("").alias("branch"), F.col("branch").alias("name"), "node")
    return Manifest(lines, strips(placed(materialize(names, "subroots"), ["name"]), fanout, levels), fanout, levels)


def leaves_of(docs: DataFrame, key: str, group: str, fields: list[str], counter: str, tampered: Column) -> DataFrame:
    """key, branch, leaf, and ``changed``: where ``tampered``, the leaf with ``counter`` one higher."""
    values = [F.col(c) for c in fields]
    other = [F.col(c) + 1 if c == counter else F.col(c) for c in fields]
    return docs.select(
        key, branch_name(group).alias("branch"), leaf(values).alias("leaf"), F.when(tampered, leaf(other)).alias("changed")
    )


def verified(
    docs: DataFrame, key: str = "doc_id", group: str = "lang", fields: tuple[str, ...] = FIELDS, counter: str = "n_chars"
) -> DataFrame:
    """Per row its proof, and whether the row, tampered with where the contract says so, still leads to the root.

    Nulls: a null field is ``-`` in the leaf, a null group a branch of its own, a null
    key the smallest and never tampered with.  Empty and long texts are hashed whole.
    Rows repeated as a whole, and rows with equal keys, are leaves each.  No rows give
    no rows.  Only the named columns are read, whatever others there are.
    """
    hit = F.crc32(F.col(key).cast("string")) % 7 == 0
    leaves = materialize(leaves_of(docs, key, group, list(fields), counter, hit), "leaves")
    rows = build(leaves, [key]).proofs()
    rows = rows.withColumn("folded_root", folded(F.coalesce("changed", "leaf"), F.col("path")))
    return rows.select(
        key,
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verified(common.table(spark, sf_dir, "documents"))


# crc32 of the decimal digits, bit by bit; levels as long as any branch has several nodes.
SQL = """
WITH RECURSIVE
base AS (
  SELECT doc_id, lang, n_chars, sha256(a || COALESCE(b, '-') || c) AS leaf, sha256(a || COALESCE(b2, '-') || c) AS other
  FROM (SELECT doc_id, lang, n_chars,
    COALESCE(strlen(doc_id::varchar) || ':' || doc_id, '-') || COALESCE(strlen(source) || ':' || source, '-')
      || COALESCE(strlen(lang) || ':' || lang, '-') AS a,
    strlen(n_chars::varchar) || ':' || n_chars AS b,
    strlen((n_chars + 1)::varchar) || ':' || (n_chars + 1) AS b2,
    COALESCE(strlen(text) || ':' || text, '-') AS c
  FROM documents)
),
leaves AS (
  SELECT *, COALESCE(':' || lang, '-') AS branch,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
        string_split(doc_id::varchar, ''), lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS raw_crc
  FROM base
),
nodes(branch, level, pos, node, size) AS (
  SELECT branch, 0::BIGINT, pos, leaf, count(*) OVER (PARTITION BY branch) FROM leaves
  UNION ALL
  SELECT branch, level + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (size + 1) // 2
  FROM nodes WHERE size > 1 GROUP BY branch, level, pos // 2, size
),
subroots AS (SELECT branch, node AS subroot, row_number() OVER (ORDER BY branch) - 1 AS place FROM nodes WHERE size = 1),
tops(level, pos, node, size) AS (
  SELECT 0::BIGINT, place, subroot, count(*) OVER () FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (size + 1) // 2
  FROM tops WHERE size > 1 GROUP BY level, pos // 2, size
),
steps AS (
  SELECT l.branch, l.pos AS leaf_pos, n.level, COALESCE(s.node, '') AS sibling, (l.pos >> n.level) % 2 = 1 AS to_left
  FROM leaves l
  JOIN (SELECT DISTINCT branch, level FROM nodes WHERE size > 1) n ON n.branch = l.branch
  LEFT JOIN nodes s ON s.branch = l.branch AND s.level = n.level AND s.pos = xor(l.pos >> n.level, 1)
  UNION ALL
  SELECT l.branch, l.pos, 1000 + n.level, COALESCE(s.node, ''), (r.place >> n.level) % 2 = 1
  FROM leaves l JOIN subroots r ON r.branch = l.branch
  CROSS JOIN (SELECT DISTINCT level FROM tops WHERE size > 1) n
  LEFT JOIN tops s ON s.level = n.level AND s.pos = xor(r.place >> n.level, 1)
),
proof AS (
  SELECT branch, leaf_pos, list({'s': sibling, 'l': to_left} ORDER BY level) AS path, string_agg(sibling, '' ORDER BY level) AS siblings
  FROM steps GROUP BY branch, leaf_pos
),
fold(doc_id, branch, pos, leaf, step, h, path, siblings) AS (
  SELECT l.doc_id, l.branch, l.pos, l.leaf, 0,
    CASE WHEN xor(l.raw_crc, 4294967295) % 7 = 0 AND l.n_chars IS NOT NULL THEN l.other ELSE l.leaf END,
    COALESCE(p.path, []), COALESCE(p.siblings, '')
  FROM leaves l LEFT JOIN proof p ON p.branch = l.branch AND p.leaf_pos = l.pos
  UNION ALL
  SELECT doc_id, branch, pos, leaf, step + 1,
    sha256(CASE WHEN path[step + 1].l THEN path[step + 1].s || h ELSE h || path[step + 1].s END), path, siblings
  FROM fold WHERE step < len(path)
)
SELECT f.doc_id, f.leaf, s.subroot, t.node AS root, sha256(f.siblings) AS proof_sha256, f.h AS folded_root, f.h = t.node AS verified
FROM fold f JOIN subroots s ON s.branch = f.branch CROSS JOIN (SELECT node FROM tops WHERE size = 1) t
WHERE f.step = len(f.path)
"""
