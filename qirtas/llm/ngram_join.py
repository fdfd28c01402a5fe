"""Exact Jaccard join on word shingles by prefix filters under several global orders.

If two sets reach the threshold, then under every global order of the shingles
their prefixes (a quarter of each set) share one.  Three orders are used: rarest
first, by hash, and by a second hash.  Documents with a common token in the
prefixes of the first order form buckets; pairs of a bucket must also share one
under the two others, and pass a bound from the overlap in the counted range,
before their whole sets are compared.

Orders start with a fixed range of the hash values, so counting the shingles of
that range is enough to order them by frequency.  Equal sets are one class.  In a
bucket all members are first compared with its most central member (the
pivot); what that links needs no more comparing, and only pairs that are still
apart go through the filters in tiles of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qirtas.llm import common
from qirtas.llm.components import components
from qirtas.storage import materialize

WIDTH = 5
THRESHOLD = 75  # hundredths
RANGE = 0.35  # of the hash values: counted over all documents; more than a prefix holds
TILE = 1_000  # documents of a side
# Cells of the filters that spare shuffling what cannot match: 4 MB and 0.5 MB, whatever the data.
TOKEN_BITS, CLASS_BITS = 25, 22
_LIMIT = np.uint64(int(RANGE * 2**63))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


_random = np.random.default_rng(77)
BYTE = _random.integers(0, 1 << 64, 256, np.uint64)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
BYTE[SPACE] = 0  # what stands between words adds nothing to the word before it
BYTE = BYTE[LOWER]
_places = np.zeros(0, np.uint64)


def places(size: int) -> np.ndarray:
    """Odd multipliers by place in a word; longer lists begin like shorter ones."""
    global _places
    if len(_places) < size:
        rng = np.random.default_rng(78)
        _places = rng.integers(0, 1 << 64, 1 << max(size, 512).bit_length(), np.uint64) | np.uint64(1)
    return _places


def word_hashes(text: str | None) -> np.ndarray:
    """64 bits of each word, A-Z lower-cased, in order."""
    data = np.frombuffer((text or "").encode(), np.uint8)
    blank = SPACE[data]
    begins = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]])) if len(data) else np.zeros(0, np.int64)
    if not len(begins):
        return np.zeros(0, np.uint64)
    data = data[begins[0] :]
    begins = begins - begins[0]
    sizes = np.diff(begins, append=len(data))
    place = np.arange(len(data)) - np.repeat(begins, sizes)
    return mix(np.add.reduceat(BYTE[data] * places(int(sizes.max()))[place], begins))


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 63-bit hashes of the shingles (of all words, if they are fewer)."""
    h = word_hashes(text)
    n = len(h)
    if not n:
        return np.zeros(0, np.uint64)
    size = min(width, n)
    out = mix(h[: n - size + 1] + np.uint64(size))
    for k in range(1, size):
        out = mix(out * np.uint64(31) + h[k : n - size + 1 + k])
    out >>= np.uint64(1)
    out.sort()
    return out[np.concatenate([[True], out[1:] != out[:-1]])]


def prefix_size(n: int, threshold: int) -> int:
    """So many tokens must two sets share a token in, under any order."""
    return n - -(-threshold * n // 100) + 1 if n else 0


def emitted(tokens: np.ndarray, threshold: int) -> int:
    """How many tokens, the smallest first, the orders look at: the counted range and a prefix."""
    return max(int(np.searchsorted(tokens, _LIMIT)), prefix_size(len(tokens), threshold))


def class_number(tokens: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) >> 1


def bitmap(df: DataFrame, column: str, bits: int) -> np.ndarray:
    """A fixed number of bits, 64 to a word; one is set where a value of ``column`` falls."""
    rows = (
        df.select(
            F.expr(f"shiftright({column} & {(1 << bits) - 1}, 6)").alias("word"),
            F.expr(f"shiftleft(1L, cast({column} & 63 as int))").alias("bit"),
        )
        .groupBy("word")
        .agg(F.bit_or("bit").alias("mask"))
        .toArrow()
    )
    words = np.zeros(1 << (bits - 6), np.int64)
    words[rows["word"].to_numpy()] = rows["mask"].to_numpy()
    return words.view(np.uint64)


def marked(words: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which ``values`` fall on a bit that is set."""
    word = (values >> np.uint64(6)) & np.uint64(len(words) - 1)
    return (words[word] >> (values & np.uint64(63))) & np.uint64(1) == 1


def token_rows(df: DataFrame, text: str, threshold: int) -> DataFrame:
    """Every emitted token of every text, repeated texts too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (texts,) in common.slices(batches):
            found = [np.zeros(0, np.uint64)]
            for t in texts:
                tokens = shingles(t)
                found.append(tokens[: emitted(tokens, threshold)])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], ["token"])

    return common.map_batches(df.select(text), run, "token long")


DOC = [("n", "int"), ("cid", "bigint"), ("seen", "int"), ("low", "int"), ("edge2", "bigint"), ("edge3", "bigint")]


def second_order(tokens: np.ndarray) -> np.ndarray:
    return mix(tokens ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(1)


def describe(tokens: np.ndarray, threshold: int) -> tuple[int, int | None, int, int, int, int]:
    """Set size, class, emitted tokens, those in range, ends of the prefixes under the hash orders."""
    n = len(tokens)
    if not n:
        return 0, None, 0, 0, 0, 0
    p, low = prefix_size(n, threshold), int(np.searchsorted(tokens, _LIMIT))
    edge3 = int(np.partition(second_order(tokens[:low]), p - 1)[p - 1]) if low >= p else (1 << 63) - 1
    return n, class_number(tokens), max(low, p), low, int(tokens[p - 1]), edge3


def doc_rows(df: DataFrame, key: str, text: str, threshold: int, cells) -> DataFrame:
    """key, digest of the text, what ``describe`` says, and the emitted tokens that other texts may have."""
    declared, field = common.key_field(df, key)
    schema = pa.schema([field, ("digest", pa.int64()), *[(n, common.ARROW[t]) for n, t in DOC], ("tokens", pa.list_(pa.int64()))])

    def work(columns: list[list]) -> list[list]:
        out: list[list] = [columns[0], columns[1], *[[] for _ in DOC], []]
        for t in columns[2]:
            tokens = shingles(t)
            for values, v in zip(out[2:-1], describe(tokens, threshold), strict=True):
                values.append(v)
            known = tokens[: emitted(tokens, threshold)]
            out[-1].append(known[marked(cells.value, known)].view(np.int64))
        return out

    spark_schema = ", ".join([declared, "digest bigint", *[f"{n} {t}" for n, t in DOC], "tokens array<bigint>"])
    return common.map_rows(df.select(key, F.xxhash64(text), text), work, spark_schema, schema)


def needed_overlap(n: int, m: int, threshold: int) -> int:
    """The least intersection of sets of these sizes at the threshold."""
    return -(-threshold * (n + m) // (100 + threshold))


def may_link(a: tuple, b: tuple, threshold: int) -> bool:
    """Filters on (n, low, edge2, edge3, shared tokens): no pair that links fails one.

    Sizes; a common token in the prefixes of the orders by hash and by second
    hash; and the overlap: what is common in range, exactly, and at most all of
    the smaller rest.
    """
    (n, low_a, edge2_a, edge3_a, x), (m, low_b, edge2_b, edge3_b, y) = a, b
    if 100 * min(n, m) < threshold * max(n, m):
        return False
    both = x[np.isin(x, y, assume_unique=True)]
    in_range = int(np.searchsorted(both, _LIMIT.astype(np.int64)))
    if in_range + min(n - low_a, m - low_b) < needed_overlap(n, m, threshold):
        return False
    if not (both <= min(edge2_a, edge2_b)).any():
        return False
    # Behind the range the second-hash order goes on by hash.
    third = second_order(both[:in_range].view(np.uint64)).view(np.int64)
    ends = [edge3_a if low_a else (1 << 63) - 1, edge3_b if low_b else (1 << 63) - 1]
    rest = both[in_range:] <= min(edge2_a, edge2_b)
    return bool((third <= min(ends)).any() or rest.any())


def links(sets_a: bytes, sets_b: bytes, threshold: int) -> bool:
    a, b = np.frombuffer(sets_a, np.int64), np.frombuffer(sets_b, np.int64)
    common_tokens = int(np.isin(a, b, assume_unique=True).sum())
    return 100 * common_tokens >= threshold * (len(a) + len(b) - common_tokens)


PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])
FACTS = ["n", "low", "edge2", "edge3", "shared"]


def filtered(pairs: DataFrame, profiles: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) that pass the filters."""
    side = lambda s: profiles.select(F.col("cid").alias(s), F.struct(*FACTS).alias(f"of_{s}"))
    met = pairs.join(side("a").hint("shuffle_merge"), "a").join(side("b").hint("shuffle_merge"), "b")

    def work(columns: list[list]) -> list[list]:
        fact = lambda f: (f["n"], f["low"], f["edge2"], f["edge3"], np.array(f["shared"], np.int64))
        kept = [(a, b) for a, b, x, y in zip(*columns, strict=True) if may_link(fact(x), fact(y), threshold)]
        return [list(c) for c in zip(*kept, strict=True)] or [[], []]

    return common.map_rows(met.select("a", "b", "of_a", "of_b"), work, "a long, b long", PAIR)


def whole_sets(wanted: DataFrame, df: DataFrame, text: str) -> DataFrame:
    """(cid, tokens) of the classes in ``wanted``, computed again from the texts."""
    spark = df.sparkSession
    wanted = materialize(wanted.distinct(), "wanted")
    cells = spark.sparkContext.broadcast(bitmap(wanted, "cid", CLASS_BITS))
    schema = pa.schema([("cid", pa.int64()), ("tokens", pa.binary())])

    def work(columns: list[list]) -> list[list]:
        out = ([], [])
        for t in columns[0]:
            tokens = shingles(t)
            cid = class_number(tokens)
            if len(tokens) and marked(cells.value, np.array([cid], np.uint64))[0]:
                out[0].append(cid)
                out[1].append(tokens.tobytes())
        return list(out)

    sets = common.map_rows(df.select(text), work, "cid long, tokens binary", schema)
    sets = materialize(sets.join(wanted.hint("shuffle_merge"), "cid", "left_semi").dropDuplicates(["cid"]), "sets")
    cells.destroy()
    return sets


def verified(pairs: DataFrame, df: DataFrame, text: str, threshold: int) -> DataFrame:
    """The pairs whose whole sets reach the threshold."""
    sets = whole_sets(pairs.select(F.explode(F.array("a", "b")).alias("cid")), df, text)
    met = pairs.join(sets.select(F.col("cid").alias("a"), F.col("tokens").alias("x")).hint("shuffle_merge"), "a").join(
        sets.select(F.col("cid").alias("b"), F.col("tokens").alias("y")).hint("shuffle_merge"), "b"
    )

    def compare(columns: list[list]) -> list[list]:
        kept = [(a, b) for a, b, x, y in zip(*columns, strict=True) if links(x, y, threshold)]
        return [list(c) for c in zip(*kept, strict=True)] or [[], []]

    return materialize(common.map_rows(met.select("a", "b", "x", "y"), compare, "a long, b long", PAIR), "verified")


def tile_rows(groups: DataFrame, profiles: DataFrame, tile: int) -> DataFrame:
    """Members (pivot, cid, label, home: is it the pivot's label) dealt to tiles.

    They get the columns of ``profiles`` (one row per cid) before they are dealt, so
    that no join sees a member more than once per pivot.  A tile pairs a block of members that are apart from the pivot with a block of
    any: pairs inside the pivot's label need no comparing.  A tile that pairs a
    block with itself has its members once.
    """
    sizes = groups.groupBy("pivot").agg(
        F.sum(F.col("home").cast("long")).alias("homes"), F.sum((~F.col("home")).cast("long")).alias("others")
    )
    # One row per pivot, many rows per pivot on the other side: the join can split those.
    dealt = (
        groups.join(sizes.filter("others > 0").hint("shuffle_merge"), "pivot")
        .withColumn("n_home", F.ceil(F.col("homes") / tile))
        .withColumn("n_other", F.ceil(F.col("others") / tile))
        .withColumn("block", F.expr("pmod(xxhash64(cid), if(home, n_home, n_other))"))
        .join(profiles.hint("shuffle_merge"), "cid")
    )
    # Tiles (i, j): block i of the others with block j, 0 to n_other - 1 of the others (j >= i), then the homes.
    homes = F.expr("transform(sequence(0, n_other - 1), i -> struct(i as i, n_other + block as j, false as first))")
    others = F.expr(
        "concat(transform(sequence(block, n_other - 1), j -> struct(block as i, j as j, true as first)),"
        " transform(filter(sequence(0, block), i -> i < block), i -> struct(i as i, block as j, false as first)),"
        " if(n_home = 0, array(), transform(sequence(n_other, n_other + n_home - 1), j -> struct(block as i, j as j, true as first))))"
    )
    rows = dealt.withColumn("at", F.explode(F.when(F.col("home"), homes).otherwise(others)))
    beside = [c for c in profiles.columns if c != "cid"]
    return rows.select("pivot", "cid", "label", *[F.col(f"at.{c}").alias(c) for c in ("i", "j", "first")], *beside)


def buckets(df: DataFrame, key: str, text: str, threshold: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Written tables: rows (key, n, cid), profiles of the classes, and groups (pivot, cid).

    Classes that link are together in a group.
    """
    spark = df.sparkSession
    shared = token_rows(df, text, threshold).groupBy("token").agg(F.count("*").alias("df")).filter("df > 1")
    shared = materialize(shared, "shared-tokens")
    cells = spark.sparkContext.broadcast(bitmap(shared, "token", TOKEN_BITS))
    docs = materialize(doc_rows(df, key, text, threshold, cells), "shingled")
    cells.destroy()

    classes = docs.filter("n > 0").drop(key, "digest").dropDuplicates(["cid"])
    counted = classes.withColumn("token", F.explode("tokens")).drop("tokens").join(shared.hint("shuffle_merge"), "token")
    # First order: the counted range, rarest first and then by hash; behind it by hash.
    beyond = F.col("token") >= F.lit(int(_LIMIT))
    first_order = F.struct(beyond.alias("beyond"), F.when(beyond, 0).otherwise(F.col("df")).alias("df"), F.col("token").alias("token"))
    facts = [n for n, _ in DOC]
    profiles = counted.groupBy(*facts).agg(F.sort_array(F.collect_list(first_order)).alias("ordered"))
    alone = F.expr("low - size(filter(ordered, t -> not t.beyond))")
    profiles = profiles.withColumns({"shared": F.sort_array("ordered.token"), "alone": alone})
    profiles = materialize(profiles, "profiles")
    # Tokens of this document alone come first in the prefix and meet nobody.  One
    # behind the range stands behind all of those in range.
    size = F.expr(f"n - ceil({threshold} * n / 100) + 1")
    place = F.col("pos") + F.col("alone")
    # Behind the range only the first tokens by hash were emitted; each of them is in the prefix.
    in_prefix = F.when(F.col("t.beyond"), F.lit(True)).otherwise(place < size)
    postings = (
        profiles.select("cid", "n", "alone", F.posexplode("ordered").alias("pos", "t"))
        .filter(in_prefix)
        .select(F.col("t.token").alias("token"), "cid", F.struct((place / F.col("n")).alias("place"), "cid").alias("central"))
    )
    postings = materialize(postings, "postings")
    pivots = (
        postings.groupBy("token")
        .agg(F.min("central").alias("pivot"), F.count("*").alias("members"))
        .filter("members > 1")
        .select("token", F.col("pivot.cid").alias("pivot"))
    )
    # Who was in a bucket with which pivot, the pivots themselves too; buckets of one pivot fall together.
    groups = materialize(postings.join(pivots.hint("shuffle_merge"), "token").select("pivot", "cid").distinct(), "groups")
    return docs, profiles, groups


def connected(
    df: DataFrame, key: str = "doc_id", text: str = "text", threshold: int = THRESHOLD, tile: int = TILE
) -> tuple[DataFrame, DataFrame]:
    """Written tables: rows (key, digest, n, cid) and links (a, b) that connect what is connected.

    For components only: of the links among classes already connected just some
    are given, and of those that a tile finds a star.  ``join`` gives all.
    """
    docs, profiles, groups = buckets(df, key, text, threshold)
    with_pivot = groups.filter("cid != pivot").select(F.col("cid").alias("a"), F.col("pivot").alias("b"))
    candidates = materialize(filtered(with_pivot, profiles, threshold), "candidates")
    near = verified(candidates, df, text, threshold)

    roots = components(near)
    label = lambda c, to: roots.select(F.col("node").alias(c), F.col("root").alias(to))
    labelled = (
        groups.join(label("cid", "root_c").hint("shuffle_merge"), "cid", "left")
        .join(label("pivot", "root_p").hint("shuffle_merge"), "pivot", "left")
        .select("pivot", "cid", F.coalesce("root_c", "cid").alias("label"), F.coalesce("root_p", "pivot").alias("_home"))
        .withColumn("home", F.col("label") == F.col("_home"))
    )
    labelled = materialize(labelled.drop("_home"), "labelled")
    far = compared(labelled, ["label"], groups, profiles, df, text, threshold, tile, stars, ["cid", "root", "n_links"])
    return docs.select(key, "digest", "n", "cid"), near.union(far.select("cid", "root"))


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many tokens each set of ``left`` has in common with each of ``right``."""
    shape = len(left), len(right)
    vocabulary, at = np.unique(np.concatenate(right), return_inverse=True)
    of = np.repeat(np.arange(shape[1]), [len(x) for x in right])
    own = np.concatenate(left)
    who = np.repeat(np.arange(shape[0]), [len(x) for x in left])
    if not len(own) or not len(vocabulary):
        return np.zeros(shape, np.int64)
    place = np.minimum(np.searchsorted(vocabulary, own), len(vocabulary) - 1)
    met = vocabulary[place] == own
    place, who = place[met], who[met]
    times, meets = np.bincount(place, minlength=len(vocabulary)), np.bincount(at, minlength=len(vocabulary))
    # Tokens that many sets have: by matrices; the others pair by pair.
    heavy = times * meets * 32 > shape[0] * shape[1]
    heavy &= times * meets > 64
    out = np.zeros(shape, np.int64)
    many = np.flatnonzero(heavy)
    column = np.cumsum(heavy) - 1
    for first in range(0, len(many), 2048):
        sides = []
        for rows, where, size in ((who, place, shape[0]), (of, at, shape[1])):
            here = heavy[where] & (column[where] >= first) & (column[where] < first + 2048)
            dense = np.zeros((size, min(2048, len(many) - first)), np.float32)
            dense[rows[here], column[where[here]] - first] = 1
            sides.append(dense)
        out += (sides[0] @ sides[1].T).astype(np.int64)
    place, who = place[~heavy[place]], who[~heavy[place]]
    order = np.argsort(at, kind="stable")
    begin, counts = (np.cumsum(meets) - meets)[place], meets[place]
    hits = np.cumsum(counts)
    for first, last in parts(hits, 1 << 22):
        some = counts[first:last]
        found = np.repeat(begin[first:last] - np.cumsum(some) + some, some) + np.arange(some.sum())
        cells = np.repeat(who[first:last], some) * shape[1] + of[order[found]]
        out += np.bincount(cells, minlength=shape[0] * shape[1]).reshape(shape)
    return out


def parts(sums: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of about ``size`` by these running sums, one number at least in each."""
    first = 0
    while first < len(sums):
        before = sums[first - 1] if first else 0
        last = max(int(np.searchsorted(sums, before + size, "right")), first + 1)
        yield first, last
        first = last


Tile = dict[str, np.ndarray | list[np.ndarray]]


def not_yet_met(a: Tile, b: Tile, same: bool, threshold: int) -> np.ndarray:
    """Pairs of fitting sizes that no group of a smaller pivot has; with labels, those that are apart.

    Members with labels were all compared with their pivot before.
    """
    fits = 100 * np.minimum.outer(a["n"], b["n"]) >= threshold * np.maximum.outer(a["n"], b["n"])
    if same:
        np.fill_diagonal(fits, False)
    if "label" in a:
        fits &= np.not_equal.outer(a["label"], b["label"])
        fits &= np.logical_and.outer(a["cid"] != a["pivot"], b["cid"] != b["pivot"])
    if fits.any():
        fits &= overlaps(a["below"], b["below"]) == 0
    return fits


def candidates_of(a: Tile, b: Tile, same: bool, threshold: int) -> np.ndarray:
    """Pairs that pass the overlap bound and share a token in their prefixes by hash and by second hash."""
    fits = not_yet_met(a, b, same, threshold)
    if fits.any():
        in_range = lambda t: [x[: np.searchsorted(x, _LIMIT.astype(np.int64))] for x in t["tokens"]]
        most = overlaps(in_range(a), in_range(b)) + np.minimum.outer(a["n"] - a["low"], b["n"] - b["low"])
        fits &= (100 + threshold) * most >= threshold * np.add.outer(a["n"], b["n"])
    for prefix in (hash_prefix, second_prefix):
        if fits.any():
            fits &= overlaps(prefix(a), prefix(b)) > 0
    return fits


def hash_prefix(t: Tile) -> list[np.ndarray]:
    return [x[: np.searchsorted(x, e, "right")] for x, e in zip(t["tokens"], t["edge2"], strict=True)]


def second_prefix(t: Tile) -> list[np.ndarray]:
    """The counted range by second hash, behind it by hash."""
    limit, found = _LIMIT.astype(np.int64), []
    for x, e2, e3 in zip(t["tokens"], t["edge2"], t["edge3"], strict=True):
        ranged = x < limit
        second = second_order(x.view(np.uint64)).view(np.int64)
        found.append(x[np.where(ranged, second <= e3, x <= e2)])
    return found


def links_of(a: Tile, b: Tile, same: bool, threshold: int) -> np.ndarray:
    """Pairs whose whole sets reach the threshold."""
    fits = not_yet_met(a, b, same, threshold)
    if fits.any():
        both = overlaps(a["tokens"], b["tokens"])
        fits &= 100 * both >= threshold * (np.add.outer(a["n"], b["n"]) - both)
    return fits


def roots_of(fits: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the members of both sides the smallest that links reach."""
    none = np.iinfo(np.int64).max
    a, b = a.copy(), b.copy()
    while True:
        to_a = np.minimum(a, np.where(fits, b[None, :], none).min(1))
        to_b = np.minimum(b, np.where(fits, to_a[:, None], none).min(0))
        if (to_a == a).all() and (to_b == b).all():
            return a, b
        a, b = to_a, to_b


def survivors(tile: Tile, a: Tile, b: Tile, fits: np.ndarray, same: bool) -> list[np.ndarray]:
    """(pivot, i, j, first, cid) of the members that are in a pair, with labels these too."""
    in_a, in_b = fits.any(1), fits.any(0) & (not same)
    size = [int(in_a.sum()), int(in_b.sum())]
    sides = [np.concatenate([a[n][in_a], b[n][in_b]]) for n in ("cid", "label") if n in a]
    return [*[np.full(sum(size), v, np.int64) for v in tile], np.repeat([1, 0], size), *sides]


def stars(tile: Tile, a: Tile, b: Tile, fits: np.ndarray, same: bool) -> list[np.ndarray]:
    """(cid, root, n_links) of the members that link: a member they reach, how many link here."""
    of_a, of_b = roots_of(fits, a["cid"], b["cid"])
    sides = [(a["cid"], of_a, fits.sum(1))] + ([] if same else [(b["cid"], of_b, fits.sum(0))])
    return [np.concatenate(c) for c in zip(*[[c[s[2] > 0] for c in s] for s in sides], strict=True)]


def every_pair(tile: Tile, a: Tile, b: Tile, fits: np.ndarray, same: bool) -> list[np.ndarray]:
    """(a, b) of each pair, the smaller first."""
    i, j = np.nonzero(np.triu(fits) if same else fits)
    x, y = a["cid"][i], b["cid"][j]
    return [np.minimum(x, y), np.maximum(x, y)]


def by_tile(rows: DataFrame, columns: list[str], judge, report, names: list[str], threshold: int) -> DataFrame:
    """``report`` of the pairs that ``judge`` finds in each tile of ``rows``; all results are longs.

    ``rows`` have pivot, i, j, first, cid, the numbers in ``columns``, and the
    sorted lists ``below`` and ``tokens``.
    """
    head = ["pivot", "i", "j", "first", "cid", *columns]
    schema = pa.schema([(n, pa.int64()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result(pieces: list) -> pa.RecordBatch:
            first = np.concatenate([p[0][3] for p in pieces]) == 1
            numbers = {n: np.concatenate([p[0][k] for p in pieces]) for k, n in enumerate(head)}
            lists = {n: [x for p in pieces for x in p[k]] for k, n in ((1, "below"), (2, "tokens"))}

            def side(mask: np.ndarray) -> Tile:
                at = np.flatnonzero(mask)
                return {n: v[at] for n, v in numbers.items()} | {n: [v[k] for k in at] for n, v in lists.items()}

            tile = [numbers[n][0] for n in head[:3]]
            same = tile[1] == tile[2]
            a = side(first)
            b = a if same else side(~first)
            found = [np.zeros(0, np.int64)] * len(names)
            if len(a["cid"]) and len(b["cid"]):
                fits = judge(a, b, same, threshold)
                if fits.any():
                    found = report(tile, a, b, fits, same)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], schema=schema)

        def lists(column: pa.Array) -> list[np.ndarray]:
            ends, values = column.offsets.to_numpy(), column.values.to_numpy()
            return [values[x:y] for x, y in zip(ends[:-1], ends[1:], strict=True)]

        pieces, at, kept, size = [], None, [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            numbers = [batch.column(k).to_numpy() for k in range(len(head))]
            below, tokens = lists(batch.column(len(head))), batch.column(len(head) + 1)
            tokens = [np.frombuffer(t.as_buffer(), np.int64) for t in tokens] if pa.types.is_binary(tokens.type) else lists(tokens)
            new = np.flatnonzero((np.diff(numbers[0]) != 0) | (np.diff(numbers[1]) != 0) | (np.diff(numbers[2]) != 0)) + 1
            for x, y in zip([0, *new], [*new, batch.num_rows], strict=True):
                here = tuple(int(c[x]) for c in numbers[:3])
                if pieces and here != at:
                    kept.append(result(pieces))
                    pieces, size = [], size + kept[-1].num_rows
                    if size > 20_000:
                        yield from pa.Table.from_batches(kept).combine_chunks().to_batches()
                        kept, size = [], 0
                at = here
                pieces.append(([c[x:y] for c in numbers], below[x:y], tokens[x:y]))
        if pieces:
            kept.append(result(pieces))
        if kept:
            yield from pa.Table.from_batches(kept).combine_chunks().to_batches()

    ordered = rows.select(*[F.col(c).cast("long") for c in head], "below", "tokens")
    ordered = ordered.repartition("pivot", "i", "j").sortWithinPartitions("pivot", "i", "j")
    return common.map_batches(ordered, run, ", ".join(f"{n} long" for n in names))


def compared(
    groups: DataFrame,
    labels: list[str],
    met: DataFrame,
    profiles: DataFrame,
    df: DataFrame,
    text: str,
    threshold: int,
    tile: int,
    report,
    names: list[str],
) -> DataFrame:
    """What ``report`` makes of the links in ``groups`` (as ``tile_rows`` takes them) within ``met`` (pivot, cid).

    The tiles' pairs are looked at by the filters first, and those members that
    have a pair left again with their whole sets.  A pair that meets in several
    groups counts in that of the smallest pivot.  No pair is a row on its way.
    """
    pivots = materialize(met.groupBy("cid").agg(F.collect_list("pivot").alias("pivots")), "pivots")
    below = F.sort_array(F.filter("pivots", lambda p: p < F.col("pivot")))

    facts = profiles.select("cid", *FACTS).join(pivots.hint("shuffle_merge"), "cid")
    rows = tile_rows(groups, facts, tile).withColumn("below", below).withColumnRenamed("shared", "tokens")
    numbers, kept = [*labels, "n", "low", "edge2", "edge3"], ["pivot", "i", "j", "first", "cid", *labels]
    near = materialize(by_tile(rows, numbers, candidates_of, survivors, kept, threshold), "near")
    sets = whole_sets(near.select("cid"), df, text).withColumn("n", F.expr("octet_length(tokens) div 8"))
    # Survivors once per tile: their sets and pivots come in one join.
    beside = sets.join(pivots.hint("shuffle_merge"), "cid")
    rows = near.join(beside.hint("shuffle_merge"), "cid").withColumn("below", below)
    return materialize(by_tile(rows, [*labels, "n"], links_of, report, names, threshold), "linked")


def linked(
    df: DataFrame, key: str, text: str, threshold: int, tile: int, report, names: list[str]
) -> tuple[DataFrame, DataFrame]:
    """Rows (key, n, cid), and what ``report`` makes of all links between classes; every pair of a group is looked at."""
    docs, profiles, groups = buckets(df, key, text, threshold)
    all_apart = groups.withColumn("label", F.col("cid")).withColumn("home", F.lit(False))
    return docs.select(key, "n", "cid"), compared(all_apart, [], groups, profiles, df, text, threshold, tile, report, names)


def join(
    df: DataFrame, key: str = "doc_id", text: str = "text", threshold: int = THRESHOLD, tile: int = TILE
) -> tuple[DataFrame, DataFrame]:
    """Written tables: rows (key, n, cid) and all links (a, b), a < b, between different classes.

    A group of m near copies has up to m * m / 2 links; ``near_duplicate_links`` counts them instead.
    """
    return linked(df, key, text, threshold, tile, every_pair, ["a", "b"])


def near_duplicate_links(
    df: DataFrame, key: str = "doc_id", text: str = "text", threshold: int = THRESHOLD, tile: int = TILE
) -> DataFrame:
    """As ``near_duplicates``, and n_links: with how many classes of other texts the row's class links.

    A row without shingles has none.
    """
    docs, found = linked(df, key, text, threshold, tile, stars, ["cid", "root", "n_links"])
    named = with_components(docs, found.select(F.col("cid").alias("a"), F.col("root").alias("b")), key)
    counted = found.groupBy("cid").agg(F.sum("n_links").alias("n_links"))
    return (
        named.join(counted.hint("shuffle_merge"), "cid", "left")
        .withColumn("n_links", F.coalesce("n_links", F.lit(0).cast("long")))
        .drop("cid")
    )


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", threshold: int = THRESHOLD, tile: int = TILE
) -> DataFrame:
    """key, n_shingles and component_id (smallest key reachable by links) of each row.

    A null or empty text has no shingles and is linked with nothing; a text of
    fewer than five words is one shingle.  Equal sets always link.  Rows with a
    null key link like others, but a null is never the smallest key unless no
    other is reachable.  Rows repeated as a whole come out as often as they came in.
    """
    docs, found = connected(df, key, text, threshold, tile)
    return with_components(docs, found, key).drop("cid")


def with_components(docs: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """key, n_shingles, component_id and cid of each row (key, n, cid) under these links."""
    roots = components(found)
    smallest = docs.filter("cid IS NOT NULL").groupBy("cid").agg(F.min(key).alias("own"))
    grouped = smallest.join(roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    least = grouped.groupBy("root").agg(F.min("own").alias("component_id"))
    named = grouped.join(least, "root").select("cid", "component_id")
    return docs.join(named.hint("shuffle_merge"), "cid", "left").select(
        key,
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col(key)).alias("component_id"),
        "cid",
    )


def one_of_each(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Of each group of linked rows one: the smallest key, a null last, and of its texts the smallest class.

    Rows without shingles are linked with nothing.  Different texts that share a
    key, or have none, are different rows; of rows equal in key and text one stays.
    """
    docs, found = connected(df, key, text)
    roots = components(found).withColumnRenamed("node", "cid")
    rooted = docs.filter("n > 0").join(roots.hint("shuffle_merge"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    order = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), F.col("cid").alias("cid"), F.col("digest").alias("digest"))
    chosen = rooted.groupBy("root").agg(F.min(order).alias("best")).select(F.col("best.key").alias("_kept"), F.col("best.digest").alias("_text"))
    alone = docs.filter("n = 0").select(F.col(key).alias("_kept"), F.col("digest").alias("_text")).distinct()
    marks = chosen.unionByName(alone)
    same = F.col(key).eqNullSafe(F.col("_kept")) & (F.col("_digest") == F.col("_text"))
    rows = df.withColumn("_digest", F.xxhash64(text)).join(marks.hint("shuffle_merge"), same, "left_semi")
    return rows.dropDuplicates([key, "_digest"]).drop("_digest")


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_links(common.table(spark, sf_dir, "documents"))
