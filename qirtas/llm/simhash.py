"""SimHash near-duplicates by covering locality-sensitive hashing.

The 64 bits are dealt to the seven non-zero vectors of three bits.  Table v (again a
non-zero vector) keeps a bit if its vector and v have an odd number of ones in
common.  The bits in which two fingerprints of distance two differ have at most
two vectors, and some v is orthogonal to both: in that table the pair agrees in all
bits kept.  So every pair within the radius meets in one of seven tables of 36 or
37 bits, and nothing is left to chance.

Equal fingerprints are one member.  Members that meet are compared in small
buckets.  In crowded ones nothing is compared with everything: members of a
bucket differ in the hidden bits only, and two are within two bits exactly if one
hidden flip of the one (or none) equals one hidden flip of the other (or none).  A
flipped value has at most 29 such members, so a bucket of m members costs about 28 m
rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qirtas.llm import common
from qirtas.llm.components import components
from qirtas.storage import materialize

WIDTH = 3
SEED = 42
RADIUS = 2
BITS = 64
# From so many members on, flips cost less than pairs; the result is the same.
CROWDED = 32


def shingles(text: str | None, width: int = WIDTH) -> Iterator[list[bytes]]:
    """The shingles in order, repeats included, a bounded number at a time."""
    last: list[bytes] = []
    count = 0
    for words in common.word_lists((text or "").encode().lower()):  # of bytes: A-Z only
        words = last + words
        n = len(words) - width + 1
        if n > 0:
            joined = b" ".join(words)
            ends = np.cumsum([len(w) + 1 for w in words]) - 1
            begins = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
            yield [joined[b:e] for b, e in zip(begins, ends[width - 1 :].tolist(), strict=True)]
            count += n
        last = words[max(0, len(words) - width + 1) :]
    if not count and last:
        yield [b" ".join(last)]


def fingerprint(text: str | None) -> int:
    """Signed 64 bits: each is 1 if it is in over half of the shingles' hashes."""
    ones, n = np.zeros(BITS, np.int64), 0
    for some in shingles(text):
        digests = b"".join([xxhash.xxh64_digest(s, SEED) for s in some])  # big-endian
        bits = np.unpackbits(np.frombuffer(digests, np.uint8)).reshape(-1, BITS)
        ones += bits.sum(0, dtype=np.int64)
        n += len(some)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def fingerprints(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, fp of each row."""
    declared, field = common.key_field(df, key)

    def work(columns: list[list]) -> list[list]:
        return [columns[0], [fingerprint(t) for t in columns[1]]]

    return common.map_rows(df.select(key, text), work, f"{declared}, fp bigint", pa.schema([field, ("fp", pa.int64())]))


def signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def masks(radius: int = RADIUS) -> list[int]:
    """The bits that each table keeps."""
    vectors = (1 << (radius + 1)) - 1
    of_bit = [i % vectors + 1 for i in range(BITS)]
    return [sum(1 << i for i in range(BITS) if (of_bit[i] & v).bit_count() % 2) for v in range(1, vectors + 1)]


def members(fps: DataFrame) -> DataFrame:
    """(tab, bucket, fp, n) of the fingerprints that share a bucket of n with another; written."""
    keys = F.array(*[F.col("fp").bitwiseAND(F.lit(signed(m))) for m in masks()])
    dealt = fps.select("fp", F.posexplode(keys).alias("tab", "bucket"))
    counts = dealt.groupBy("tab", "bucket").agg(F.count("*").alias("n")).filter("n > 1")
    # A row for each bucket on one side: a bucket that holds a third of all rows can be split on the other.
    return materialize(dealt.join(counts.hint("shuffle_merge"), ["tab", "bucket"]), "members")


def near(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= RADIUS


def pairs(met: DataFrame) -> DataFrame:
    """All links (a, b) of buckets of fewer than CROWDED members."""
    a = met.select("tab", "bucket", F.col("fp").alias("a"))
    b = met.select("tab", "bucket", F.col("fp").alias("b"))
    return a.join(b.hint("shuffle_merge"), ["tab", "bucket"]).filter(F.col("a") < F.col("b")).filter(near("a", "b")).select("a", "b")


def flips(met: DataFrame) -> DataFrame:
    """Links (a, b) that connect what is linked in crowded buckets: from each member to the least that shares a flip."""
    hidden = [[0] + [signed(1 << i) for i in range(BITS) if not m >> i & 1] for m in masks()]
    of_table = F.array(*[F.array(*[F.lit(x) for x in h]) for h in hidden])
    rows = met.select("tab", "fp", F.explode(F.get(of_table, F.col("tab"))).alias("flip"))
    rows = rows.select("tab", F.col("fp").bitwiseXOR(F.col("flip")).alias("value"), "fp")
    # At most 29 members have a value: itself and one for each hidden bit.
    meet = rows.groupBy("tab", "value").agg(F.collect_list("fp").alias("fps")).filter("size(fps) > 1")
    return meet.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).filter("a != b").distinct()


def links(fps: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """Links (a, b) between different fingerprints that connect all that are within the radius; written."""
    met = members(fps)
    found = pairs(met.filter(F.col("n") < crowded)).unionByName(flips(met.filter(F.col("n") >= crowded)))
    return materialize(found, "near")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", crowded: int = CROWDED) -> DataFrame:
    """key, fingerprint (16 hex digits) and component_id (smallest key reachable by links) of each row.

    A null or empty text, or one of white space, has the fingerprint zero and is
    linked like any other; fewer than three words are one shingle.  A text is hashed
    whole, a bounded number of words at a time.  Equal fingerprints always link.  Rows
    with a null key link like others, but a null is never the smallest key unless no
    other is reachable.  Repeated rows come out as often as they came in; no rows
    give no rows; other columns are not read.
    """
    docs = materialize(fingerprints(df, key, text), "fingerprints")
    least = materialize(docs.groupBy("fp").agg(F.min(key).alias("own")), "distinct-fingerprints")
    roots = components(links(least.select("fp"), crowded)).withColumnRenamed("node", "fp")
    grouped = least.join(roots.hint("shuffle_merge"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    reached = grouped.groupBy("root").agg(F.min("own").alias("component_id"))
    named = grouped.join(reached.hint("shuffle_merge"), "root").select("fp", "component_id")
    # One row for each fingerprint on the right: rows of one fingerprint can be split.
    return docs.join(named.hint("shuffle_merge"), "fp").select(
        key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.table(spark, sf_dir, "documents"))
