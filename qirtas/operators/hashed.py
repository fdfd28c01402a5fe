"""Hashed TF-IDF by value: sparse vectors as rows and as sorted arrays, without MLlib.

The long form (key, slot, value) is what the checks of the models join with; the
scoring path keeps MLlib's vectors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qirtas.functions.hashing import with_term_slot
from qirtas.functions.tokens import token_counts
from qirtas.operators.vectors import DENSE_FEATURES, NUM_FEATURES
from qirtas.storage import materialize


def vector_words(text: Column | str) -> Column:
    """The words that MLlib's tokenizer makes: lower case, split at each white space, no empty ones at the end."""
    lower = F.lower(text)
    cut = F.regexp_replace(lower, r"\s+$", "")
    none = F.array().cast("array<string>")
    return F.when((cut == "") & (lower != ""), none).otherwise(F.split(cut, r"\s"))


def slot_counts(df: DataFrame, key: str, words: Column, size: int = NUM_FEATURES) -> DataFrame:
    """key, slot, tf: how many words of a row fall on a slot.  Rows with one key are rows of their own.

    Words are counted in the row, so a row sends one line per slot at most.
    """
    # Numbered before the words become rows: beside a generator the number would be one of each word.
    rows = df.select(key, F.monotonically_increasing_id().alias("_row"), token_counts(words).alias("_terms"))
    terms = rows.select(key, "_row", F.inline("_terms"))
    slots = with_term_slot(terms, "term", size)
    return slots.groupBy("_row", key, "slot").agg(F.sum("tf").alias("tf")).select(key, "slot", "tf")


def tfidf_slots(df: DataFrame, key: str, words: Column, size: int = NUM_FEATURES) -> DataFrame:
    """key, slot, tf, df, weight with weight = tf * ln((m + 1) / (df + 1)) over the m rows of ``df``, a written table."""
    counts = materialize(slot_counts(df, key, words, size), "slot-counts")
    # One row per slot, ``size`` at most: a fixed bound for the broadcast.
    frequency = counts.groupBy("slot").agg(F.count("*").alias("df"))
    idf = F.log(F.lit(float(df.count() + 1)) / (F.col("df") + 1))
    return counts.join(F.broadcast(frequency), "slot").select(key, "slot", "tf", "df", (F.col("tf") * idf).alias("weight"))


def sparse_vectors(slots: DataFrame, key: str, value: str = "weight") -> DataFrame:
    """key, and ``slots`` and ``values`` as arrays in slot order; rows with one key must be one."""
    pairs = F.sort_array(F.collect_list(F.struct("slot", F.col(value).alias("value"))))
    rows = slots.groupBy(key).agg(pairs.alias("_pairs"))
    return rows.select(key, F.col("_pairs.slot").alias("slots"), F.col("_pairs.value").alias("values"))


def feature_values(features: DataFrame, key: str, size: int = NUM_FEATURES) -> DataFrame:
    """key, slot, value of the assembled vectors of a written feature table: hashed slots, the dense ones behind."""
    hashed = tfidf_slots(features, key, vector_words("cleaned_text"), size)
    dense = F.array(
        *[F.struct(F.lit(size + i).alias("slot"), F.col(c).cast("double").alias("value")) for i, c in enumerate(DENSE_FEATURES)]
    )
    rows = features.select(key, F.inline(dense)).unionByName(hashed.select(key, "slot", F.col("weight").alias("value")))
    return rows.filter("value != 0")
