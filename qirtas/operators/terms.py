"""Token-level TF-IDF and the vocabulary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qirtas.functions.stem import stem_text
from qirtas.functions.tokens import token_counts, tokenize
from qirtas.operators.skew import HOT_ROWS, join_lookup, running_totals
from qirtas.storage import materialize


def term_counts(df: DataFrame, key: str, cleaned: str = "cleaned_text") -> DataFrame:
    """key, term, tf.  Counted inside the row: no shuffle."""
    return df.select(key, F.inline(token_counts(tokenize(cleaned))))


def tfidf_terms(
    df: DataFrame, key: str, cleaned: str = "cleaned_text", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """key, term, tf, df, idf, tfidf with idf = ln((m + 1) / (df + 1)).

    m counts all documents, also those without a term: those leave one row with a
    null term in the written table, and each document one row that is its head.
    An observed metric would give the count too, but ties the session to a
    listener with which no fitted model can be serialised.
    """
    found = df.select(key, F.posexplode_outer(token_counts(tokenize(cleaned))).alias("pos", "t"))
    head = (F.coalesce("pos", F.lit(0)) == 0).alias("head")
    rows = materialize(found.select(key, "t.term", "t.tf", head), "term-counts")
    documents = rows.filter("head").count()
    counts = rows.filter("term IS NOT NULL").drop("head")
    frequency = materialize(counts.groupBy("term").agg(F.count("*").alias("df")), "term-documents")
    idf = F.log(F.lit(float(documents + 1)) / (F.col("df") + 1))
    return join_lookup(counts, frequency, "term", "df", hot_rows).select(
        key, "term", "tf", "df", idf.alias("idf"), (F.col("tf") * idf).alias("tfidf")
    )


def stem_vocabulary(df: DataFrame, cleaned: str = "cleaned_text") -> DataFrame:
    """Every distinct token with its stem and count; each type is stemmed once."""
    return (
        df.select(F.explode(F.split(cleaned, " ")).alias("token"))
        .filter("token != ''")
        .groupBy("token")
        .agg(F.count("*").alias("n"))
        .select("token", stem_text(F.col("token")).alias("stem"), "n")
    )


def label_index(df: DataFrame, label: str = "label") -> DataFrame:
    """label, n, label_idx: 0.0 for the most frequent class, ties alphabetical.

    The twin of MLlib's indexer without its class list on the driver.
    """
    classes = df.groupBy(label).agg(F.count("*").alias("n"))
    key = F.struct((-F.col("n")).alias("n"), F.col(label)).alias("key")
    ranked = classes.select(label, "n", key, F.lit(1).alias("one"))
    return running_totals(ranked, "key", ["one"]).select(
        label, "n", F.col("one_before").cast("double").alias("label_idx")
    )
