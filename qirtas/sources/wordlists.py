"""Plain-text word lists and their use on a corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qirtas.functions.tokens import remove_stopwords, tokenize
from qirtas.operators.skew import HOT_ROWS, join_lookup
from qirtas.storage import materialize

# Above this many words a list is joined instead of being put into the plan.
MAX_LITERAL_WORDS = 20_000


def load_words(spark: SparkSession, path: str) -> DataFrame:
    """Distinct words of a text file; any whitespace separates words."""
    return (
        spark.read.text(path)
        .select(F.explode(F.split("value", r"\s+")).alias("word"))
        .filter("word != ''")
        .distinct()
    )


def literal_words(words: DataFrame, limit: int = MAX_LITERAL_WORDS) -> frozenset[str] | None:
    """The list as a Python set when it has at most ``limit`` words, else None."""
    rows = words.limit(limit + 1).collect()
    return None if len(rows) > limit else frozenset(r[0] for r in rows)


def drop_words(
    df: DataFrame,
    cleaned: str,
    words: DataFrame,
    limit: int = MAX_LITERAL_WORDS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``df`` with the listed words out of ``cleaned``; rows left empty go.

    A short list becomes a hash set inside the expression: no shuffle.  A longer
    one is looked up token by token, where frequent tokens meet a broadcast part
    of the vocabulary and stay where they are; then the texts are put together
    again in order, one per row.  Both ways give the same rows with all columns.
    """
    listed = literal_words(words, limit)
    if listed is not None:
        kept = F.array_join(remove_stopwords(tokenize(cleaned), listed), " ")
        emptied = df.withColumn(cleaned, F.array_remove(F.array(kept), ""))
        return emptied.withColumn(cleaned, F.explode(cleaned))
    # Row numbers are written with the rows, so they stay the same in every reader.
    rows = materialize(df.withColumn("_row", F.monotonically_increasing_id()), "rows")
    tokens = materialize(
        rows.select("_row", F.posexplode(tokenize(cleaned)).alias("pos", "word")), "tokens"
    )
    vocabulary = tokens.groupBy("word").agg(F.count("*").alias("n"))
    marked = vocabulary.join(words.select("word").distinct().withColumn("listed", F.lit(True)), "word", "left")
    kept = (
        join_lookup(tokens, materialize(marked, "vocabulary"), "word", "n", hot_rows)
        .filter(F.col("listed").isNull())
        .groupBy("_row")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "word"))).alias("kept"))
        .select("_row", F.array_join("kept.word", " ").alias("_kept"))
    )
    return (
        rows.join(kept, "_row")
        .withColumn(cleaned, F.col("_kept"))
        .select(*[F.col(f"`{c}`") for c in df.columns])
    )
