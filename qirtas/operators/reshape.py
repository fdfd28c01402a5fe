"""From wide source tables to one labelled row per text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The columns of the wide tables and the generation methods.
HUMAN_COLUMN = "original_abstract"
AI_COLUMNS = [
    "allam_generated_abstract",
    "jais_generated_abstract",
    "llama_generated_abstract",
    "openai_generated_abstract",
]
METHODS = ["by_polishing", "from_title", "from_title_and_content"]


def unpivot_sources(wide: DataFrame, ids: tuple[str, ...] = ("generation_method",)) -> DataFrame:
    """One row per non-null text; absent columns are skipped, empty texts are kept."""
    present = [c for c in [HUMAN_COLUMN, *AI_COLUMNS] if c in wide.columns]
    long = wide.unpivot(list(ids), present, "source_column", "text")
    human = F.col("source_column") == HUMAN_COLUMN
    return long.filter(F.col("text").isNotNull()).select(
        *[c for c in ids if c != "generation_method"],
        "text",
        F.when(human, "human").otherwise("ai").alias("label"),
        "generation_method",
        F.when(human, "human")
        .otherwise(F.regexp_replace("source_column", "_generated_abstract$", ""))
        .alias("source_model"),
    )


def union_splits(splits: dict[str, DataFrame]) -> DataFrame:
    """Append the tables of all methods, tagged with the method name; no dedup."""
    tagged = [df.withColumn("generation_method", F.lit(name)) for name, df in splits.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
