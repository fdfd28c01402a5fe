"""Hashed TF-IDF vectors, label index and the assembled feature vector (MLlib)."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, StringIndexer, Tokenizer, VectorAssembler
from pyspark.sql import DataFrame

# Vector size and the order of the dense features behind it.
NUM_FEATURES = 5000
DENSE_FEATURES = [
    "f15_word_len_variance",
    "f36_avg_sent_per_para",
    "f57_top50_words_count",
    "f78_perplexity",
]


def hashed_tf(df: DataFrame, cleaned: str = "cleaned_text", size: int = NUM_FEATURES) -> DataFrame:
    """Add ``words`` and their counts in ``size`` hash buckets as ``rawFeatures``."""
    words = Tokenizer(inputCol=cleaned, outputCol="words").transform(df)
    return HashingTF(inputCol="words", outputCol="rawFeatures", numFeatures=size).transform(words)


def fit_tfidf(
    df: DataFrame, fit_on: str = "all", label: str = "label", size: int = NUM_FEATURES
) -> PipelineModel:
    """Fit document frequencies and the label index.

    ``fit_on="all"`` sees every row, as the reference results do; ``"train"``
    keeps validation and test rows out (needs a ``split`` column).
    """
    if fit_on not in ("all", "train"):
        raise ValueError("fit_on must be 'all' or 'train'")
    rows = df if fit_on == "all" else df.filter("split = 'train'")
    return Pipeline(
        stages=[
            Tokenizer(inputCol="cleaned_text", outputCol="words"),
            HashingTF(inputCol="words", outputCol="rawFeatures", numFeatures=size),
            IDF(inputCol="rawFeatures", outputCol="tfidf_features"),
            StringIndexer(inputCol=label, outputCol="label_idx"),
        ]
    ).fit(rows.select("cleaned_text", label))


def assemble(df: DataFrame) -> DataFrame:
    return VectorAssembler(
        inputCols=["tfidf_features", *DENSE_FEATURES], outputCol="features"
    ).transform(df)
