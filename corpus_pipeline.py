"""From raw documents to packed sequences, each stage a written table.

Documents that the quality rules reject go and the others lose their failing
lines; documents that the classifier scores under one half go; of each group of
near copies the one with the smallest id stays; passages that repeat across
documents go from all but the first; what is left is packed.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from qirtas.llm import common, mil_classifier, ngram_join, packing, quality_rules, substring_dedup
from qirtas.storage import materialize


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.clean_documents(docs)


def classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mil_classifier.keep_good(docs, common.table(spark, sf_dir, "labels"))


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs)


def passages_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring_dedup.cut_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", rules_stage),
    ("quality classifier", classifier_stage),
    ("n-gram Jaccard join", near_copies_stage),
    ("substring dedup", passages_stage),
    ("packing", packing_stage),
]
# Fits, near copies, rolling hashes and tokens are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
