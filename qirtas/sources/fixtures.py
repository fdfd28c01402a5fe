"""The domain's tables, derived from the generic test tables.

The test documents hold no Arabic script, so the text is transliterated letter
by letter.  The mapping produces every case the cleaner handles: diacritics,
alef and hamza variants and Arabic punctuation; newlines survive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qirtas.functions.text import BATCH, STREAM, fold_words
from qirtas.operators.reshape import AI_COLUMNS, HUMAN_COLUMN, METHODS
from qirtas.sources.messages import encode
from qirtas.storage import materialize_once, spread

LATIN = "abcdefghijklmnopqrstuvwxyz?,;äöüßéèêñóíáçà"
ARABIC = (
    "أبةدىفغهئجكلمنإقرستؤوشخيزا؟،؛"
    "\u064B\u064C\u064D\u064E\u064F\u0650\u0651\u0652"
    "آعحصض"
)


def transliterate(col: Column | str) -> Column:
    return F.translate(F.lower(col), LATIN, ARABIC)


def to_arabic(words: str) -> list[str]:
    return words.lower().translate(str.maketrans(LATIN, ARABIC)).split()


# Common words of the four languages of the test documents.
LEXICON = to_arabic("the of and in to that der die und le la de el que en was with for")
BATCH_LEXICON = sorted(fold_words(LEXICON, BATCH))
STREAM_LEXICON = sorted(fold_words(LEXICON, STREAM))
# Stored un-normalised on purpose: words with a folded letter never match
# unless the list is folded first.
STOPWORDS = to_arabic("is by this be he not les des une das von mit los las por para are")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, transliterated text, source: the raw table, written once."""

    def build() -> DataFrame:
        raw = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
        return spread(raw, "doc_id").withColumn("text", transliterate("text"))

    return materialize_once(spark, f"{sf_dir}/documents", build)


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text, label, generation_method, source_model; written once.

    An equi-join on two unique keys; the optimizer broadcasts the label side
    only while its file size is under the session's broadcast threshold.
    """

    def build() -> DataFrame:
        labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
        joined = documents(spark, sf_dir).join(labels, "doc_id")
        return joined.select(
            "doc_id",
            "text",
            F.when(F.col("quality") == 1, "ai").otherwise("human").alias("label"),
            _method(F.col("doc_id")).alias("generation_method"),
            F.col("source").alias("source_model"),
        )

    return materialize_once(spark, f"{sf_dir}/labelled", build)


def all_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its label, null where it has none."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    label = F.when(F.col("quality") == 1, "ai").when(F.col("quality").isNotNull(), "human")
    joined = documents(spark, sf_dir).join(labels, "doc_id", "left")
    return joined.select("doc_id", "text", label.alias("label"), F.col("source").alias("source_model"))


def wide_abstracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as wide rows: five turns fill the five text columns; written once."""
    return materialize_once(spark, f"{sf_dir}/wide", lambda: _wide(spark, sf_dir))


def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "text")
    slots = [HUMAN_COLUMN, *AI_COLUMNS]
    width = len(slots)
    return (
        turns.groupBy("conv_id", F.floor(F.col("turn") / width).alias("part"))
        .agg(
            *[
                F.max(F.when(F.col("turn") % width == k, F.col("text"))).alias(name)
                for k, name in enumerate(slots)
            ]
        )
        .withColumn("generation_method", _method(F.col("conv_id")))
    )


def _method(key: Column) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in METHODS]), (key % len(METHODS) + 1).cast("int"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broker-like messages: JSON of every document, and raw web pages as bad lines.

    ``source_id`` tells where a message came from; ``value`` is binary as in Kafka.
    """
    docs = documents(spark, sf_dir).select(
        F.col("doc_id").alias("source_id"),
        encode(F.col("text"), F.col("source"), F.col("doc_id"), max_chars=None).alias("value"),
    )
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select(
        F.col("page_id").alias("source_id"), F.col("html").alias("value")
    )
    return docs.unionByName(pages).withColumn("value", F.col("value").cast("binary"))
