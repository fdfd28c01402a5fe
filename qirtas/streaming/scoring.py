"""The scoring stream: source -> decode -> light clean -> rule -> append sink.

The transformation is the one used on batch tables; only source and sink differ.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BinaryType, StructField, StructType

from qirtas.functions.lexicons import RULE_WORDS
from qirtas.functions.rules import rule_label
from qirtas.functions.text import stream_clean
from qirtas.sources.messages import decode

VALUE_SCHEMA = StructType([StructField("value", BinaryType())])


def kafka_source(
    spark: SparkSession, servers: str, topic: str, starting_offsets: str = "latest"
) -> DataFrame:
    """One topic (needs the Kafka connector on the classpath)."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .load()
    )


def file_source(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files with a binary ``value`` column, as a broker would deliver it."""
    reader = spark.readStream.schema(VALUE_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def score(messages: DataFrame, lexicon: Iterable[str] = RULE_WORDS) -> DataFrame:
    """id, label, prediction, timestamp; every message gives exactly one row."""
    cleaned = decode(messages).withColumn("cleaned", stream_clean("text"))
    return cleaned.select(
        "id",
        "label",
        rule_label("cleaned", lexicon).alias("prediction"),
        F.current_timestamp().alias("timestamp"),
    )


def append_to(
    scored: DataFrame,
    checkpoint: str,
    path: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Start the append query: Parquet files under ``path``, else the console."""
    writer = scored.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if path is None:
        writer = writer.format("console").option("truncate", False)
    else:
        writer = writer.format("parquet").option("path", path)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def append_batches(
    scored: DataFrame, checkpoint: str, path: str, written: Callable[[int], None] = lambda batch: None
) -> StreamingQuery:
    """Start a query that writes each micro-batch under ``path/batch=N``, all of it with one time.

    A batch that runs again, because the stream was cut between this write and its
    own commit, replaces what it wrote before.  ``written`` is called in between.
    """

    def sink(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")
        written(batch)

    writer = scored.writeStream.option("checkpointLocation", checkpoint).foreachBatch(sink)
    return writer.trigger(availableNow=True).start()


def run_available(
    scored: DataFrame, checkpoint: str, path: str, timeout: float | None = None
) -> None:
    """Process what is there and stop; a rerun resumes from the checkpoint.

    Raises TimeoutError if the time was too short; what was written stays right.
    """
    query = append_to(scored, checkpoint, path, available_now=True)
    try:
        ended = query.awaitTermination() if timeout is None else query.awaitTermination(timeout)
    finally:
        query.stop()
    if ended is False:
        raise TimeoutError(f"not everything was processed in {timeout} seconds; run it again")
