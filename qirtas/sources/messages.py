"""JSON messages: sampling, encoding, decoding and the broker sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qirtas.operators.skew import first_in_order

# The message schema, the sample size and the text length.
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("id", T.IntegerType()),
    ]
)
SAMPLE_ROWS = 100
MAX_CHARS = 500


def numbered_sample(
    df: DataFrame, key: str, n: int = SAMPLE_ROWS, max_chars: int | None = MAX_CHARS, text: str = "text"
) -> DataFrame:
    """A reproducible sample: the n rows with the smallest key digests, numbered 0..n-1 as ``id``.

    Texts are cut before rows move; ``n`` may be as large as the table.
    """
    if max_chars is not None and text in df.columns:
        df = df.withColumn(text, F.substring(text, 1, max_chars))
    return first_in_order(df, key, n)


def encode(text: Column, label: Column, id: Column, max_chars: int | None = MAX_CHARS) -> Column:
    """``{"text", "label", "id"}`` as JSON; nulls stay null, non-ASCII stays readable."""
    body = text if max_chars is None else F.substring(text, 1, max_chars)
    message = F.struct(body.alias("text"), label.alias("label"), id.cast("int").alias("id"))
    return F.to_json(message, {"ignoreNullFields": "false"})


def decode(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Binary or string ``value`` to text, label, id; a malformed value gives nulls."""
    data = F.from_json(F.col("value").cast("string"), MESSAGE_SCHEMA).alias("data")
    return df.select(*keep, data).select(*keep, "data.*")


def write_to_kafka(df: DataFrame, servers: str, topic: str) -> None:
    """Send a ``value`` column to one topic (needs the Kafka connector on the classpath)."""
    (
        df.select("value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
