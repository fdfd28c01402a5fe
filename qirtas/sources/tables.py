"""Parquet tables: scan, profile and sinks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def scan_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns per table; the counts come from the file footers."""
    rows = [
        df.agg(
            F.lit(name).alias("table_name"),
            F.count("*").alias("n_rows"),
            F.lit(len(df.columns)).cast("long").alias("n_columns"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Overwrite ``path`` with snappy Parquet.

    With ``partition_by`` the rows are not moved first: each task writes into
    every partition folder, so a folder that gets most of the rows is still
    written by all tasks and not by one.
    """
    writer = df.write.mode("overwrite").option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
