"""Train / validation / test assignment by key hash.

Unlike a seeded random split the part of a row depends on its key alone, so it
survives repartitioning, retries and growth of the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 70 / 15 / 15 percent.
TRAIN_BELOW, VAL_BELOW = 70, 85


def split_bucket(key: Column | str) -> Column:
    digest = F.md5((F.col(key) if isinstance(key, str) else key).cast("string"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 100


def assign_split(df: DataFrame, key: str) -> DataFrame:
    bucket = split_bucket(key)
    return df.withColumn(
        "split",
        F.when(bucket < TRAIN_BELOW, "train").when(bucket < VAL_BELOW, "val").otherwise("test"),
    )
