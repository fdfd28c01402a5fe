"""Session builder for tests, the benchmark and interactive use.

On a cluster the session comes from spark-submit; nothing in the library
depends on the values set here.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: int | None = None, app: str = "qirtas") -> SparkSession:
    n = cores or os.cpu_count() or 4
    spark = (
        SparkSession.builder.master(f"local[{n}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.driver.memory", os.environ.get("QIRTAS_DRIVER_MEMORY", "12g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
