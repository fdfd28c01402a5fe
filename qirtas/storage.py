"""Shared-folder tables: the one place where lineage is cut.

Iterative fits and multi-pass operators read a written table instead of a
cached one, so a lost executor costs a re-read and not a recomputation of the
whole chain.  The folder is the one the cluster names in
``spark.checkpoint.dir``.  Only a local master may fall back to a temporary
folder, because there every task sees the same disk.  On a cluster a path of the
local file system may be a mounted share or each machine's own disk: it is tried.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if folder and not spark.sparkContext.master.startswith("local") and is_local(spark, folder):
        require_mounted(spark, folder.rstrip("/"))
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="qirtas-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def is_local(spark: SparkSession, folder: str) -> bool:
    """Is the folder one of the local file system?  One without a scheme is of the default file system."""
    if ":/" not in folder:
        folder = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    return folder.startswith("file:")


_tried: dict[tuple[str, str], int] = {}


def require_mounted(spark: SparkSession, folder: str) -> None:
    """Refuses a folder of the local file system unless it is one and the same for the driver and the executors.

    Tried once per application, and again when it has more cores than at the last trial.
    """
    cause = None
    try:
        application, cores = spark.sparkContext.applicationId, spark.sparkContext.defaultParallelism
        tried = _tried.get((application, folder), 0)
        mounted = tried >= cores or is_mounted(spark, f"{folder}/{application}/trial-{uuid.uuid4().hex}", cores)
    except Exception as error:  # noqa: BLE001
        mounted, cause = False, error
    if not mounted:
        raise RuntimeError(f"{folder} is a local folder; {_SETTING} must be one that every executor can reach") from cause
    _tried[application, folder] = max(cores, tried)


def is_mounted(spark: SparkSession, path: str, cores: int) -> bool:
    """Are rows that tasks on all cores write there found by the driver and read by tasks again?

    What an executor writes on its own disk is missing when the driver commits the table.
    """
    spark.range(0, cores, 1, cores).write.parquet(path)
    return spark.read.schema("id long").parquet(path).count() == cores


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path under the folder of this application.

    Written tables stay until that folder is removed after the run: a result
    may still be read lazily when the function that wrote its input returns.
    """
    application = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/{application}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def is_written(spark: SparkSession, path: str) -> bool:
    """Is the table, written to its end, still there?  The shared folder may be emptied while a session goes on."""
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


_written: dict[tuple[str, str], tuple[str, StructType]] = {}


def materialize_once(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Like ``materialize``, but one written table per application and name, again if it is gone."""
    key = (spark.sparkContext.applicationId, name)
    if key not in _written or not is_written(spark, _written[key][0]):
        df = build()
        path = fresh_path(spark, name.rsplit("/", 1)[-1])
        df.write.parquet(path)
        _written[key] = (path, df.schema)
    path, schema = _written[key]
    return spark.read.schema(schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Repartition by key when the scan has fewer splits than the cluster has cores.

    One small file with one row group is read by one task; the CPU-heavy text
    work behind it would then use one core.  Large inputs have more splits than
    cores and pass through untouched, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)
