"""Shared-storage helpers: scratch folders and lineage cuts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the session; without one there is none to fall back to."""
    configured = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    return configured.rstrip("/")


def committed_versions(spark: SparkSession, path: str, below: int | None = None) -> list[int]:
    """Versions under ``path`` whose write was finished, in ascending order; a folder that a failed write left is not among them."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/version=*/_SUCCESS")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    versions = sorted(int(status.getPath().getParent().getName().split("=")[1]) for status in found)
    return [version for version in versions if below is None or version < below]


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one run; nothing is written yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so that a lost executor costs no recompute of earlier rounds."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


#: Rows of one task where each row costs a lot, such as building and reading a payload.
ROWS_PER_TASK = 25_000


def spread_evenly(df: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Deal the rows over tasks of at most about ``rows_per_task``, and over all cores.

    Splits follow the row groups of the files, of which a large file may have but a few: all other tasks
    of its scan are empty. The rows are counted first, which reads the footers alone.
    """
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows_per_task)))


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for CPU-heavy work on a scan that came in fewer splits than there are cores.

    A large table has more splits than cores and stays as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
