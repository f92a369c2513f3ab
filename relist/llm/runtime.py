"""Materialised steps, size-checked broadcasts and small helpers shared by the operators."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from relist.runtime import cut_lineage, scratch_path

#: A key table of at most this many rows (some tens of MB) is sent to every executor; a larger one is joined by a shuffle.
BROADCAST_ROWS = 500_000

#: A batch with more bytes is worked through in slices, so that what a task holds for it does not grow with the length of texts.
SLICE_BYTES = 4_000_000
_SHARED: list[Broadcast] = []

__all__ = ["BROADCAST_ROWS", "bounded", "column", "cut_lineage", "discard", "map_rows", "release", "scratch_folder", "shared", "sliced", "small_batches", "split_evenly", "stored", "texts"]


def shared(spark: SparkSession, value: object) -> Broadcast:
    """``value`` on every executor, until ``release`` takes it off."""
    sent = spark.sparkContext.broadcast(value)
    _SHARED.append(sent)
    return sent


def release(spark: SparkSession) -> None:
    """Take models off the executors, and let Spark delete the shuffle files of steps that nothing refers to any more.

    For use between steps whose results are written: a plan that still needs a model fetches it again from the driver.
    """
    while _SHARED:
        _SHARED.pop().unpersist()
    gc.collect()
    spark._jvm.System.gc()


def bounded(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcasting where its counted rows are within ``limit``; the plan only, never the result, depends on it.

    ``df`` should be materialised and narrow: it is counted here.
    """
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, deleted when the session's JVM ends."""
    path = scratch_path(spark, name)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: like a checkpoint, but columnar and compressed."""
    spark = df.sparkSession
    path = scratch_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*steps: DataFrame) -> None:
    """Delete the files of ``stored`` steps that no plan reads any more, instead of at the end of the session."""
    for step in steps:
        for path in {name.rsplit("/", 1)[0] for name in step.inputFiles()}:
            folder = step.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(step.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def split_evenly(df: DataFrame) -> DataFrame:
    """Use all cores on a scan that came in fewer splits than there are; larger scans stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return small_batches(df.repartition(cores) if df.rdd.getNumPartitions() < cores else df)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def texts(batch: pa.RecordBatch, name: str = "text") -> Iterator[str]:
    """The texts of a batch one by one, null as empty; no second copy of the batch is held."""
    for value in column(batch, name):
        yield value.as_py() or ""


def sliced(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of at most ``SLICE_BYTES``, or of one row."""
    if batch.nbytes <= SLICE_BYTES or batch.num_rows <= 1:
        yield batch
    else:
        half = batch.num_rows // 2
        yield from sliced(batch.slice(0, half))
        yield from sliced(batch.slice(half))


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, its session sending texts to Python by a thousand rows at once, unless it has a number of its own: both sides hold whole batches, outside of what Spark accounts for."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if df.sparkSession.conf.get(name) == "10000":
        df.sparkSession.conf.set(name, "1000")
    return df


def map_rows(df: DataFrame, schema: str, function: Callable[[pa.RecordBatch], dict[str, object] | None]) -> DataFrame:
    """Apply ``function`` to every Arrow batch, or to its slices if it is large; it returns the columns of ``schema``."""
    target = StructType.fromDDL(schema)
    arrow = to_arrow_schema(target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in sliced(whole):
                columns = function(batch)
                if columns is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in arrow], schema=arrow)
        pa.default_memory_pool().release_unused()

    return small_batches(df).mapInArrow(run, target)
