"""Selection and batching of expired raw rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relist.functions.times import plus_days
from relist.runtime import cut_lineage
from relist.sources.archive_store import object_key

# Retention and rows per batch.
RETENTION_DAYS = 60
BATCH_ROWS = 5000


def cutoff(now: Column, retention_days: int = RETENTION_DAYS) -> Column:
    return plus_days(now, -retention_days)


def expired(raw: DataFrame, before: Column) -> DataFrame:
    return raw.where(F.col("ingested_at") < before)


def number_rows(rows: DataFrame, *order: str) -> DataFrame:
    """Add ``row_index``, the 0-based place in the global ``order`` (which must be unique).

    Rows are range-partitioned and sorted once; the counts of the partitions before give the offset.
    No window ever sees more than one row per partition, however many rows share a time.
    """
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    marked = cut_lineage(
        sorted_rows.withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_id", 33))
        .withColumn("_place", F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_id")
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        marked.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        marked.join(offsets, "_part")
        .withColumn("row_index", F.col("_offset") + F.col("_place"))
        .drop("_part", "_place", "_offset")
    )


def assign_batches(rows: DataFrame, batch_rows: int = BATCH_ROWS, run_id: str = "run") -> DataFrame:
    """Chunk rows in (ingested_at, raw_id) order, cut at month changes: adds year, month and batch_id."""
    chunk = F.floor(F.col("row_index") / F.lit(batch_rows)).cast("bigint")
    year, month = F.year("ingested_at"), F.month("ingested_at")
    return (
        number_rows(rows, "ingested_at", "raw_id")
        .withColumns({"year": year, "month": month})
        .withColumn("batch_id", F.format_string(f"{run_id}-%d-%d%02d", chunk, year, month))
        .drop("row_index")
    )


def expired_scan(rows: DataFrame, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """Expired rows with the number of the bounded batch each belongs to."""
    numbered = number_rows(rows, "ingested_at", "raw_id")
    return numbered.withColumn("batch_no", F.floor(F.col("row_index") / F.lit(batch_rows)).cast("bigint")).drop("row_index")


def summarize_batches(batched: DataFrame, prefix: str = "") -> DataFrame:
    """Ledger entry of each batch: time bounds, row count and object key."""
    return (
        batched.groupBy("batch_id", "year", "month")
        .agg(
            F.min("ingested_at").alias("from_ingested_at"),
            F.max("ingested_at").alias("to_ingested_at"),
            F.count("*").alias("documents_count"),
        )
        .select(
            F.col("batch_id").alias("id"),
            "year",
            "month",
            "from_ingested_at",
            "to_ingested_at",
            "documents_count",
            object_key(prefix, F.col("year"), F.col("month"), F.col("batch_id")).alias("s3_path"),
        )
    )
