"""Monthly gzip JSON-lines archive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def object_key(prefix: str, year: Column, month: Column, batch_id: Column) -> Column:
    folder = prefix.strip("/")
    head = f"{folder}/" if folder else ""
    return F.format_string(head + "%d/%02d/part-%s.jsonl.gz", year, month, batch_id)


def write_batches(rows: DataFrame, path: str) -> None:
    """One gzip file per (year, month, batch_id); rows of a batch meet in one task, a batch is bounded."""
    documents = [name for name in rows.columns if name not in ("year", "month", "batch_id")]
    (
        rows.select("year", "month", "batch_id", F.to_json(F.struct(*documents)).alias("value"))
        .repartition("batch_id")
        .write.mode("overwrite")
        .partitionBy("year", "month", "batch_id")
        .option("compression", "gzip")
        .text(path)
    )


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """Archived lines with their batch; partition values stay text."""
    return spark.read.schema("value string, year int, month int, batch_id string").text(path)


def batch_checksums(lines: DataFrame) -> DataFrame:
    """Order-free fingerprint of each batch."""
    return lines.groupBy("batch_id").agg(
        F.count("*").alias("lines"), F.bit_xor(F.xxhash64("value")).alias("checksum")
    )


def verify_batches(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """(batch_id, verified): the stored lines equal the lines meant to be stored."""
    documents = [name for name in rows.columns if name not in ("year", "month", "batch_id")]
    meant = batch_checksums(rows.select("batch_id", F.to_json(F.struct(*documents)).alias("value")))
    found = batch_checksums(stored).select(
        "batch_id", F.col("lines").alias("found_lines"), F.col("checksum").alias("found_checksum")
    )
    return meant.join(found, "batch_id", "left").select(
        "batch_id",
        "lines",
        (
            F.col("lines").eqNullSafe(F.col("found_lines")) & F.col("checksum").eqNullSafe(F.col("found_checksum"))
        ).alias("verified"),
    )


def without_archived(raw: DataFrame, archived: DataFrame) -> DataFrame:
    """Raw rows left after the archived ids are deleted."""
    return raw.join(archived.select("raw_id"), "raw_id", "left_anti")
