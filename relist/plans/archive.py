"""Archive run: expired raw rows into verified monthly batches, then out of the raw table."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relist.operators.archiving import BATCH_ROWS, RETENTION_DAYS, assign_batches, cutoff, expired, summarize_batches
from relist.runtime import committed_versions, cut_lineage
from relist.schemas import LEDGER_SCHEMA
from relist.sources.archive_store import read_batches, verify_batches, without_archived, write_batches
from relist.sources.feed import live_raw
from relist.sources.state import SUCCESS, ledger_current, ledger_finished, ledger_started


def archived_ids(spark: SparkSession, out: str) -> DataFrame:
    """raw_id of every row in a batch that the ledger under ``out`` records as a success."""
    versions = committed_versions(spark, f"{out}/archived_ids")
    if not versions:
        return spark.createDataFrame([], "raw_id string")
    ids = spark.read.schema("batch_id string, raw_id string").parquet(*(f"{out}/archived_ids/version={v}" for v in versions))
    ledger = ledger_current(spark.read.schema(LEDGER_SCHEMA).parquet(f"{out}/ledger"))
    return ids.join(ledger.where(F.col("status") == SUCCESS).select(F.col("id").alias("batch_id")), "batch_id", "left_semi").select("raw_id")


@dataclass
class ArchiveRun:
    ledger: DataFrame
    archived: DataFrame
    remaining: DataFrame


def run_archive(
    spark: SparkSession,
    raw: DataFrame,
    out: str,
    now: Column,
    retention_days: int = RETENTION_DAYS,
    batch_rows: int = BATCH_ROWS,
    prefix: str = "",
    run_id: str | None = None,
) -> ArchiveRun:
    """Archive what expired; success is recorded before anything counts as deleted.

    The batches of a failed write are recorded as failed, their rows stay, and the error is raised.
    The ids of each batch are written before the batch is, so that a success in the ledger is all it
    takes to count its rows as deleted: rows of earlier successes are left out here, whatever became
    of the run that archived them.
    """
    run_id = uuid.uuid4().hex if run_id is None else run_id
    files, ledger_path = f"{out}/archive/run={run_id}", f"{out}/ledger"
    raw = live_raw(raw, archived_ids(spark, out))
    batched = cut_lineage(assign_batches(expired(raw, cutoff(now, retention_days)), batch_rows, run_id))
    summary = cut_lineage(summarize_batches(batched, prefix))
    batched.select("batch_id", "raw_id").write.mode("overwrite").parquet(f"{out}/archived_ids/version={uuid.uuid4().int % 10**15}")
    ledger_started(summary).write.mode("append").parquet(ledger_path)
    if summary.isEmpty():
        return ArchiveRun(ledger_current(spark.read.parquet(ledger_path)), batched.select("raw_id"), raw)
    try:
        write_batches(batched, files)
        checked = verify_batches(batched, read_batches(spark, files))
        checked = cut_lineage(checked.select(F.col("batch_id").alias("id"), "verified"))
    except Exception:
        ledger_finished(summary, F.lit(False), now).write.mode("append").parquet(ledger_path)
        raise
    closed = ledger_finished(summary.join(checked, "id"), F.col("verified"), now)
    closed.write.mode("append").parquet(ledger_path)

    succeeded = checked.where("verified").select(F.col("id").alias("batch_id"))
    archived = batched.join(succeeded, "batch_id", "left_semi").select("raw_id")
    return ArchiveRun(ledger_current(spark.read.parquet(ledger_path)), archived, without_archived(raw, archived))
