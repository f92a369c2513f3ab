"""Small state tables: cursors, backfill progress and the archive ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from relist.runtime import committed_versions
from relist.schemas import LEDGER_SCHEMA

# Ledger states and the first month of a backfill.
IN_PROGRESS, SUCCESS, FAILED = "in_progress", "success", "failed"
BACKFILL_START = "2024-07-10 00:00:00"


def upsert_cursors(stored: DataFrame, changed: DataFrame) -> DataFrame:
    """Cursors by site; a changed site takes its new value."""
    return (
        stored.select("site", F.col("ts").alias("old_ts"))
        .join(changed.select("site", F.col("ts").alias("new_ts")), "site", "full_outer")
        .select("site", F.coalesce("new_ts", "old_ts").alias("ts"))
    )


def ordered_sites(cursors: DataFrame) -> DataFrame:
    return cursors.select("site").orderBy("site")


def write_state(state: DataFrame, path: str, version: int) -> None:
    """Write a whole small table under a version of its own; readers take the newest complete one."""
    state.coalesce(1).write.mode("overwrite").parquet(f"{path}/version={version}")


def read_version(spark: SparkSession, path: str, version: int | None, schema: StructType | str) -> DataFrame:
    """One version of a table with its declared types; no version is an empty table."""
    return spark.createDataFrame([], schema) if version is None else spark.read.schema(schema).parquet(f"{path}/version={version}")


def read_state(spark: SparkSession, path: str, schema: StructType | str, below: int | None = None) -> DataFrame:
    """The newest finished version (below ``below``, if given); empty where there is none."""
    versions = committed_versions(spark, path, below)
    return read_version(spark, path, versions[-1] if versions else None, schema)


def site_windows(uploads: DataFrame, markers: DataFrame) -> DataFrame:
    """Per uploaded site what a match run does, and the window it covers."""
    upload, marker = F.col("upload_ts"), F.col("marker_ts")
    return (
        uploads.select("site", F.col("ts").alias("upload_ts"))
        .join(markers.select("site", F.col("ts").alias("marker_ts")), "site", "left")
        .select(
            "site",
            marker.alias("lower_bound"),
            upload.alias("upper_bound"),
            F.when(upload.isNull(), "skip_missing")
            .when(marker.isNull(), "init")
            .when(marker >= upload, "skip_caught_up")
            .otherwise("run")
            .alias("status"),
        )
    )


def advance_markers(markers: DataFrame, windows: DataFrame, processed: DataFrame) -> DataFrame:
    """Markers after a run: new sites start at their upload cursor, run sites at their last row."""
    started = windows.where(F.col("status") == "init").select("site", F.col("upper_bound").alias("ts"))
    last = processed.groupBy(F.col("site_name").alias("site")).agg(F.max("offer_start").alias("ts"))
    return upsert_cursors(markers, started.unionByName(last.where(F.col("ts").isNotNull())))


def advance_backfill(stored: DataFrame, finished: DataFrame, now: Column) -> DataFrame:
    """Backfill progress by site: ``finished(site, next_from, reset_completed)`` overwrite what they set.

    A site seen for the first time starts at the fixed first month.
    """
    old = stored.select(
        "site",
        F.col("next_from").alias("old_next"),
        F.col("reset_completed").alias("old_reset"),
        F.col("updated_at").alias("old_updated"),
    )
    new = finished.select(
        "site", F.col("next_from").alias("new_next"), F.col("reset_completed").alias("new_reset"), F.lit(True).alias("touched")
    )
    return old.join(new, "site", "full_outer").select(
        "site",
        F.coalesce("new_next", "old_next", F.lit(BACKFILL_START).cast("timestamp_ntz")).alias("next_from"),
        F.coalesce("new_reset", "old_reset", F.lit(False)).alias("reset_completed"),
        F.when(F.col("touched"), now).otherwise(F.col("old_updated")).alias("updated_at"),
    )


def _ledger_rows(rows: DataFrame) -> DataFrame:
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in LEDGER_SCHEMA.fields])


def ledger_started(batches: DataFrame) -> DataFrame:
    return _ledger_rows(
        batches.select(
            "id",
            "from_ingested_at",
            "to_ingested_at",
            F.lit(None).alias("archived_at"),
            F.lit(None).alias("s3_path"),
            F.lit(0).alias("documents_count"),
            F.lit(IN_PROGRESS).alias("status"),
            F.lit(0).alias("seq"),
        )
    )


def ledger_finished(batches: DataFrame, verified: Column, archived_at: Column) -> DataFrame:
    """Closing rows: success keeps path, count and time, a failure none of them."""
    return _ledger_rows(
        batches.select(
            "id",
            "from_ingested_at",
            "to_ingested_at",
            F.when(verified, archived_at).alias("archived_at"),
            F.when(verified, F.col("s3_path")).alias("s3_path"),
            F.when(verified, F.col("documents_count")).otherwise(F.lit(0)).alias("documents_count"),
            F.when(verified, F.lit(SUCCESS)).otherwise(F.lit(FAILED)).alias("status"),
            F.lit(1).alias("seq"),
        )
    )


def ledger_current(transitions: DataFrame) -> DataFrame:
    """Latest row per batch; a success is never undone by a later failure."""
    rank = F.when(F.col("status") == SUCCESS, 2).when(F.col("status") == FAILED, 1).otherwise(0)
    whole = F.struct(*[F.col(f.name) for f in LEDGER_SCHEMA.fields if f.name != "seq"])
    return transitions.groupBy("id").agg(F.max_by(whole, F.struct(rank, F.col("seq"))).alias("row")).select("row.*")


def archive_high_water_mark(ledger: DataFrame) -> DataFrame:
    return ledger.where(F.col("status") == SUCCESS).agg(F.max("to_ingested_at").alias("to_ingested_at"))
