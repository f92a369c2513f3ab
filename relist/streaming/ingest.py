"""Incremental ingestion of landed feed responses, site by site.

A page that cannot be read, or an ad without a check time, is a row of the fault table and stops its site alone:
what else the site delivered is kept, its cursor stays. All other sites move on. A site whose cursor
has reached the upper bound of the run is not taken further; its pages wait for a run with a later bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from relist.functions.payload import is_object, text
from relist.functions.times import checked_datetime
from relist.operators.mapping import map_listings, parse_payload, split_invalid
from relist.runtime import path_exists
from relist.schemas import CURSOR_SCHEMA, FAULT_SCHEMA, PAGE_SCHEMA, SITE_RUN_SCHEMA
from relist.sources.feed import UNREADABLE, page_items, raw_envelope
from relist.sources.state import read_state, read_version, write_state
from relist.sources.tables import append_listings, latest_per_key

#: Arrival of an ad: when and in which file its page came, the page (by its newest check time), and its place there.
ARRIVAL = ("file_time", "file", "page_checked", "page_id", "position")
STAGED = "site string, file string, file_time timestamp, page_id string, position int, payload string, checked string, reason string, page_checked timestamp_ntz"


def read_landing(spark: SparkSession, landing: str, files_per_batch: int = 1000) -> DataFrame:
    """Stream of landed responses, one JSON document per line under ``site=<name>`` folders."""
    return (
        spark.readStream.schema("value string, site string")
        .option("maxFilesPerTrigger", files_per_batch)
        .text(landing)
        .select("site", F.col("value").alias("body"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("file_time"))
    )


def named_pages(pages: DataFrame, batch_id: int) -> DataFrame:
    """``pages(site, body)``, with ``file`` and ``file_time`` if known, as ``PAGE_SCHEMA``.

    The name of a page follows from where it came from and what it says, so a replay gives it again;
    equal pages of one file are numbered.
    """
    missing = {"file": F.lit("").alias("file"), "file_time": F.lit(None).cast("timestamp").alias("file_time")}
    pages = pages.select("site", "body", *(F.col(name) if name in pages.columns else column for name, column in missing.items()))
    digest = F.sha2(F.concat_ws("\n", F.lit(str(batch_id)), "site", "file", F.coalesce("body", F.lit(""))), 256)
    alike = Window.partitionBy("page_digest").orderBy(F.lit(0))
    numbered = pages.withColumn("page_digest", digest).withColumn("copy", F.row_number().over(alike))
    page_id = F.concat("page_digest", F.when(F.col("copy") > 1, F.concat(F.lit("-"), F.col("copy").cast("string"))).otherwise(""))
    return numbered.select("site", "body", "file", "file_time", page_id.alias("page_id"))


def staged_ads(pages: DataFrame) -> DataFrame:
    """A row per ad of each page, or one without an ad for a page that has none, with the reason of a fault; as ``STAGED``."""
    where = ("site", "file", "file_time", "page_id")
    opened = page_items(pages).select(*where, "body", "page_error", F.filter("items", is_object).alias("ads"))
    ads = opened.select(*where, "body", "page_error", F.posexplode_outer("ads").alias("position", "ad"))
    checked = text(F.col("ad"), "checked")
    reason = F.coalesce(F.col("page_error"), F.when(F.col("ad").isNotNull() & checked_datetime(checked).isNull(), F.lit(UNREADABLE)))
    ads = ads.select(*where, "position", F.when(F.col("page_error").isNull(), F.to_json("ad")).otherwise(F.col("body")).alias("payload"), checked.alias("checked"), reason.alias("reason"))
    newest = F.max(checked_datetime(F.col("checked"))).over(Window.partitionBy("page_id"))
    return ads.withColumn("page_checked", newest)


def persist_batch(
    pages: DataFrame, batch_id: int, out: str, ingested_at: Column | None = None, strict: bool = False, load_till: Column | None = None
) -> None:
    """Write one micro-batch: raw rows, faults, listings, pages that wait, what became of each site, and last the cursors.

    A failure at any step leaves the cursors alone and the batch is replayed. Every step writes to
    a folder of this batch that a replay overwrites and reads what earlier batches finished, so a replay
    adds no second copy and gives rows the same ``raw_id``.
    """
    spark = pages.sparkSession
    ingested_at = F.localtimestamp() if ingested_at is None else ingested_at
    cursors = load_cursors(spark, out, batch_id)
    waiting = read_state(spark, f"{out}/waiting", PAGE_SCHEMA, batch_id)
    arrived = named_pages(pages, batch_id).unionByName(waiting)
    bound = F.lit(None).cast("timestamp_ntz") if load_till is None else load_till
    full = cursors.where(F.col("ts") >= bound).select("site")
    arrived.join(F.broadcast(full), "site", "left_semi").write.mode("overwrite").parquet(f"{out}/waiting/version={batch_id}")

    taken = arrived.join(F.broadcast(full), "site", "left_anti")
    staged_ads(taken).write.mode("overwrite").parquet(f"{out}/staged/version={batch_id}")
    staged = read_version(spark, f"{out}/staged", batch_id, STAGED)
    faults = staged.where(F.col("reason").isNotNull())
    faults.select("site", "file", "page_id", "position", "reason", F.col("payload").alias("content")).write.mode("overwrite").parquet(f"{out}/faults/version={batch_id}")

    raw_id = F.concat("page_id", F.lit(":"), F.col("position").cast("string"))
    ads = parse_payload(staged.where(F.col("position").isNotNull())).withColumn("raw_id", raw_id)
    raw = raw_envelope(ads, F.col("site"), ingested_at, F.create_map(F.lit("site"), F.col("site")), F.col("raw_id"))
    raw.write.mode("overwrite").partitionBy("source").parquet(f"{out}/raw/batch={batch_id}")

    valid, invalid = split_invalid(ads.withColumnRenamed("site", "source").withColumn("ingested_at", ingested_at), strict)
    if not strict:
        invalid.select("raw_id", "source", "invalid_reasons").write.mode("overwrite").parquet(f"{out}/quarantine/batch={batch_id}")
    mapped = map_listings(valid, ingested_at, keep=ARRIVAL)
    latest = latest_per_key(mapped, "doc_id", *ARRIVAL).drop(*ARRIVAL)
    append_listings(latest.withColumn("updated_at", ingested_at), f"{out}/listings", batch_id)

    write_state(site_runs(staged, cursors, full), f"{out}/site_runs", batch_id)
    moved = read_version(spark, f"{out}/site_runs", batch_id, SITE_RUN_SCHEMA).where("status = 'ok'")
    write_state(advance(cursors, moved.select("site", F.col("max_checked").alias("ts"))), f"{out}/cursors", batch_id)


def site_runs(staged: DataFrame, cursors: DataFrame, full: DataFrame) -> DataFrame:
    """What a batch did for each site (``SITE_RUN_SCHEMA``): ``ok``, ``failed`` with its first fault, or ``waiting`` at the bound."""
    first_fault = F.min(F.when(F.col("reason").isNotNull(), F.struct(*ARRIVAL, "reason")))["reason"]
    runs = staged.groupBy("site").agg(
        F.count_distinct("page_id").alias("pages"),
        F.count("position").alias("ads"),
        F.count("reason").alias("faults"),
        first_fault.alias("error"),
        F.max(checked_datetime(F.col("checked"))).alias("max_checked"),
    )
    known = cursors.select("site", F.col("ts").alias("cursor_before")).join(full.withColumn("full", F.lit(True)), "site", "left")
    joined = runs.join(known, "site", "full_outer").where("pages is not null or full")
    status = F.when(F.col("full"), "waiting").when(F.col("faults") > 0, "failed").otherwise("ok")
    none = F.lit(0).cast("bigint")
    return joined.select(
        "site",
        status.alias("status"),
        *(F.coalesce(name, none).alias(name) for name in ("pages", "ads", "faults")),
        "error",
        "max_checked",
        "cursor_before",
        F.when(status == "ok", F.greatest("cursor_before", "max_checked")).otherwise(F.col("cursor_before")).alias("cursor_after"),
    )


def load_cursors(spark: SparkSession, out: str, below: int | None = None) -> DataFrame:
    return read_state(spark, f"{out}/cursors", CURSOR_SCHEMA, below)


def load_faults(spark: SparkSession, out: str, batch_id: int) -> DataFrame:
    """Pages and ads that a batch could not read, with where they came from and why."""
    return read_version(spark, f"{out}/faults", batch_id, FAULT_SCHEMA)


def advance(cursors: DataFrame, moved: DataFrame) -> DataFrame:
    """Cursors never go back: data of a batch that does not advance is kept, its cursor is not."""
    return (
        cursors.select("site", F.col("ts").alias("old_ts"))
        .join(moved.select("site", F.col("ts").alias("new_ts")), "site", "full_outer")
        .select("site", F.greatest("old_ts", "new_ts").alias("ts"))
        .where(F.col("ts").isNotNull())
    )


def ingest(
    spark: SparkSession, landing: str, out: str, ingested_at: Column | None = None, strict: bool = False, load_till: Column | None = None
) -> StreamingQuery | None:
    """Start a query that catches up with the landing folder and stops; without a folder there is nothing to start."""
    if not path_exists(spark, landing):
        return None
    return (
        read_landing(spark, landing)
        .writeStream.foreachBatch(lambda pages, batch_id: persist_batch(pages, batch_id, out, ingested_at, strict, load_till))
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
