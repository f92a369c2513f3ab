"""Feed pages in, raw rows out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relist.functions.payload import is_object
from relist.functions.times import checked_datetime
from relist.runtime import path_exists
from relist.schemas import RAW_SCHEMA


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed response file: ``body`` and the file it came from."""
    return spark.read.text(path, wholetext=True).select(
        F.col("value").alias("body"), F.input_file_name().alias("file")
    )


BAD_PAGE = "feed response must be a list or an object with an 'ads' list"


def page_items(pages: DataFrame) -> DataFrame:
    """``pages`` with ``items``, the list that a ``body`` is or has under ``ads``, and ``page_error`` where there is none."""
    body = F.col("parsed_body")
    items = F.coalesce(F.try_variant_get(body, "$", "array<variant>"), F.try_variant_get(body, "$.ads", "array<variant>"))
    parsed = pages.withColumn("parsed_body", F.try_parse_json("body")).withColumn("items", items).drop("parsed_body")
    return parsed.withColumn("page_error", F.when(F.col("items").isNull(), F.lit(BAD_PAGE)))


def flatten_pages(pages: DataFrame) -> DataFrame:
    """One row per ad of each ``body``, which is a list or an object with a list under ``ads``.

    Items that are no objects are dropped; any other body fails the job. Columns of ``pages``
    other than ``body`` are kept; ``payload`` is the ad as VARIANT, ``position`` its place.
    """
    kept = [name for name in pages.columns if name != "body"]
    items = F.coalesce("items", F.raise_error(F.col("page_error")).cast("array<variant>"))
    exploded = page_items(pages).select(*kept, F.posexplode(items).alias("position", "payload"))
    return exploded.where(is_object(F.col("payload")))


def raw_envelope(
    ads: DataFrame, source: Column, ingested_at: Column, request_params: Column, raw_id: Column | None = None
) -> DataFrame:
    """Stamp ads with their source, one ingestion time and the request; the payload stays as received.

    ``position`` is kept where the ads carry it: it orders the ads of one page.
    """
    place = [name for name in ("position",) if name in ads.columns]
    return ads.select(
        (F.uuid() if raw_id is None else raw_id).alias("raw_id"),
        source.alias("source"),
        ingested_at.alias("ingested_at"),
        request_params.alias("request_params"),
        F.to_json("payload").alias("payload"),
        *place,
    )


def append_raw(raw: DataFrame, path: str) -> None:
    """Append without deduplication: every delivery of an ad is history worth keeping."""
    raw.write.mode("append").partitionBy("source").parquet(path)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Raw rows with their declared types, so that a source named by digits stays text; none where nothing was written yet."""
    return spark.read.schema(RAW_SCHEMA).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], RAW_SCHEMA)


def live_raw(raw: DataFrame, deleted: DataFrame) -> DataFrame:
    """Raw rows that were not deleted. The folders behind fully deleted batches can be dropped at leisure."""
    return raw.join(deleted.select("raw_id"), "raw_id", "left_anti")


def scan_raw(raw: DataFrame, limit: int = 1000) -> DataFrame:
    """First rows by ``raw_id``; the limit is the feature."""
    return raw.orderBy("raw_id").limit(limit)


def checked_times(ads: DataFrame, checked: Column) -> DataFrame:
    """Per site the newest check time and how many ads have no readable one."""
    time = checked_datetime(checked)
    return ads.groupBy("site").agg(F.max(time).alias("ts"), F.count_if(time.isNull()).alias("unreadable"))


UNREADABLE = "ad without a valid 'checked' time"


def max_checked(ads: DataFrame, checked: Column) -> DataFrame:
    """Next cursor per site; an ad without a readable time fails the job."""
    fail = F.raise_error(F.concat(F.lit(f"{UNREADABLE} at "), F.col("site"))).cast("timestamp_ntz")
    return checked_times(ads, checked).select("site", F.when(F.col("unreadable") > 0, fail).otherwise(F.col("ts")).alias("ts"))
