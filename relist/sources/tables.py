"""Keyed listing tables: upsert, lookups, copies and the append log behind them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from relist.runtime import committed_versions, path_exists
from relist.schemas import LINK_COLUMNS, STORED_LISTING


def latest_per_key(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """Last row per key in ``order``; a hot key shrinks to one row per task before the shuffle."""
    last_first = Window.partitionBy(key).orderBy(*[F.col(name).desc() for name in order])
    return rows.withColumn("_n", F.row_number().over(last_first)).where(F.col("_n") == 1).drop("_n")


def upsert_listings(stored: DataFrame, incoming: DataFrame, updated_at: Column | None = None) -> DataFrame:
    """Insert or overwrite by ``doc_id``.

    Links of stored rows are never touched, columns unknown to ``incoming`` survive, and written
    rows get ``updated_at``. ``incoming`` holds at most one row per key.
    """
    updated_at = F.localtimestamp() if updated_at is None else updated_at
    written = incoming.drop(*LINK_COLUMNS).withColumn("updated_at", updated_at).withColumn("_written", F.lit(True))
    old, new = stored.alias("old"), written.alias("new")
    joined = old.join(new, F.col("old.doc_id") == F.col("new.doc_id"), "full_outer")
    is_written = F.col("new._written").isNotNull()
    columns = [F.coalesce(F.col("new.doc_id"), F.col("old.doc_id")).alias("doc_id")]
    for name in dict.fromkeys([*stored.columns, *written.columns]):
        if name in ("doc_id", "_written"):
            continue
        if name not in written.columns:
            columns.append(F.col(f"old.{name}").alias(name))
        elif name not in stored.columns:
            columns.append(F.col(f"new.{name}").alias(name))
        else:
            columns.append(F.when(is_written, F.col(f"new.{name}")).otherwise(F.col(f"old.{name}")).alias(name))
    return joined.select(*columns)


def append_listings(listings: DataFrame, path: str, version: int) -> None:
    """Append one version of changed listings, without links.

    Each version has a folder of its own that a replay overwrites, so a repeated micro-batch leaves
    no second copy.
    """
    listings.drop(*LINK_COLUMNS).write.mode("overwrite").parquet(f"{path}/version={version}")


def read_listings(spark: SparkSession, path: str, links: DataFrame | None = None) -> DataFrame:
    """Current listings: the latest version of each key, with its links from the link table."""
    folders = [f"{path}/version={version}" for version in committed_versions(spark, path)]
    if not folders:
        return ensure_columns(spark.createDataFrame([], STORED_LISTING), {name: "string" for name in LINK_COLUMNS})
    current = latest_per_key(spark.read.option("basePath", path).parquet(*folders), "doc_id", "version").drop("version")
    if links is None:
        return ensure_columns(current, {name: "string" for name in LINK_COLUMNS})
    return current.join(links.select("doc_id", *LINK_COLUMNS), "doc_id", "left")


def compact_listings(spark: SparkSession, path: str, target: str, version: int) -> None:
    """Write the current rows of a log as the first version of a new one, so that reads stay cheap."""
    append_listings(read_listings(spark, path), target, version)


def keyset_page(
    listings: DataFrame, size: int, after_start: Column | None = None, after_id: Column | None = None
) -> DataFrame:
    """``size`` rows in (offer_start, doc_id) order, strictly after the given pair."""
    if after_start is not None and after_id is not None:
        start, key = F.col("offer_start"), F.col("doc_id")
        listings = listings.where((start > after_start) | ((start == after_start) & (key > after_id)))
    return listings.orderBy("offer_start", "doc_id").limit(size)


def lookup_by_ids(listings: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose ``doc_id`` is in ``ids(doc_id)``; unknown ids are dropped."""
    return listings.join(ids.select("doc_id"), "doc_id", "left_semi")


def window_scan(listings: DataFrame, site: str, low: Column, high: Column) -> DataFrame:
    return listings.where((F.col("site_name") == F.lit(site)) & F.col("offer_start").between(low, high))


def slice_copy(listings: DataFrame, since: Column) -> DataFrame:
    """Listings active after ``since``, free to be claimed again; predecessors stay."""
    active = (F.col("offer_start") > since) | (F.col("offer_end") > since)
    return listings.where(active).withColumn("successor_id", F.lit(None).cast("string"))


TEST_SUFFIX = "_test"


def copy_table(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Copy a table into a test target and report both row counts.

    Refuses a target that is the source or is not marked as a test table. A target that already
    holds rows is left alone.
    """
    if source.rstrip("/") == target.rstrip("/"):
        raise ValueError("source and target are the same table")
    if not target.rstrip("/").endswith(TEST_SUFFIX):
        raise ValueError(f"target must end with {TEST_SUFFIX}")
    present = path_exists(spark, target)
    copied = not present or spark.read.parquet(target).isEmpty()
    if copied:
        spark.read.parquet(source).write.mode("overwrite" if present else "errorifexists").parquet(target)
    return (
        row_count(spark.read.parquet(source), "source")
        .unionByName(row_count(spark.read.parquet(target), "target"))
        .withColumn("copied", F.lit(copied))
    )


def ensure_columns(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add the missing columns as nulls."""
    missing = {name: F.lit(None).cast(kind) for name, kind in columns.items() if name not in rows.columns}
    return rows.withColumns(missing) if missing else rows


def row_count(rows: DataFrame, name: str, condition: Column | None = None) -> DataFrame:
    if condition is not None:
        rows = rows.where(condition)
    return rows.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")


def has_links(*extra: str) -> Column:
    linked = F.col("predecessor_id").isNotNull() | F.col("successor_id").isNotNull()
    for name in extra:
        linked = linked | F.col(name).isNotNull()
    return linked
