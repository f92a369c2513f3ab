"""Queries for feeds, raw and listing tables, cursors, the archive and the jobs over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relist.catalog import adapters as A
from relist.catalog import matching as M
from relist.catalog.registry import query, table
from relist.functions.payload import text
from relist.functions.text import to_double
from relist.operators import archiving as R
from relist.plans.archive import archived_ids, run_archive
from relist.plans.full_run import LINKS_SCHEMA
from relist.plans.full_run import full_run as run_everything
from relist.runtime import scratch_path
from relist.sources import archive_store, feed, state, tables
from relist.schemas import LINK_COLUMNS, SITE_RUN_SCHEMA
from relist.streaming.ingest import ingest, load_cursors, load_faults, persist_batch

# --- feed ------------------------------------------------------------------------------------

PAGE_IDS = 500


def feed_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Responses of up to 500 consecutive events per site, as a list or under ``ads``, with junk items."""
    ads = table(spark, sf, "events").select(
        F.col("event_type").alias("site"),
        F.expr(f"(event_id - event_id % {PAGE_IDS}) / {PAGE_IDS}").cast("bigint").alias("page"),
        "event_id",
        F.to_json(F.struct("event_id", "value", F.from_json("props", "struct<k:bigint>").alias("props"))).alias("ad"),
    )
    items = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("event_id", "ad"))), lambda a: a["ad"]), ",")
    pages = ads.groupBy("site", "page").agg(items.alias("items"))
    body = F.when(
        F.col("page") % 2 == 0, F.concat(F.lit('["junk",'), F.col("items"), F.lit(",7,null]"))
    ).otherwise(F.concat(F.lit('{"total":1,"ads":["junk",'), F.col("items"), F.lit(",[1]]}")))
    return pages.select("site", "page", body.alias("body"))


@query(
    "feed_flatten",
    f"SELECT event_type AS site, CAST((event_id - event_id % {PAGE_IDS}) / {PAGE_IDS} AS BIGINT) AS page, "
    f"CAST(row_number() OVER (PARTITION BY event_type, event_id - event_id % {PAGE_IDS} ORDER BY event_id) AS BIGINT) AS position, "
    "event_id, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
)
def feed_flatten(spark: SparkSession, sf: str) -> DataFrame:
    ads = feed.flatten_pages(feed_pages(spark, sf))
    payload = F.col("payload")
    return ads.select(
        "site",
        "page",
        F.col("position").cast("bigint").alias("position"),
        F.try_variant_get(payload, "$.event_id", "bigint").alias("event_id"),
        to_double(text(payload, "value")).alias("value"),
        F.try_variant_get(payload, "$.props.k", "bigint").alias("k"),
    )


@query(
    "raw_envelope",
    "SELECT CAST(event_id AS VARCHAR) AS raw_id, event_type AS source, TIMESTAMP '2024-02-15 12:00:00' AS ingested_at, event_type AS asked_site, "
    "event_id, value FROM events",
)
def raw_envelope(spark: SparkSession, sf: str) -> DataFrame:
    ads = feed.flatten_pages(feed_pages(spark, sf))
    raw = feed.raw_envelope(
        ads,
        F.col("site"),
        A.ntz(A.NOW),
        F.create_map(F.lit("site"), F.col("site")),
        F.try_variant_get(F.col("payload"), "$.event_id", "string"),
    )
    payload = F.try_parse_json("payload")
    return raw.select(
        "raw_id",
        "source",
        "ingested_at",
        F.col("request_params")["site"].alias("asked_site"),
        F.try_variant_get(payload, "$.event_id", "bigint").alias("event_id"),
        to_double(text(payload, "value")).alias("value"),
    )


@query("raw_append", f"WITH {A.ORDERS_RAW_CTE} SELECT raw_id, source, ingested_at, CAST(2 AS BIGINT) AS copies FROM raw")
def raw_append(spark: SparkSession, sf: str) -> DataFrame:
    """A replayed delivery stays in the history."""
    path = scratch_path(spark, "raw")
    for _ in range(2):
        feed.append_raw(A.orders_raw(spark, sf), path)
    stored = feed.read_raw(spark, path)
    return stored.groupBy("raw_id", "source", "ingested_at").agg(F.count("*").alias("copies"))


@query("raw_scan_limit", f"WITH {A.ORDERS_RAW_CTE} SELECT * FROM raw ORDER BY raw_id LIMIT 1000")
def raw_scan_limit(spark: SparkSession, sf: str) -> DataFrame:
    return feed.scan_raw(A.orders_raw(spark, sf))


# --- listing tables --------------------------------------------------------------------------

UPSERT_BASE = "SELECT *, 'kept' || CAST(parapi_unique_id AS STRING) AS is_duplicate FROM listings WHERE parapi_unique_id % 3 <> 0"


UPSERT_CHANGED = {"latest_price": "i.new_price", "name": "'changed'"}
UPSERT_COLUMNS = ", ".join(
    f"s.{name}" if name in LINK_COLUMNS else f"CASE WHEN i.doc_id IS NOT NULL THEN {UPSERT_CHANGED.get(name, f'i.{name}')} ELSE s.{name} END AS {name}"
    for name in A.DIRTY
    if name != "doc_id"
)


@query(
    "listing_upsert",
    f"WITH {A.listings_cte('dirty')}, s AS ({UPSERT_BASE}), i AS (SELECT *, value2 AS new_price FROM (SELECT *, coalesce(latest_price, 0) + 5 AS value2 FROM listings WHERE parapi_unique_id % 2 = 0) x) "
    f"SELECT coalesce(i.doc_id, s.doc_id) AS doc_id, {UPSERT_COLUMNS}, s.is_duplicate, "
    f"CASE WHEN i.doc_id IS NOT NULL THEN {A.NOW_SQL} END AS updated_at FROM s FULL JOIN i ON s.doc_id = i.doc_id",
)
def listing_upsert(spark: SparkSession, sf: str) -> DataFrame:
    rows = A.listings(spark, sf, "dirty")
    stored = rows.where(F.col("parapi_unique_id") % 3 != 0).withColumn(
        "is_duplicate", F.concat(F.lit("kept"), F.col("parapi_unique_id").cast("string"))
    )
    incoming = rows.where(F.col("parapi_unique_id") % 2 == 0).withColumns(
        {
            "latest_price": F.coalesce("latest_price", F.lit(0.0)) + 5,
            "name": F.lit("changed"),
            "predecessor_id": F.lit("ignored"),
        }
    )
    return tables.upsert_listings(stored, incoming, A.ntz(A.NOW))


@query(
    "latest_per_key",
    "SELECT o_custkey AS custkey, o_orderkey AS orderkey, o_totalprice AS price FROM orders "
    "QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1",
)
def latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("custkey"), F.col("o_orderkey").alias("orderkey"), F.col("o_totalprice").alias("price"), "o_orderdate"
    )
    return tables.latest_per_key(rows, "custkey", "o_orderdate", "orderkey").drop("o_orderdate")


@query(
    "keyset_page",
    f"WITH {A.listings_cte('contended')} SELECT doc_id, offer_start FROM listings WHERE (offer_start, doc_id) > (TIMESTAMP '2024-01-10', '[view]5') "
    "ORDER BY offer_start, doc_id LIMIT 500",
)
def keyset_page(spark: SparkSession, sf: str) -> DataFrame:
    page = tables.keyset_page(A.listings(spark, sf), 500, A.ntz("2024-01-10"), F.lit("[view]5"))
    return page.select("doc_id", "offer_start")


@query(
    "lookup_by_ids",
    f"WITH {A.listings_cte('contended')} SELECT doc_id, latest_price FROM listings WHERE doc_id IN (SELECT '[view]' || CAST(event_id AS VARCHAR) FROM events WHERE event_id % 5 = 0)",
)
def lookup_by_ids(spark: SparkSession, sf: str) -> DataFrame:
    ids = table(spark, sf, "events").where("event_id % 5 = 0").selectExpr("'[view]' || CAST(event_id AS STRING) AS doc_id")
    return tables.lookup_by_ids(A.listings(spark, sf), ids).select("doc_id", "latest_price")


@query(
    "window_scan",
    f"WITH {A.listings_cte('contended')} SELECT doc_id, offer_start FROM listings WHERE site_name = 'error' AND offer_start BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-12'",
)
def window_scan(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.window_scan(A.listings(spark, sf), "error", A.ntz("2024-01-05"), A.ntz("2024-01-12"))
    return rows.select("doc_id", "offer_start")


SLICE_SQL = (
    f"WITH {A.listings_cte('dirty')} SELECT doc_id, offer_start, offer_end, predecessor_id, CAST(NULL AS VARCHAR) AS successor_id FROM listings "
    "WHERE offer_start > TIMESTAMP '2024-01-20' OR offer_end > TIMESTAMP '2024-01-20'"
)


@query("slice_copy", SLICE_SQL)
def slice_copy(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "slice")
    tables.slice_copy(A.listings(spark, sf, "dirty"), A.ntz("2024-01-20")).write.parquet(path)
    return spark.read.parquet(path).select("doc_id", "offer_start", "offer_end", "predecessor_id", "successor_id")


@query(
    "table_copy",
    "SELECT name, (SELECT count(*) FROM events) AS n, copied FROM (VALUES ('source', true), ('target', true), ('source', false), ('target', false)) v(name, copied)",
)
def table_copy(spark: SparkSession, sf: str) -> DataFrame:
    """The first call copies, the second finds rows in the target and leaves them."""
    target = scratch_path(spark, "copy") + tables.TEST_SUFFIX
    first = tables.copy_table(spark, f"{sf}/events.parquet", target)
    return first.unionByName(tables.copy_table(spark, f"{sf}/events.parquet", target))


@query(
    "ensure_columns",
    "SELECT event_id, event_type, CAST(NULL AS VARCHAR) AS predecessor_id, CAST(NULL AS VARCHAR) AS successor_id FROM events",
)
def ensure_columns(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").select("event_id", "event_type")
    wanted = {"event_type": "string", "predecessor_id": "string", "successor_id": "string"}
    return tables.ensure_columns(rows, wanted)


@query(
    "row_count",
    f"WITH {A.listings_cte('dirty')} SELECT 'all' AS name, count(*) AS n FROM listings UNION ALL SELECT 'linked', count(*) FROM listings "
    "WHERE predecessor_id IS NOT NULL OR successor_id IS NOT NULL",
)
def row_count(spark: SparkSession, sf: str) -> DataFrame:
    rows = A.listings(spark, sf, "dirty")
    return tables.row_count(rows, "all").unionByName(tables.row_count(rows, "linked", tables.has_links()))


# --- cursors ---------------------------------------------------------------------------------


@query(
    "cursor_upsert",
    f"WITH {M.CURSORS_CTE}, changed AS (SELECT site, ts + INTERVAL 1 DAY AS ts FROM uploads WHERE site IN ('error', 'view')) "
    "SELECT coalesce(m.site, c.site) AS site, coalesce(c.ts, m.ts) AS ts FROM markers m FULL JOIN changed c ON m.site = c.site",
)
def cursor_upsert(spark: SparkSession, sf: str) -> DataFrame:
    uploads, markers = M.cursors(spark, sf)
    changed = uploads.where(F.col("site").isin("error", "view")).withColumn("ts", F.col("ts") + F.make_dt_interval(F.lit(1)))
    updated = state.upsert_cursors(markers, changed)
    return state.ordered_sites(updated).join(updated, "site")


@query(
    "max_checked",
    f"WITH {A.RAW_CTE} SELECT source AS site, max(TRY_CAST(r_checked AS TIMESTAMP)) AS ts, count(*) FILTER (TRY_CAST(r_checked AS TIMESTAMP) IS NULL) AS unreadable FROM raw GROUP BY source",
)
def max_checked(spark: SparkSession, sf: str) -> DataFrame:
    """All ads, those without a time too: they are what keeps a site's cursor where it is."""
    raw = A.raw_ads(spark, sf).select("source", F.try_parse_json("payload").alias("payload"))
    ads = raw.select(F.col("source").alias("site"), text(F.col("payload"), "checked").alias("checked"))
    return feed.checked_times(ads, F.col("checked"))


# --- archive ---------------------------------------------------------------------------------

BATCH_ROWS = 700
CUTOFF = "2000-06-01"
EXPIRED_CTE = f"{A.ORDERS_RAW_CTE}, expired AS (SELECT * FROM raw WHERE ingested_at < TIMESTAMP '{CUTOFF}')"
NUMBERED_CTE = (
    f"{EXPIRED_CTE}, numbered AS (SELECT *, CAST(floor((row_number() OVER (ORDER BY ingested_at, raw_id) - 1) / {BATCH_ROWS}) AS BIGINT) AS chunk FROM expired)"
)
BATCHED_CTE = (
    f"{NUMBERED_CTE}, batched AS (SELECT *, CAST(year(ingested_at) AS INTEGER) AS year, CAST(month(ingested_at) AS INTEGER) AS month, "
    "'run-' || chunk || '-' || strftime(ingested_at, '%Y%m') AS batch_id FROM numbered)"
)
SUMMARY_CTE = (
    f"{BATCHED_CTE}, summary AS (SELECT batch_id AS id, year, month, min(ingested_at) AS from_ingested_at, max(ingested_at) AS to_ingested_at, count(*) AS documents_count, "
    "'raw/' || strftime(min(ingested_at), '%Y/%m') || '/part-' || batch_id || '.jsonl.gz' AS s3_path FROM batched GROUP BY batch_id, year, month)"
)


def expired_rows(spark: SparkSession, sf: str) -> DataFrame:
    return R.expired(A.orders_raw(spark, sf), A.ntz(CUTOFF))


def batched_rows(spark: SparkSession, sf: str) -> DataFrame:
    return R.assign_batches(expired_rows(spark, sf), BATCH_ROWS)


@query("expired", f"WITH {EXPIRED_CTE} SELECT raw_id, ingested_at FROM expired")
def expired(spark: SparkSession, sf: str) -> DataFrame:
    return expired_rows(spark, sf).select("raw_id", "ingested_at")


@query("expired_scan", f"WITH {NUMBERED_CTE} SELECT raw_id, ingested_at, chunk AS batch_no FROM numbered")
def expired_scan(spark: SparkSession, sf: str) -> DataFrame:
    return R.expired_scan(expired_rows(spark, sf), BATCH_ROWS).select("raw_id", "ingested_at", "batch_no")


@query("archive_batches", f"WITH {SUMMARY_CTE} SELECT * FROM summary")
def archive_batches(spark: SparkSession, sf: str) -> DataFrame:
    return R.summarize_batches(batched_rows(spark, sf), "/raw/")


@query("archive_write", f"WITH {BATCHED_CTE} SELECT batch_id, year, month, raw_id, source, payload FROM batched")
def archive_write(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "archive")
    archive_store.write_batches(batched_rows(spark, sf), path)
    lines = archive_store.read_batches(spark, path)
    row = F.from_json("value", "raw_id string, source string, payload string")
    return lines.select("batch_id", "year", "month", row.alias("row")).select("batch_id", "year", "month", "row.*")


@query(
    "archive_verify",
    f"WITH {BATCHED_CTE} SELECT batch_id, count(*) AS lines, NOT bool_or(source = 'P' AND CAST(raw_id AS BIGINT) % 50 = 0) AS verified FROM batched GROUP BY batch_id",
)
def archive_verify(spark: SparkSession, sf: str) -> DataFrame:
    """Some stored lines are damaged on the way back; their batches must not pass."""
    rows, path = batched_rows(spark, sf), scratch_path(spark, "archive")
    archive_store.write_batches(rows, path)
    row = F.from_json("value", "raw_id string, source string")
    damaged = (row["source"] == "P") & (row["raw_id"].cast("bigint") % 50 == 0)
    stored = archive_store.read_batches(spark, path)
    stored = stored.withColumn("value", F.when(damaged, F.concat("value", F.lit(" "))).otherwise(F.col("value")))
    return archive_store.verify_batches(rows, stored)


@query("raw_delete_archived", f"WITH {EXPIRED_CTE} SELECT * FROM raw WHERE raw_id NOT IN (SELECT raw_id FROM expired)")
def raw_delete_archived(spark: SparkSession, sf: str) -> DataFrame:
    return archive_store.without_archived(A.orders_raw(spark, sf), expired_rows(spark, sf))


LEDGER_CTE = (
    f"{SUMMARY_CTE}, ledger AS (SELECT id, from_ingested_at, to_ingested_at, CASE WHEN documents_count % 2 = 0 THEN {A.NOW_SQL} END AS archived_at, "
    "CASE WHEN documents_count % 2 = 0 THEN s3_path END AS s3_path, CASE WHEN documents_count % 2 = 0 THEN documents_count ELSE 0 END AS documents_count, "
    "CASE WHEN documents_count % 3 = 0 AND documents_count % 2 <> 0 THEN 'in_progress' WHEN documents_count % 2 = 0 THEN 'success' ELSE 'failed' END AS status FROM summary)"
)


def ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Odd batches fail, every third odd one is still under way."""
    summary = R.summarize_batches(batched_rows(spark, sf), "raw")
    good = F.col("documents_count") % 2 == 0
    ended = summary.where(good | (F.col("documents_count") % 3 != 0))
    return state.ledger_current(state.ledger_started(summary).unionByName(state.ledger_finished(ended, good, A.ntz(A.NOW))))


@query("archive_ledger", f"WITH {LEDGER_CTE} SELECT * FROM ledger")
def archive_ledger(spark: SparkSession, sf: str) -> DataFrame:
    return ledger(spark, sf)


@query("archive_hwm", f"WITH {LEDGER_CTE} SELECT max(to_ingested_at) AS to_ingested_at FROM ledger WHERE status = 'success'")
def archive_hwm(spark: SparkSession, sf: str) -> DataFrame:
    return state.archive_high_water_mark(ledger(spark, sf))


@query(
    "archive_run",
    f"WITH {SUMMARY_CTE} SELECT id, from_ingested_at, to_ingested_at, TIMESTAMP '2000-07-31' AS archived_at, s3_path, documents_count, 'success' AS status, "
    "(SELECT count(*) FROM raw) - (SELECT count(*) FROM expired) AS left_rows FROM summary",
)
def archive_run(spark: SparkSession, sf: str) -> DataFrame:
    run = run_archive(
        spark, A.orders_raw(spark, sf), scratch_path(spark, "archive-run"), A.ntz("2000-07-31"), 60, BATCH_ROWS, "raw", "run"
    )
    left = run.remaining.agg(F.count("*").alias("n")).scalar()
    return run.ledger.withColumn("left_rows", left)


# --- ingestion -------------------------------------------------------------------------------

# Ads of the feed; the second delivery repeats some of the first with a later check and another price.
SPLIT = "TIMESTAMP_NTZ '2024-01-20'"
FEED_COLUMNS = {
    "site": "event_type",
    "unique_id": "CAST(event_id AS STRING)",
    "checked": "<datetime:ts + (event_id % 72) * INTERVAL '1' HOUR>",
    "added": "<datetime:ts>",
    "actual": "'0'",
    "name": "'listing ' || CAST(user_id % 15 AS STRING)",
    "mark": "'brand ' || CAST(user_id % 3 AS STRING)",
    "model": "'model'",
    "price": "CAST(value AS STRING)",
    "run": "CASE WHEN event_id % 11 <> 0 THEN CAST(100000 + event_id % 5000 AS STRING) END",
    "ts": "ts",
    "event_id": "event_id",
}
AGAIN_CHECKED = "2024-02-05 00:00:00"


def delivery(spark: SparkSession, sf: str, part: str) -> DataFrame:
    """Responses (site, body) of one delivery, a JSON list of up to 100 ads each.

    ``first`` and ``second`` split the events in time, ``second`` with some of the first again; ``old`` repeats
    the first days; ``faulty`` is ``second`` with a page of one site and an ad of another that cannot be read.
    """
    rows = A.spark_view(spark, sf, "events", FEED_COLUMNS)
    first = rows.where(F.col("ts") < F.expr(SPLIT))
    if part in ("second", "faulty"):
        again = first.where("event_id % 10 = 0").withColumns(
            {"checked": F.lit(AGAIN_CHECKED), "price": (to_double(F.col("price")) + 1).cast("string")}
        )
        rows = rows.where(F.col("ts") >= F.expr(SPLIT)).unionByName(again)
    else:
        rows = first.where(F.col("ts") < F.expr(OLD)) if part == "old" else first
    ad = F.to_json(F.struct("unique_id", "checked", "added", "actual", "name", "mark", "model", "price", "run"))
    pages = (
        rows.select("site", F.floor(F.col("event_id") / 100).alias("page"), "event_id", ad.alias("ad"))
        .groupBy("site", "page")
        .agg(F.sort_array(F.collect_list(F.struct("event_id", "ad"))).alias("ads"))
    )
    body = F.concat(F.lit("["), F.array_join(F.transform("ads", lambda a: a["ad"]), ","), F.lit("]"))
    pages = pages.select("site", body.alias("body"))
    if part == "faulty":
        pages = pages.unionByName(spark.createDataFrame([("error", "<html>busy</html>"), ("signup", UNREADABLE_AD)], "site string, body string"))
    return pages


OLD = "TIMESTAMP_NTZ '2024-01-05'"
UNREADABLE_AD = '[{"unique_id": "999999999", "checked": "soon", "added": "2024-01-25 00:00:00", "actual": "1", "price": "5"}]'


def land(spark: SparkSession, sf: str, landing: str, part: str) -> None:
    delivery(spark, sf, part).withColumnRenamed("body", "value").write.mode("append").partitionBy("site").text(landing)


FED_CTE = (
    "f AS (SELECT *, ts < TIMESTAMP '2024-01-20' AS early, ts < TIMESTAMP '2024-01-20' AND event_id % 10 = 0 AS again, "
    "date_trunc('second', ts) + (event_id % 72) * INTERVAL 1 HOUR AS checked, event_id // 100 AS page FROM events)"
)


@query(
    "ingest_batch",
    f"WITH {FED_CTE}, cursors AS (SELECT event_type AS site, CASE WHEN event_type IN ('error', 'signup') THEN max(checked) FILTER (early) "
    f"ELSE max(CASE WHEN again THEN TIMESTAMP '{AGAIN_CHECKED}' ELSE checked END) END AS ts FROM f GROUP BY event_type) "
    "SELECT '[' || event_type || ']' || event_id AS doc_id, event_type AS site_name, date_trunc('second', f.ts) AS offer_start, "
    f"CASE WHEN again THEN TIMESTAMP '{AGAIN_CHECKED}' ELSE checked END AS offer_end, "
    "CASE WHEN again THEN value + 1 ELSE value END AS latest_price, cursors.ts AS cursor_ts, CASE WHEN event_type IN ('error', 'signup') THEN CAST(1 AS BIGINT) ELSE 0 END AS faults "
    "FROM f JOIN cursors ON site = event_type UNION ALL "
    "SELECT '[signup]999999999', 'signup', TIMESTAMP '2024-01-25 00:00:00', NULL, 5, (SELECT ts FROM cursors WHERE site = 'signup'), 1 WHERE EXISTS (SELECT 1 FROM cursors WHERE site = 'signup')",
)
def ingest_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Two deliveries through the streaming job, the second with a bad page of one site and a bad ad of another: all listings, with their site's cursor and faults."""
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "ingested")
    for part in ("first", "faulty"):
        land(spark, sf, landing, part)
        ingest(spark, landing, out, A.ntz(A.NOW)).awaitTermination()
    current = tables.read_listings(spark, f"{out}/listings")
    cursors = load_cursors(spark, out).select(F.col("site").alias("site_name"), F.col("ts").alias("cursor_ts"))
    faults = load_faults(spark, out, 1).groupBy(F.col("site").alias("site_name")).agg(F.count("reason").alias("faults"))
    listed = current.select("doc_id", "site_name", "offer_start", "offer_end", "latest_price").join(cursors, "site_name")
    return listed.join(faults, "site_name", "left").fillna(0, "faults")


def ingested(spark: SparkSession, sf: str, parts: list[tuple[str, str | None]]) -> DataFrame:
    """What each of the deliveries (part, upper bound) did for each site."""
    out = scratch_path(spark, "site-runs")
    for number, (part, bound) in enumerate(parts):
        persist_batch(delivery(spark, sf, part), number, out, A.ntz(A.NOW), load_till=None if bound is None else A.ntz(bound))
    runs = spark.read.schema(SITE_RUN_SCHEMA).parquet(f"{out}/site_runs")
    return runs.withColumnRenamed("version", "delivery")


PARTS_CTE = (
    f"{FED_CTE}, sent AS (SELECT event_type AS site, 'first' AS part, page, checked FROM f WHERE early UNION ALL "
    "SELECT event_type, 'old', page, checked FROM f WHERE ts < TIMESTAMP '2024-01-05' UNION ALL "
    f"SELECT event_type, 'second', page, CASE WHEN again THEN TIMESTAMP '{AGAIN_CHECKED}' ELSE checked END FROM f WHERE again OR NOT early), "
    "sums AS (SELECT site, part, count(DISTINCT page) AS pages, count(*) AS ads, max(checked) AS max_checked FROM sent GROUP BY ALL)"
)
BOUND = "2024-01-22 21:00:00"


@query(
    "cursor_progress",
    f"WITH {PARTS_CTE}, one AS (SELECT site, max_checked AS c FROM sums WHERE part = 'first'), "
    f"three AS (SELECT one.site, c, c >= TIMESTAMP '{BOUND}' AS waits, s.pages, s.ads, s.max_checked FROM one JOIN sums s ON s.site = one.site AND s.part = 'second') "
    "SELECT 0 AS delivery, site, 'ok' AS status, pages, ads, max_checked, NULL::TIMESTAMP AS cursor_before, max_checked AS cursor_after FROM sums WHERE part = 'first' UNION ALL "
    "SELECT 1, s.site, 'ok', pages, ads, max_checked, c, c FROM sums s JOIN one ON one.site = s.site WHERE part = 'old' UNION ALL "
    "SELECT 2, site, CASE WHEN waits THEN 'waiting' ELSE 'ok' END, CASE WHEN waits THEN 0 ELSE pages END, CASE WHEN waits THEN 0 ELSE ads END, "
    "CASE WHEN NOT waits THEN max_checked END, c, CASE WHEN waits THEN c ELSE greatest(c, max_checked) END FROM three UNION ALL "
    "SELECT 3, t.site, 'ok', CASE WHEN waits THEN t.pages ELSE 0 END + s.pages, CASE WHEN waits THEN t.ads ELSE 0 END + s.ads, "
    "CASE WHEN waits THEN t.max_checked ELSE s.max_checked END, CASE WHEN waits THEN c ELSE greatest(c, t.max_checked) END, greatest(c, t.max_checked) "
    "FROM three t JOIN sums s ON s.site = t.site AND s.part = 'old'",
)
def cursor_progress(spark: SparkSession, sf: str) -> DataFrame:
    """Cursors over four deliveries: one that does not advance, one with a bound that some sites have reached, and one that takes what waited."""
    runs = ingested(spark, sf, [("first", None), ("old", None), ("second", BOUND), ("old", None)])
    return runs.select("delivery", "site", "status", "pages", "ads", "max_checked", "cursor_before", "cursor_after")


@query(
    "site_status",
    f"WITH {PARTS_CTE} SELECT 0 AS delivery, site, 'ok' AS status, pages, ads, CAST(0 AS BIGINT) AS faults, NULL::VARCHAR AS error FROM sums WHERE part = 'first' UNION ALL "
    "SELECT 1, site, CASE WHEN site IN ('error', 'signup') THEN 'failed' ELSE 'ok' END, pages + CASE WHEN site IN ('error', 'signup') THEN 1 ELSE 0 END, "
    "ads + CASE WHEN site = 'signup' THEN 1 ELSE 0 END, CASE WHEN site IN ('error', 'signup') THEN 1 ELSE 0 END, "
    f"CASE site WHEN 'error' THEN '{feed.BAD_PAGE.replace(chr(39), chr(39) * 2)}' WHEN 'signup' THEN '{feed.UNREADABLE.replace(chr(39), chr(39) * 2)}' END FROM sums WHERE part = 'second'",
)
def site_status(spark: SparkSession, sf: str) -> DataFrame:
    """Status of each site in a sound delivery and in one with faults of two sites."""
    return ingested(spark, sf, [("first", None), ("faulty", None)]).select("delivery", "site", "status", "pages", "ads", "faults", "error")


# The listings the two deliveries leave behind, with every block field the feed does not fill missing.
FED_LISTINGS = (
    "listings AS (SELECT '[' || event_type || ']' || event_id AS doc_id, event_type AS site_name, 'unknown' AS seller_type, 'listing ' || (user_id % 15) AS name, "
    "'brand ' || (user_id % 3) AS brand, 'model' AS model, false AS is_new, date_trunc('second', ts) AS offer_start, "
    f"CASE WHEN ts < TIMESTAMP '2024-01-20' AND event_id % 10 = 0 THEN TIMESTAMP '{AGAIN_CHECKED}' ELSE date_trunc('second', ts) + (event_id % 72) * INTERVAL 1 HOUR END AS offer_end, "
    "CASE WHEN ts < TIMESTAMP '2024-01-20' AND event_id % 10 = 0 THEN value + 1 ELSE value END AS latest_price, "
    "CASE WHEN ts < TIMESTAMP '2024-01-20' AND event_id % 10 = 0 THEN value + 1 ELSE value END AS initial_price, "
    "CASE WHEN event_id % 11 <> 0 THEN 100000 + event_id % 5000 END AS mileage, ts < TIMESTAMP '2024-01-20' AS early, "
    "CAST(NULL AS VARCHAR) AS predecessor_id, CAST(NULL AS VARCHAR) AS successor_id, CAST(NULL AS TIMESTAMP) AS last_checked, "
    + ", ".join(
        f"CAST(NULL AS VARCHAR) AS {name}"
        for name in (
            "region", "generation", "vin", "place", "steering_position", "gear_box", "gear_type", "body_type", "doors_num", "modification",
            "complectation", "fuel", "body_color", "condition",
        )
    )
    + ", CAST(NULL AS BIGINT) AS build_year, CAST(NULL AS DOUBLE) AS engine_power, CAST(NULL AS DOUBLE) AS engine_volume_liters, CAST(NULL AS BIGINT) AS count_owner FROM events)"
)
FED_WINDOW = (
    "marks AS (SELECT event_type AS site, max(date_trunc('second', ts) + (event_id % 72) * INTERVAL 1 HOUR) AS lo FROM events WHERE ts < TIMESTAMP '2024-01-20' GROUP BY event_type)"
)


@query(
    "full_run",
    f"WITH RECURSIVE {FED_LISTINGS}, {FED_WINDOW}, "
    + M.candidate_cte(
        where=f"EXISTS (SELECT 1 FROM marks WHERE marks.site = listings.site_name AND offer_start BETWEEN lo AND TIMESTAMP '{AGAIN_CHECKED}')"
    )
    + f", {M.pair_ctes()}, {M.greedy_ctes()} SELECT c_id AS doc_id, d_id AS predecessor_id, 'ingest,match,archive' AS stages, "
    "(SELECT count(*) FROM events WHERE ts >= TIMESTAMP '2024-01-20' OR event_id % 10 = 0) AS raw_left, "
    "(SELECT count(*) FROM events WHERE ts < TIMESTAMP '2024-01-20') AS archived FROM picked",
)
def full_run(spark: SparkSession, sf: str) -> DataFrame:
    """Two deliveries, each followed by all stages.

    The first match run only sets the markers; by the second run the first delivery has expired.
    """
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "run")
    for run_no, (part, now) in enumerate((("first", A.NOW), ("second", "2024-06-01 00:00:00")), 1):
        land(spark, sf, landing, part)
        report = run_everything(spark, landing, out, run_no, A.ntz(now), M.RULES)
        if report.failed:
            raise RuntimeError(f"{report.failed}: {report.error}")
    raw = feed.live_raw(spark.read.parquet(f"{out}/raw"), archived_ids(spark, out))
    done = state.ledger_current(spark.read.parquet(f"{out}/ledger")).where(F.col("status") == state.SUCCESS)
    links = state.read_state(spark, f"{out}/links", LINKS_SCHEMA)
    return links.where(F.col("predecessor_id").isNotNull()).select(
        "doc_id",
        "predecessor_id",
        F.lit(",".join(report.done)).alias("stages"),
        raw.agg(F.count("*").alias("n")).scalar().alias("raw_left"),
        done.agg(F.sum("documents_count").alias("n")).scalar().alias("archived"),
    )
