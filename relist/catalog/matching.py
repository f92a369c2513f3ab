"""Queries for candidate generation, scoring, assignment and match jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relist.catalog import adapters as A
from relist.catalog.registry import query, table
from relist.functions import scoring
from relist.functions.scoring import MatchRules
from relist.functions.times import plus_days
from relist.operators import candidates as C
from relist.operators import links as L
from relist.operators import resolver as R
from relist.operators.mapping import candidate_defaults
from relist.plans.backfill import run_backfill
from relist.plans.matching import match_incremental as run_matching
from relist.sources.state import advance_backfill, advance_markers, site_windows

RULES = MatchRules()
TEXT_KEYS = C.BLOCK_TEXT_FIELDS

# --- oracle pieces ---------------------------------------------------------------------------

DEFAULTS = {
    "site_name": "coalesce(site_name, 'unknown')",
    "seller_type": "coalesce(seller_type, 'unknown')",
    "name": "coalesce(name, '')",
    "brand": "coalesce(brand, '')",
    "model": "coalesce(model, '')",
    "is_new": "coalesce(is_new, false)",
    "offer_start": f"coalesce(offer_start, offer_end, last_checked, {A.NOW_SQL})",
    "initial_price": "coalesce(initial_price, latest_price, 0.0)",
}


def candidate_cte(source: str = "listings", where: str = "true") -> str:
    keys = ", ".join(
        f"{A.duck_blank(DEFAULTS.get(k, k)) if k in TEXT_KEYS else DEFAULTS.get(k, k)} AS {k}" for k in C.BLOCK_FIELDS
    )
    return (
        f"c AS (SELECT doc_id AS c_id, {DEFAULTS['offer_start']} AS c_start, {DEFAULTS['initial_price']} AS c_price, "
        f"CAST(mileage AS DOUBLE) AS c_mileage, {keys} FROM {source} WHERE {where})"
    )


def bounded(value: str, target: str, tolerance: float) -> str:
    low, high = f"round({target} * {1 - tolerance!r}, 6)", f"round({target} * {1 + tolerance!r}, 6)"
    return f"({target} IS NULL OR {low} > {high} OR ({value} IS NOT NULL AND {value} BETWEEN {low} AND {high}))"


PAIR_SCORE_PARTS = {
    "end_part": "round(greatest(0, 1 - abs(date_diff('microsecond', c_start, d_end)) / 1e6 / 432000.0) * 3.0, 6)",
    "price_part": "coalesce(round(greatest(0, 1 - abs(d_price - c_price) / greatest(abs(c_price) * 0.1, 1.0)) * 2.0, 6), 0)",
    "mileage_part": "coalesce(round(greatest(0, 1 - abs(d_mileage - c_mileage) / greatest(abs(c_mileage) * 0.05, 1.0)) * 1.5, 6), 0)",
}
PAIR_SCORE = (
    "round(least(greatest((end_part + price_part + mileage_part) / (3.0 + CASE WHEN d_price IS NOT NULL AND c_price IS NOT NULL "
    "THEN 2.0 ELSE 0 END + CASE WHEN d_mileage IS NOT NULL AND c_mileage IS NOT NULL THEN 1.5 ELSE 0 END), 0), 1), 6)"
)


def pair_ctes(documents: str = "listings") -> str:
    """``pairs`` and ``scored`` from ``c`` and a listing table."""
    same = " AND ".join(f"c.{k} IS NOT DISTINCT FROM d.{k}" for k in C.BLOCK_FIELDS)
    return (
        "pairs AS (SELECT c_id, d.doc_id AS d_id, c_start, CAST(c_price AS DOUBLE) AS c_price, c_mileage, d.offer_start AS d_start, "
        "d.offer_end AS d_end, CAST(d.latest_price AS DOUBLE) AS d_price, CAST(d.mileage AS DOUBLE) AS d_mileage "
        f"FROM c JOIN {documents} d ON {same} WHERE d.successor_id IS NULL AND d.offer_start < c_start "
        "AND d.offer_end BETWEEN c_start - INTERVAL 5 DAY AND c_start + INTERVAL 3 DAY AND c_id <> d.doc_id "
        f"AND {bounded('d.latest_price', 'c_price', 0.1)} AND {bounded('CAST(d.mileage AS DOUBLE)', 'c_mileage', 0.05)}), "
        "parts AS (SELECT *, " + ", ".join(f"{e} AS {n}" for n, e in PAIR_SCORE_PARTS.items()) + " FROM pairs), "
        f"scored AS (SELECT *, {PAIR_SCORE} AS score FROM parts), "
        "best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY c_id ORDER BY score DESC, d_id) = 1)"
    )


def greedy_ctes() -> str:
    """``picked(c_id, d_id)``: a step-by-step walk over each block's candidates."""
    return (
        "wishes AS (SELECT c.c_id, any_value(c.c_start) AS c_start, any_value(coalesce(c.site_name, '') || '|' || coalesce(c.name, '')) AS block, "
        "list(s.d_id ORDER BY s.score DESC, s.d_id) AS wanted FROM scored s JOIN c ON s.c_id = c.c_id WHERE s.score >= 0.7 GROUP BY c.c_id), "
        "steps AS (SELECT *, row_number() OVER (PARTITION BY block ORDER BY c_start, c_id) AS step FROM wishes), "
        "walk AS (SELECT DISTINCT block, CAST(0 AS BIGINT) AS step, CAST(NULL AS VARCHAR) AS c_id, CAST(NULL AS VARCHAR) AS d_id, "
        "CAST([] AS VARCHAR[]) AS taken FROM steps UNION ALL "
        "SELECT s.block, s.step, s.c_id, p.pick, CASE WHEN p.pick IS NULL THEN w.taken ELSE list_append(w.taken, p.pick) END "
        "FROM walk w JOIN steps s ON s.block = w.block AND s.step = w.step + 1, "
        "LATERAL (SELECT list_filter(s.wanted, lambda x: NOT list_contains(w.taken, x))[1] AS pick) p), "
        "picked AS (SELECT c_id, d_id FROM walk WHERE d_id IS NOT NULL)"
    )


def match_sql(kind: str, select: str, greedy: bool = False, where: str = "true") -> str:
    recursive = "RECURSIVE " if greedy else ""
    tail = f", {greedy_ctes()}" if greedy else ""
    return f"WITH {recursive}{A.listings_cte(kind)}, {candidate_cte(where=where)}, {pair_ctes()}{tail} {select}"


def candidates(spark: SparkSession, sf: str, kind: str = "contended") -> DataFrame:
    return candidate_defaults(A.listings(spark, sf, kind), A.ntz(A.NOW))


# --- predicates ------------------------------------------------------------------------------


@query(
    "relative_range",
    "WITH p AS (SELECT event_id, value, CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN -value ELSE value * (0.85 + (event_id % 7) * 0.05) END AS target, "
    "CASE WHEN event_id % 6 <> 0 THEN value END AS other FROM events) "
    f"SELECT event_id, {bounded('other', 'target', 0.1)} AS close FROM p",
)
def relative_range(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").selectExpr(
        "event_id",
        "CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN -value ELSE value * (0.85D + (event_id % 7) * 0.05D) END AS target",
        "CASE WHEN event_id % 6 <> 0 THEN value END AS other",
    )
    return rows.select("event_id", scoring.within_relative(F.col("other"), F.col("target"), 0.1).alias("close"))


def stays(spark: SparkSession, sf: str) -> DataFrame:
    """Line items against their order: shipping stands for an offer end, ordering for a start."""
    items = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").alias("d_end"), F.col("l_extendedprice").alias("d_price"),
        F.col("l_quantity").alias("d_mileage"),
    )
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").alias("c_start"), F.col("o_totalprice").alias("c_price")
    )
    return items.join(orders, "l_orderkey")


@query(
    "temporal_band",
    "SELECT l_orderkey, l_linenumber, l_shipdate AS d_end, o_orderdate AS c_start FROM lineitem JOIN orders ON l_orderkey = o_orderkey "
    "WHERE l_shipdate BETWEEN o_orderdate - INTERVAL 5 DAY AND o_orderdate + INTERVAL 3 DAY AND l_shipdate - INTERVAL 2 DAY < o_orderdate",
)
def temporal_band(spark: SparkSession, sf: str) -> DataFrame:
    rows = stays(spark, sf).withColumn("d_start", plus_days(F.col("d_end"), -2))
    return rows.where(C.temporal_band(RULES)).select("l_orderkey", "l_linenumber", "d_end", "c_start")


@query(
    "unclaimed",
    f"WITH {A.listings_cte('dirty')} SELECT doc_id AS d_id, offer_start AS d_start, offer_end AS d_end FROM listings "
    "WHERE successor_id IS NULL AND offer_end IS NOT NULL AND offer_start IS NOT NULL",
)
def unclaimed(spark: SparkSession, sf: str) -> DataFrame:
    return C.document_side(A.listings(spark, sf, "dirty")).select("d_id", "d_start", "d_end")


PAIR_SELECT = "SELECT c_id, d_id, c_start, c_price, c_mileage, d_start, d_end, d_price, d_mileage FROM pairs"


@query("exact_or_missing", match_sql("dirty", PAIR_SELECT))
def exact_or_missing(spark: SparkSession, sf: str) -> DataFrame:
    return C.candidate_pairs(candidates(spark, sf, "dirty"), A.listings(spark, sf, "dirty"), RULES)


@query("candidate_pairs", match_sql("contended", PAIR_SELECT))
def candidate_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return C.candidate_pairs(candidates(spark, sf), A.listings(spark, sf), RULES)


@query("candidate_pairs_hot", match_sql("dirty", PAIR_SELECT))
def candidate_pairs_hot(spark: SparkSession, sf: str) -> DataFrame:
    """Every block treated as hot, so that price and mileage cells are at work."""
    return C.candidate_pairs(candidates(spark, sf, "dirty"), A.listings(spark, sf, "dirty"), RULES, hot_rows=1)


@query("candidate_pairs_sparse", match_sql("sparse", PAIR_SELECT))
def candidate_pairs_sparse(spark: SparkSession, sf: str) -> DataFrame:
    return C.candidate_pairs(candidates(spark, sf, "sparse"), A.listings(spark, sf, "sparse"), RULES)


# --- scores ----------------------------------------------------------------------------------


@query(
    "score_numeric",
    "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber = 1 THEN CAST(0 AS DOUBLE) ELSE "
    "round(greatest(0, 1 - abs(l_extendedprice - p_retailprice * l_quantity) / greatest(abs(p_retailprice * l_quantity) * 0.1, 1.0)) * 2.0, 6) END AS part, "
    "CAST(CASE WHEN l_linenumber = 1 THEN 0.0 ELSE 2.0 END AS DOUBLE) AS weight FROM lineitem JOIN part ON l_partkey = p_partkey",
)
def score_numeric(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    actual = F.when(F.col("l_linenumber") != 1, F.col("l_extendedprice"))
    target = F.col("p_retailprice") * F.col("l_quantity")
    return items.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        scoring.numeric_proximity(actual, target, 0.1, 2.0).alias("part"),
        scoring.numeric_weight(actual, target, 0.1, 2.0).alias("weight"),
    )


@query(
    "score_date",
    "SELECT l_orderkey, l_linenumber, l_shipdate, round(greatest(0, 1 - abs(date_diff('microsecond', o_orderdate, l_shipdate)) / 1e6 / (60 * 86400.0)) * 3.0, 6) AS part "
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
)
def score_date(spark: SparkSession, sf: str) -> DataFrame:
    return stays(spark, sf).select(
        "l_orderkey",
        "l_linenumber",
        F.col("d_end").alias("l_shipdate"),
        scoring.date_proximity(F.col("d_end"), F.col("c_start"), 60, 3.0).alias("part"),
    )


@query("pair_score", match_sql("dirty", "SELECT c_id, d_id, end_part, CAST(price_part AS DOUBLE) AS price_part, CAST(mileage_part AS DOUBLE) AS mileage_part, score FROM scored"))
def pair_score(spark: SparkSession, sf: str) -> DataFrame:
    pairs = C.candidate_pairs(candidates(spark, sf, "dirty"), A.listings(spark, sf, "dirty"), RULES)
    return C.score_pairs(pairs, RULES).select("c_id", "d_id", "end_part", "price_part", "mileage_part", "score")


BEST_SELECT = "SELECT c_id, d_id, score, c_start, d_start FROM best"


@query("best_duplicate", match_sql("contended", BEST_SELECT))
def best_duplicate(spark: SparkSession, sf: str) -> DataFrame:
    return C.best_duplicate(candidates(spark, sf), A.listings(spark, sf), RULES)


@query("score_gate", match_sql("contended", BEST_SELECT + " WHERE score >= 0.7 AND d_start < c_start"))
def score_gate(spark: SparkSession, sf: str) -> DataFrame:
    return C.score_gate(C.best_duplicate(candidates(spark, sf), A.listings(spark, sf), RULES, min_score=RULES.min_score), RULES)


# --- windows and sites -----------------------------------------------------------------------

# Upload cursors two days before a site's last event; markers ten days earlier, missing or ahead.
UPLOADS_SQL = "SELECT event_type AS site, max(ts) - INTERVAL '2' DAY AS ts FROM {events} GROUP BY event_type"
MARKERS_SQL = (
    "SELECT event_type AS site, max(ts) - CASE WHEN event_type = 'view' THEN INTERVAL '1' DAY ELSE INTERVAL '12' DAY END AS ts "
    "FROM {events} WHERE event_type <> 'error' GROUP BY event_type"
)
CURSORS_CTE = f"uploads AS ({UPLOADS_SQL.format(events='events')}), markers AS ({MARKERS_SQL.format(events='events')})"
RUN_WHERE = (
    "predecessor_id IS NULL AND EXISTS (SELECT 1 FROM uploads u JOIN markers m ON u.site = m.site "
    "WHERE u.site = listings.site_name AND m.ts < u.ts AND offer_start BETWEEN m.ts AND u.ts)"
)


def cursors(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    events = table(spark, sf, "events")
    return spark.sql(UPLOADS_SQL, events=events), spark.sql(MARKERS_SQL, events=events)


@query(
    "site_windows",
    f"WITH {CURSORS_CTE} SELECT u.site, m.ts AS lower_bound, u.ts AS upper_bound, CASE WHEN m.ts IS NULL THEN 'init' "
    "WHEN m.ts >= u.ts THEN 'skip_caught_up' ELSE 'run' END AS status FROM uploads u LEFT JOIN markers m ON u.site = m.site",
)
def site_windows_query(spark: SparkSession, sf: str) -> DataFrame:
    return site_windows(*cursors(spark, sf))


def open_window(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    windows = site_windows(*cursors(spark, sf)).where(F.col("status") == "run")
    return C.new_listings(A.listings(spark, sf, kind), windows)


@query("new_listings", f"WITH {A.listings_cte('dirty')}, {CURSORS_CTE} SELECT doc_id, site_name, offer_start FROM listings WHERE {RUN_WHERE}")
def new_listings(spark: SparkSession, sf: str) -> DataFrame:
    return open_window(spark, sf, "dirty").select("doc_id", "site_name", "offer_start")


@query(
    "backfill_slice",
    f"WITH {A.listings_cte('dirty')} SELECT doc_id, offer_start, predecessor_id FROM listings WHERE site_name = 'click' "
    "AND offer_start >= TIMESTAMP '2024-01-05' AND offer_start < TIMESTAMP '2024-01-20'",
)
def backfill_slice(spark: SparkSession, sf: str) -> DataFrame:
    rows = C.backfill_slice(A.listings(spark, sf, "dirty"), "click", A.ntz("2024-01-05"), A.ntz("2024-01-20"))
    return rows.select("doc_id", "offer_start", "predecessor_id")


@query("distinct_sites", f"WITH {A.SCALARS_CTE} SELECT DISTINCT {A.duck_blank('txt')} AS site FROM scalars WHERE {A.duck_blank('txt')} IS NOT NULL")
def distinct_sites(spark: SparkSession, sf: str) -> DataFrame:
    return C.distinct_sites(A.scalars(spark, sf).withColumnRenamed("txt", "site_name"))


@query("site_subset", f"WITH {CURSORS_CTE} SELECT site, ts FROM uploads WHERE site IN ('click', 'view')")
def site_subset(spark: SparkSession, sf: str) -> DataFrame:
    return C.site_subset(cursors(spark, sf)[0], [" view", "click ", " ", "absent"])


# --- assignment ------------------------------------------------------------------------------


@query(
    "claim",
    match_sql(
        "contended",
        "SELECT c_id AS candidate_id, d_id AS duplicate_id, length(d_id) % 2 <> 0 AND "
        "row_number() OVER (PARTITION BY d_id ORDER BY c_start, c_id) = 1 AS claimed FROM best WHERE score >= 0.7",
    ),
)
def claim(spark: SparkSession, sf: str) -> DataFrame:
    best = C.score_gate(C.best_duplicate(candidates(spark, sf), A.listings(spark, sf), RULES, min_score=RULES.min_score), RULES)
    proposals = best.select(
        F.col("c_id").alias("candidate_id"),
        F.col("c_start").alias("offer_start"),
        F.col("d_id").alias("duplicate_id"),
        F.when(F.length("d_id") % 2 == 0, F.lit("taken")).alias("current_successor"),
    )
    return R.claims(proposals).select("candidate_id", "duplicate_id", "claimed")


LINK_SELECT = "SELECT c_id AS candidate_id, d_id AS duplicate_id FROM picked"


@query("greedy_links", match_sql("contended", LINK_SELECT, greedy=True))
def greedy_links(spark: SparkSession, sf: str) -> DataFrame:
    return R.resolve_links(candidates(spark, sf), A.listings(spark, sf), RULES)


@query("greedy_links_sparse", match_sql("sparse", LINK_SELECT, greedy=True))
def greedy_links_sparse(spark: SparkSession, sf: str) -> DataFrame:
    return R.resolve_links(candidates(spark, sf, "sparse"), A.listings(spark, sf, "sparse"), RULES)


@query("greedy_links_split", match_sql("contended", LINK_SELECT, greedy=True))
def greedy_links_split(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks spread over many buckets and preference lists continued over rounds."""
    rows = A.listings(spark, sf)
    return R.resolve_links(candidates(spark, sf), rows, RULES, bucket_wishes=60, list_length=3, hot_rows=50)


@query(
    "run_metrics",
    match_sql(
        "contended",
        ", wins AS (SELECT c_id, d_id FROM picked), tops AS (SELECT c_id, d_id FROM best WHERE score >= 0.7) "
        "SELECT l.site_name AS site, count(*) AS processed, count(w.d_id) AS matches_found, count(w.d_id) AS claims_ok, "
        "CAST(0 AS BIGINT) AS claims_failed, count(*) FILTER (WHERE t.d_id IS NOT NULL AND w.d_id IS DISTINCT FROM t.d_id) AS first_choice_lost, "
        "count(w.d_id) AS linked FROM listings l LEFT JOIN wins w ON l.doc_id = w.c_id LEFT JOIN tops t ON l.doc_id = t.c_id GROUP BY l.site_name",
        greedy=True,
    ).replace(") , wins", "), wins"),
)
def run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    asked, rows = candidates(spark, sf), A.listings(spark, sf)
    gated = C.score_gate(C.best_duplicate(asked, rows, RULES, min_score=RULES.min_score), RULES)
    return R.run_metrics(rows, R.resolve_links(asked, rows, RULES), gated)


# --- jobs ------------------------------------------------------------------------------------

INCREMENTAL_CTES = f"{A.listings_cte('contended')}, {CURSORS_CTE}, {candidate_cte(where=RUN_WHERE)}, {pair_ctes()}, {greedy_ctes()}"
LINKED_SELECT = (
    "SELECT l.doc_id, p.d_id AS predecessor_id, s.c_id AS successor_id FROM listings l LEFT JOIN picked p ON p.c_id = l.doc_id "
    "LEFT JOIN picked s ON s.d_id = l.doc_id WHERE p.d_id IS NOT NULL OR s.c_id IS NOT NULL"
)


@query("match_incremental", f"WITH RECURSIVE {INCREMENTAL_CTES} {LINKED_SELECT}")
def match_incremental(spark: SparkSession, sf: str) -> DataFrame:
    run = run_matching(A.listings(spark, sf), *cursors(spark, sf), RULES, now=A.ntz(A.NOW))
    return run.listings.select("doc_id", "predecessor_id", "successor_id").where(
        F.col("predecessor_id").isNotNull() | F.col("successor_id").isNotNull()
    )


@query(
    "marker_advance",
    f"WITH {A.listings_cte('contended')}, {CURSORS_CTE}, w AS (SELECT site_name AS site, max(offer_start) AS ts FROM listings WHERE {RUN_WHERE} GROUP BY site_name) "
    "SELECT u.site, coalesce(w.ts, m.ts, u.ts) AS ts FROM uploads u LEFT JOIN markers m ON u.site = m.site LEFT JOIN w ON u.site = w.site",
)
def marker_advance(spark: SparkSession, sf: str) -> DataFrame:
    uploads, markers = cursors(spark, sf)
    return advance_markers(markers, site_windows(uploads, markers), open_window(spark, sf, "contended"))


# Stored progress: every site but 'signup' (which starts at the fixed first month); 'click' was reset before.
PROGRESS_SQL = (
    "SELECT event_type AS site, CAST(date_trunc('day', min(ts)) AS TIMESTAMP{ntz}) + INTERVAL '3' DAY AS next_from, event_type = 'click' AS reset_completed, "
    "max(ts) AS updated_at FROM {events} WHERE event_type <> 'signup' GROUP BY event_type"
)
PROGRESS_CTE = f"progress AS ({PROGRESS_SQL.format(events='events', ntz='')})"
# Links from before: sound ones, to the next event, at the site that was reset before; at all others they lead nowhere and are reset.
PAIR = "OVER (PARTITION BY floor(event_id / 2) ORDER BY event_id)"
PRESET = A.CONTENDED | {
    "predecessor_id": "CASE WHEN event_type <> 'click' THEN CASE WHEN event_id % 50 = 0 THEN 'p' || CAST(event_id AS STRING) END "
    f"WHEN event_id % 6 = 1 AND lag(event_type) {PAIR} = 'click' THEN '[click]' || CAST(event_id - 1 AS STRING) END",
    "successor_id": "CASE WHEN event_type <> 'click' THEN CASE WHEN event_id % 60 = 0 THEN 's' || CAST(event_id AS STRING) END "
    f"WHEN event_id % 6 = 0 AND lead(event_type) {PAIR} = 'click' THEN '[click]' || CAST(event_id + 1 AS STRING) END",
}
A.LISTING_SETS["preset"] = PRESET
RESET_CTE = (
    f"{A.listings_cte('preset', 'stored')}, {PROGRESS_CTE}, listings AS (SELECT * REPLACE ("
    "CASE WHEN site_name = 'click' THEN predecessor_id END AS predecessor_id, CASE WHEN site_name = 'click' THEN successor_id END AS successor_id) FROM stored)"
)
BACKFILL_WHERE = (
    "offer_start < TIMESTAMP '2024-02-01' AND EXISTS (SELECT 1 FROM progress p WHERE p.site = listings.site_name AND offer_start >= p.next_from)"
)
BACKFILL_SQL = (
    f"WITH RECURSIVE {RESET_CTE}, {candidate_cte(where=BACKFILL_WHERE)}, {pair_ctes()}, {greedy_ctes()}, "
    "kept AS (SELECT p.* FROM picked p JOIN listings l ON l.doc_id = p.c_id WHERE l.predecessor_id IS NULL), "
    "final AS (SELECT l.doc_id, coalesce(l.predecessor_id, p.d_id) AS predecessor_id, coalesce(l.successor_id, s.c_id) AS successor_id "
    "FROM listings l LEFT JOIN kept p ON p.c_id = l.doc_id LEFT JOIN kept s ON s.d_id = l.doc_id) "
    "SELECT * FROM final WHERE predecessor_id IS NOT NULL OR successor_id IS NOT NULL"
)


def progress(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(PROGRESS_SQL.replace("{ntz}", "_NTZ"), events=table(spark, sf, "events"))


@query("backfill_links", BACKFILL_SQL)
def backfill_links(spark: SparkSession, sf: str) -> DataFrame:
    run = run_backfill(A.listings(spark, sf, "preset"), progress(spark, sf), A.ntz(A.NOW), RULES)
    linked = F.col("predecessor_id").isNotNull() | F.col("successor_id").isNotNull()
    return run.listings.select("doc_id", "predecessor_id", "successor_id").where(linked)


MONTHLY_PROGRESS = PROGRESS_SQL.replace("event_type = 'click'", "false").replace("WHERE event_type <> 'signup' ", "").replace("'3' DAY", "'0' DAY")
MONTHLY_SQL = BACKFILL_SQL.replace("CASE WHEN site_name = 'click' THEN predecessor_id END", "CAST(NULL AS VARCHAR)").replace(
    "CASE WHEN site_name = 'click' THEN successor_id END", "CAST(NULL AS VARCHAR)"
).replace(PROGRESS_CTE, f"progress AS ({MONTHLY_PROGRESS.format(events='events', ntz='')})")


@query("backfill_months", MONTHLY_SQL)
def backfill_months(spark: SparkSession, sf: str) -> DataFrame:
    """Month after month with a full reset and the closing validation."""
    stored = spark.sql(MONTHLY_PROGRESS.replace("{ntz}", "_NTZ"), events=table(spark, sf, "events"))
    run = run_backfill(A.listings(spark, sf, "preset"), stored, A.ntz(A.NOW), RULES, by_month=True)
    linked = F.col("predecessor_id").isNotNull() | F.col("successor_id").isNotNull()
    return run.listings.select("doc_id", "predecessor_id", "successor_id").where(linked)


@query(
    "backfill_state",
    f"WITH {PROGRESS_CTE} SELECT s.site, CASE WHEN s.site IN ('click', 'signup') THEN TIMESTAMP '2024-02-01' "
    f"ELSE p.next_from END AS next_from, CASE WHEN s.site = 'signup' THEN true ELSE p.reset_completed END AS reset_completed, "
    f"CASE WHEN s.site IN ('click', 'signup') THEN {A.NOW_SQL} ELSE p.updated_at END AS updated_at "
    "FROM (SELECT DISTINCT event_type AS site FROM events) s LEFT JOIN progress p ON s.site = p.site",
)
def backfill_state(spark: SparkSession, sf: str) -> DataFrame:
    sites = table(spark, sf, "events").select(F.col("event_type").alias("site")).distinct()
    finished = sites.where(F.col("site").isin("click", "signup")).select(
        "site",
        A.ntz("2024-02-01").alias("next_from"),
        F.when(F.col("site") == "signup", F.lit(True)).alias("reset_completed"),
    )
    return advance_backfill(progress(spark, sf), finished, A.ntz(A.NOW))


# --- link columns ----------------------------------------------------------------------------

LINKS_SQL = (
    "SELECT 'd' || CAST(event_id AS STRING) AS candidate_id, 'd' || CAST(event_id + 7 AS STRING) AS duplicate_id "
    "FROM {events} WHERE event_id % 3 = 0"
)
LINKS_CTE = f"{A.CHAINS_CTE}, links AS ({LINKS_SQL.format(events='events')})"


def links(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(LINKS_SQL, events=table(spark, sf, "events"))


def chain_rows(spark: SparkSession, sf: str) -> DataFrame:
    return A.chains(spark, sf).select("doc_id", "predecessor_id", "successor_id")


@query(
    "link_predecessors",
    f"WITH {LINKS_CTE} SELECT c.doc_id, coalesce(l.duplicate_id, c.predecessor_id) AS predecessor_id, c.successor_id FROM chains c LEFT JOIN links l ON l.candidate_id = c.doc_id",
)
def link_predecessors(spark: SparkSession, sf: str) -> DataFrame:
    return L.link_predecessors(chain_rows(spark, sf), links(spark, sf))


@query(
    "link_predecessors_cas",
    f"WITH {LINKS_CTE} SELECT c.doc_id, coalesce(c.predecessor_id, l.duplicate_id) AS predecessor_id, c.successor_id, "
    "l.duplicate_id IS NOT NULL AND c.predecessor_id IS NOT NULL AS conflict FROM chains c LEFT JOIN links l ON l.candidate_id = c.doc_id",
)
def link_predecessors_cas(spark: SparkSession, sf: str) -> DataFrame:
    return L.link_predecessors_if_free(chain_rows(spark, sf), links(spark, sf))


# Claims stand on every fifth listing, half of them by another candidate than the refused one.
ROLLBACK_CASE = "CASE WHEN event_id % 5 = 0 THEN 'd' || CAST(event_id - CASE WHEN event_id % 2 = 0 THEN 7 ELSE 8 END AS STRING) END"


@query(
    "claim_rollback",
    f"WITH {LINKS_CTE}, claimed AS (SELECT 'd' || CAST(event_id AS VARCHAR) AS doc_id, {ROLLBACK_CASE} AS successor_id FROM events), "
    "refused AS (SELECT l.* FROM links l JOIN chains c ON c.doc_id = l.candidate_id WHERE c.predecessor_id IS NOT NULL) "
    "SELECT doc_id, CASE WHEN EXISTS (SELECT 1 FROM refused r WHERE r.duplicate_id = claimed.doc_id AND r.candidate_id = claimed.successor_id) "
    "THEN NULL ELSE successor_id END AS successor_id FROM claimed",
)
def claim_rollback(spark: SparkSession, sf: str) -> DataFrame:
    linked = L.link_predecessors_if_free(chain_rows(spark, sf), links(spark, sf))
    claimed = table(spark, sf, "events").selectExpr("'d' || CAST(event_id AS STRING) AS doc_id", f"{ROLLBACK_CASE} AS successor_id")
    return L.roll_back_claims(claimed, L.refused_links(linked, links(spark, sf)))


@query(
    "reset_links",
    f"WITH {A.CHAINS_CTE} SELECT doc_id, CASE WHEN site_name <> 'click' THEN predecessor_id END AS predecessor_id, "
    "CASE WHEN site_name <> 'click' THEN successor_id END AS successor_id, CASE WHEN site_name <> 'click' THEN true END AS is_duplicate FROM chains",
)
def reset_links(spark: SparkSession, sf: str) -> DataFrame:
    rows = A.chains(spark, sf).withColumn("is_duplicate", F.lit(True))
    return L.reset_links(rows, F.col("site_name") == "click").select("doc_id", "predecessor_id", "successor_id", "is_duplicate")


@query(
    "reset_where_linked",
    f"WITH {A.CHAINS_CTE} SELECT doc_id, CAST(NULL AS VARCHAR) AS predecessor_id, CAST(NULL AS VARCHAR) AS successor_id, "
    "predecessor_id IS NOT NULL OR successor_id IS NOT NULL AS was_linked FROM chains",
)
def reset_where_linked(spark: SparkSession, sf: str) -> DataFrame:
    linked = F.col("predecessor_id").isNotNull() | F.col("successor_id").isNotNull()
    rows = chain_rows(spark, sf).withColumn("was_linked", linked)
    return L.reset_links(rows, linked)
