"""Queries for chain validation, snapshots and report samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relist.catalog import adapters as A
from relist.catalog import matching as M
from relist.catalog.registry import query
from relist.functions.scoring import MatchRules
from relist.operators import sampling as S
from relist.operators import validation as V
from relist.plans import dry_run
from relist.runtime import scratch_path
from relist.sources.reports import read_report, write_report
from relist.sources.tables import has_links as linked_rows

RULES = MatchRules()

LINKS_CTE = (
    f"{A.CHAINS_CTE}, links AS (SELECT doc_id, {A.duck_blank('predecessor_id')} AS predecessor_id, "
    f"{A.duck_blank('successor_id')} AS successor_id, offer_start FROM chains)"
)
MISMATCH_CTE = (
    "mismatch AS (SELECT l.doc_id, 'successor_id' AS field, l.successor_id AS target_id, t.predecessor_id AS back_id, t.doc_id IS NOT NULL AS target_found "
    "FROM links l LEFT JOIN links t ON t.doc_id = l.successor_id WHERE l.successor_id IS NOT NULL AND t.predecessor_id IS DISTINCT FROM l.doc_id "
    "UNION ALL SELECT l.doc_id, 'predecessor_id', l.predecessor_id, t.successor_id, t.doc_id IS NOT NULL "
    "FROM links l LEFT JOIN links t ON t.doc_id = l.predecessor_id WHERE l.predecessor_id IS NOT NULL AND t.successor_id IS DISTINCT FROM l.doc_id)"
)
# Walk from every listing until it comes back, ends, or took more steps than the longest chain can have.
CYCLE_CTES = (
    "walk AS (SELECT doc_id AS start, successor_id AS cur, 1 AS n FROM {links} WHERE successor_id IS NOT NULL "
    "UNION ALL SELECT w.start, l.successor_id, w.n + 1 FROM walk w JOIN {links} l ON l.doc_id = w.cur "
    "WHERE w.cur <> w.start AND l.successor_id IS NOT NULL AND w.n < 64), "
    "loops AS (SELECT start, n AS nodes FROM walk WHERE cur = start), "
    "heads AS (SELECT lo.start, lo.nodes FROM loops lo WHERE lo.start = (SELECT min(w.cur) FROM walk w WHERE w.start = lo.start)), "
    "cycles AS (SELECT h.start AS cycle_id, CAST(w.n % h.nodes AS BIGINT) AS position, CAST(h.nodes AS BIGINT) AS nodes, w.cur AS doc_id "
    "FROM heads h JOIN walk w ON w.start = h.start), "
    "cycle_text AS (SELECT cycle_id, cycle_id || ' (' || nodes || ' nodes)' AS text FROM cycles WHERE position = 0)"
)
WHOLE_CYCLES = CYCLE_CTES.format(links="links")
VIOLATIONS_CTE = (
    "violations AS (SELECT '1_invalid_link' AS kind, doc_id, doc_id || ' holds a blank predecessor_id' AS message FROM chains "
    f"WHERE predecessor_id IS NOT NULL AND {A.duck_blank('predecessor_id')} IS NULL UNION ALL "
    "SELECT '1_invalid_link', doc_id, doc_id || ' holds a blank successor_id' FROM chains "
    f"WHERE successor_id IS NOT NULL AND {A.duck_blank('successor_id')} IS NULL UNION ALL "
    "SELECT CASE field WHEN 'successor_id' THEN '2_successor' ELSE '3_predecessor' END, doc_id, "
    "doc_id || ' names ' || target_id || ' as ' || field || ', whose ' || CASE field WHEN 'successor_id' THEN 'predecessor_id' ELSE 'successor_id' END "
    "|| ' is ' || coalesce(back_id, 'empty') FROM mismatch UNION ALL "
    "SELECT '4_cycle', cycle_id, 'successors lead back to ' || text FROM cycle_text)"
)
VALIDATION = f"WITH RECURSIVE {LINKS_CTE}, {MISMATCH_CTE}, {WHOLE_CYCLES}, {VIOLATIONS_CTE}"


def links(spark: SparkSession, sf: str) -> DataFrame:
    return V.link_rows(A.chains(spark, sf))


@query("link_mismatch", f"WITH {LINKS_CTE}, {MISMATCH_CTE} SELECT * FROM mismatch")
def link_mismatch(spark: SparkSession, sf: str) -> DataFrame:
    return V.link_mismatch(links(spark, sf))


@query(
    "dangling_links",
    f"WITH {LINKS_CTE} SELECT doc_id, 'predecessor_id' AS field, predecessor_id AS target_id FROM links WHERE predecessor_id IS NOT NULL "
    "AND predecessor_id NOT IN (SELECT doc_id FROM links) UNION ALL SELECT doc_id, 'successor_id', successor_id FROM links "
    "WHERE successor_id IS NOT NULL AND successor_id NOT IN (SELECT doc_id FROM links)",
)
def dangling_links(spark: SparkSession, sf: str) -> DataFrame:
    return V.dangling_links(links(spark, sf))


@query(
    "pred_conflicts",
    f"WITH {LINKS_CTE}, n AS (SELECT predecessor_id, doc_id, count(*) OVER (PARTITION BY predecessor_id) AS sharers FROM links WHERE predecessor_id IS NOT NULL) "
    "SELECT * FROM n WHERE sharers > 1",
)
def pred_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    return V.predecessor_conflicts(links(spark, sf))


@query("link_cycles", f"WITH RECURSIVE {LINKS_CTE}, {WHOLE_CYCLES} SELECT cycle_id, position, nodes, doc_id FROM cycles")
def link_cycles(spark: SparkSession, sf: str) -> DataFrame:
    return V.link_cycles(links(spark, sf))


@query("validate_chains", f"{VALIDATION} SELECT * FROM violations")
def validate_chains(spark: SparkSession, sf: str) -> DataFrame:
    return V.validate_chains(A.chains(spark, sf))


@query(
    "validation_summary",
    f"{VALIDATION} SELECT (SELECT count(*) FROM violations) AS errors, kind, doc_id, message FROM violations ORDER BY kind, doc_id LIMIT 10",
)
def validation_summary(spark: SparkSession, sf: str) -> DataFrame:
    return V.validation_summary(V.validate_chains(A.chains(spark, sf)))


# The window is the first half of January; references may leave it.
WINDOW_END = "2024-01-16"
WINDOW_LINKS = f"{LINKS_CTE}, inside AS (SELECT * FROM links WHERE offer_start < TIMESTAMP '{WINDOW_END}'), own AS (SELECT l.doc_id, l.predecessor_id, l.successor_id FROM inside l)"
WINDOW_VIOLATIONS = (
    "refs AS (SELECT doc_id, 'p' AS side, predecessor_id AS target FROM own WHERE predecessor_id IS NOT NULL UNION ALL "
    "SELECT doc_id, 's', successor_id FROM own WHERE successor_id IS NOT NULL), "
    "resolved AS (SELECT r.*, t.doc_id AS found, CASE r.side WHEN 'p' THEN t.successor_id ELSE t.predecessor_id END AS back FROM refs r LEFT JOIN links t ON t.doc_id = r.target), "
    + CYCLE_CTES.format(links="own")
    + ", violations AS (SELECT CASE side WHEN 'p' THEN 'missing_predecessors' ELSE 'missing_successors' END AS kind, doc_id || ' -> ' || target AS example FROM resolved WHERE found IS NULL "
    "UNION ALL SELECT 'reverse_mismatches', doc_id || ' -> ' || target FROM resolved WHERE found IS NOT NULL AND back IS DISTINCT FROM doc_id "
    "UNION ALL SELECT 'predecessor_conflicts', predecessor_id FROM own WHERE predecessor_id IS NOT NULL GROUP BY predecessor_id HAVING count(*) > 1 "
    "UNION ALL SELECT 'cycles', text FROM cycle_text)"
)


def chain_window(spark: SparkSession, sf: str) -> DataFrame:
    return A.chains(spark, sf).where(F.col("offer_start") < A.ntz(WINDOW_END))


@query(
    "verify_window_chains",
    f"WITH RECURSIVE {WINDOW_LINKS}, {WINDOW_VIOLATIONS}, "
    "ext AS (SELECT count(DISTINCT target) AS n FROM resolved WHERE found IS NOT NULL AND target NOT IN (SELECT doc_id FROM own)) "
    "SELECT (SELECT count(*) FROM violations) = 0 AS is_valid, (SELECT count(*) FROM own) AS checked_docs, "
    "(SELECT count(*) FROM own) + (SELECT n FROM ext) AS resolved_docs, (SELECT n FROM ext) AS resolved_external_refs, "
    + ", ".join(f"(SELECT count(*) FROM violations WHERE kind = '{kind}') AS {kind}" for kind in V.REPORT_KINDS),
)
def verify_window_chains(spark: SparkSession, sf: str) -> DataFrame:
    return V.verify_window_chains(chain_window(spark, sf), A.chains(spark, sf))


@query(
    "failure_details",
    f"WITH RECURSIVE {WINDOW_LINKS}, {WINDOW_VIOLATIONS}, ranked AS (SELECT kind, example, row_number() OVER (PARTITION BY kind ORDER BY example) AS n FROM violations) "
    "SELECT kind, count(*) AS n, string_agg(example, '; ' ORDER BY example) FILTER (WHERE n <= 20) AS examples FROM ranked GROUP BY kind",
)
def failure_details(spark: SparkSession, sf: str) -> DataFrame:
    details = V.failure_details(V.window_violations(chain_window(spark, sf), A.chains(spark, sf)))
    return details.withColumn("examples", F.array_join("examples", "; "))


@query(
    "snapshot_diff",
    f"WITH {A.CHAINS_CTE}, a AS (SELECT doc_id, predecessor_id, successor_id FROM chains WHERE offer_start < TIMESTAMP '2024-01-25'), "
    "b AS (SELECT doc_id, CASE WHEN doc_id LIKE '%9' THEN NULL ELSE predecessor_id END AS predecessor_id, successor_id FROM chains WHERE offer_start > TIMESTAMP '2024-01-05') "
    "SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, a.doc_id IS NOT NULL AS in_first, b.doc_id IS NOT NULL AS in_second, "
    "a.predecessor_id AS first_predecessor, a.successor_id AS first_successor, b.predecessor_id AS second_predecessor, b.successor_id AS second_successor "
    "FROM a FULL JOIN b ON a.doc_id = b.doc_id WHERE a.doc_id IS NULL OR b.doc_id IS NULL OR a.predecessor_id IS DISTINCT FROM b.predecessor_id "
    "OR a.successor_id IS DISTINCT FROM b.successor_id",
)
def snapshot_diff(spark: SparkSession, sf: str) -> DataFrame:
    rows = A.chains(spark, sf)
    second = rows.where(F.col("offer_start") > A.ntz("2024-01-05")).withColumn(
        "predecessor_id", F.when(~F.col("doc_id").endswith("9"), F.col("predecessor_id"))
    )
    return V.snapshot_diff(V.link_snapshot(rows.where(F.col("offer_start") < A.ntz("2024-01-25"))), V.link_snapshot(second))


@query("has_links", f"WITH {A.CHAINS_CTE} SELECT doc_id FROM chains WHERE predecessor_id IS NOT NULL OR successor_id IS NOT NULL")
def has_links(spark: SparkSession, sf: str) -> DataFrame:
    return A.chains(spark, sf).where(linked_rows()).select("doc_id")


# --- samples ---------------------------------------------------------------------------------

SAMPLE_WHERE = (
    "brand IS NOT NULL AND model IS NOT NULL AND site_name IS NOT NULL AND seller_type IS NOT NULL AND name IS NOT NULL AND offer_end IS NOT NULL "
    "AND latest_price IS NOT NULL AND is_new IS NOT NULL AND offer_end >= TIMESTAMP '2024-01-30' - INTERVAL 20 DAY"
)


def recent(spark: SparkSession, sf: str) -> DataFrame:
    return S.sample_filter(A.listings(spark, sf, "dirty"), A.ntz("2024-01-30"), 20)


@query("sample_filter", f"WITH {A.listings_cte('dirty')} SELECT doc_id, offer_end FROM listings WHERE {SAMPLE_WHERE}")
def sample_filter(spark: SparkSession, sf: str) -> DataFrame:
    return recent(spark, sf).select("doc_id", "offer_end")


def sample_cte(kind: str, where: str, size: int) -> str:
    brand, model = f"lower({A.duck_strip('brand')})", f"lower({A.duck_strip('model')})"
    return (
        f"placed AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY {brand}, {model} ORDER BY offer_end DESC, doc_id) <= 8 THEN 0 ELSE 1 END AS overflow "
        f"FROM listings WHERE {where} AND {brand} <> '' AND {model} <> ''), "
        f"sample AS (SELECT * FROM placed ORDER BY overflow, offer_end DESC, doc_id LIMIT {size})"
    )


@query(
    "stratified_sample",
    f"WITH {A.listings_cte('dirty')}, {sample_cte('dirty', SAMPLE_WHERE, 200)} SELECT doc_id, brand, model, offer_end, overflow FROM sample",
)
def stratified_sample(spark: SparkSession, sf: str) -> DataFrame:
    return S.stratified_sample(recent(spark, sf), 200).select("doc_id", "brand", "model", "offer_end", "overflow")


SIDE = ("brand", "model", "build_year", "latest_price", "mileage", "name")
SIDE_NAMES = {"build_year": "year", "latest_price": "price"}


@query(
    "match_quality",
    f"WITH {A.listings_cte('contended')}, {sample_cte('contended', SAMPLE_WHERE, 300)}, "
    f"{M.candidate_cte(where='doc_id IN (SELECT doc_id FROM sample)')}, {M.pair_ctes()} "
    "SELECT c_id AS candidate_id, d_id AS duplicate_id, score, "
    + ", ".join(f"{t}.{c} AS {side}_{SIDE_NAMES.get(c, c)}" for t, side in (("a", "candidate"), ("b", "duplicate")) for c in SIDE)
    + " FROM best JOIN listings a ON a.doc_id = c_id JOIN listings b ON b.doc_id = d_id WHERE score > 0.65",
)
def match_quality(spark: SparkSession, sf: str) -> DataFrame:
    rows = A.listings(spark, sf)
    sample = S.stratified_sample(S.sample_filter(rows, A.ntz("2024-01-30"), 20), 300)
    return S.match_quality(sample, M.candidates(spark, sf), rows, RULES)


SUMMARY = "doc_id, site_name, name, brand, model, offer_start, offer_end, latest_price, mileage, predecessor_id, successor_id".split(", ")
# Every fourth listing names the one seven events before it as its predecessor.
LINKED_COLUMNS = A.CONTENDED | {
    "doc_id": "'d' || CAST(event_id AS STRING)",
    "predecessor_id": "CASE WHEN event_id % 4 = 0 THEN 'd' || CAST(event_id - 7 AS STRING) END",
    "successor_id": "CASE WHEN event_id % 6 = 0 THEN 'd' || CAST(event_id + 7 AS STRING) END",
}
A.LISTING_SETS["linked"] = LINKED_COLUMNS


def linked_window(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    rows = A.listings(spark, sf, "linked")
    return rows.where((F.col("site_name") == "view") & (F.col("offer_start") > A.ntz("2024-01-10"))), rows


WINDOW_WHERE = "site_name = 'view' AND offer_start > TIMESTAMP '2024-01-10'"


@query(
    "matched_sample",
    f"WITH {A.listings_cte('linked')}, f AS (SELECT * FROM listings WHERE {WINDOW_WHERE} AND predecessor_id IS NOT NULL ORDER BY doc_id LIMIT 50) SELECT "
    + ", ".join(f"{t}.{c} AS {side}_{'id' if c == 'doc_id' else c}" for t, side in (("f", "candidate"), ("p", "predecessor")) for c in SUMMARY)
    + " FROM f LEFT JOIN listings p ON p.doc_id = f.predecessor_id",
)
def matched_sample(spark: SparkSession, sf: str) -> DataFrame:
    return S.matched_sample(*linked_window(spark, sf), 50)


@query(
    "unmatched_sample",
    f"WITH {A.listings_cte('linked')} SELECT doc_id AS id, {', '.join(SUMMARY[1:])} FROM listings WHERE {WINDOW_WHERE} "
    "AND predecessor_id IS NULL AND successor_id IS NULL ORDER BY doc_id LIMIT 50",
)
def unmatched_sample(spark: SparkSession, sf: str) -> DataFrame:
    return S.unmatched_sample(linked_window(spark, sf)[0], 50)


@query("top_site", "SELECT event_type AS site, count(*) AS n FROM events GROUP BY event_type ORDER BY n DESC, site LIMIT 1")
def top_site(spark: SparkSession, sf: str) -> DataFrame:
    return S.top_site(A.listings(spark, sf))


WINDOW_SQL = (
    "(SELECT event_type AS site, CASE WHEN max(ts) - INTERVAL {hours} HOUR < min(ts) AND min(ts) < max(ts) THEN min(ts) WHEN min(ts) = max(ts) THEN max(ts) - INTERVAL 1 SECOND "
    "ELSE max(ts) - INTERVAL {hours} HOUR END AS lower_bound, max(ts) AS upper_bound FROM events GROUP BY event_type)"
)


@query(
    "site_time_window",
    f"SELECT *, 'short' AS kind FROM {WINDOW_SQL.format(hours=48)} a UNION ALL SELECT *, 'clamped' FROM {WINDOW_SQL.format(hours=5000)} b",
)
def site_time_window(spark: SparkSession, sf: str) -> DataFrame:
    rows = A.listings(spark, sf)
    short = S.site_time_window(rows, 48).withColumn("kind", F.lit("short"))
    return short.unionByName(S.site_time_window(rows, 5000).withColumn("kind", F.lit("clamped")))


@query("report_write", f"WITH {A.CHAINS_CTE} SELECT site_name AS site, count(*) AS n, count(predecessor_id) AS linked FROM chains GROUP BY site_name")
def report_write(spark: SparkSession, sf: str) -> DataFrame:
    report = A.chains(spark, sf).groupBy(F.col("site_name").alias("site")).agg(
        F.count("*").alias("n"), F.count("predecessor_id").alias("linked")
    )
    path = scratch_path(spark, "report")
    write_report(report, path)
    return read_report(spark, path, "site string, n bigint, linked bigint")


# --- trial run -------------------------------------------------------------------------------

DRY_WINDOW = (
    "top AS (SELECT event_type AS site FROM events GROUP BY event_type ORDER BY count(*) DESC, event_type LIMIT 1), "
    "span AS (SELECT site, greatest(max(ts) - INTERVAL 240 HOUR, min(ts)) AS lo, max(ts) AS hi FROM events JOIN top ON event_type = site GROUP BY site)"
)
DRY_WHERE = "EXISTS (SELECT 1 FROM span WHERE span.site = listings.site_name AND offer_start BETWEEN lo AND hi)"


@query(
    "match_dry_run",
    f"WITH RECURSIVE {A.listings_cte('contended')}, {DRY_WINDOW}, {M.candidate_cte(where=DRY_WHERE)}, {M.pair_ctes()}, {M.greedy_ctes()}, "
    f"inside AS (SELECT doc_id FROM listings WHERE {DRY_WHERE}), "
    "ext AS (SELECT count(DISTINCT d_id) AS n FROM picked WHERE d_id NOT IN (SELECT doc_id FROM inside)) "
    "SELECT true AS ok, true AS idempotent, CAST(0 AS BIGINT) AS changed_docs, (SELECT count(*) FROM picked) AS linked, true AS is_valid, "
    "(SELECT count(*) FROM inside) AS checked_docs, (SELECT count(*) FROM inside) + (SELECT n FROM ext) AS resolved_docs, (SELECT n FROM ext) AS resolved_external_refs, "
    + ", ".join(f"CAST(0 AS BIGINT) AS {kind}" for kind in V.REPORT_KINDS)
    + ", (SELECT count(*) FROM inside) AS processed, (SELECT count(*) FROM picked) AS matches_found, "
    "(SELECT string_agg(c_id || '>' || d_id, ',' ORDER BY c_id) FROM (SELECT * FROM picked ORDER BY c_id LIMIT 20)) AS matched, "
    "(SELECT string_agg(doc_id, ',' ORDER BY doc_id) FROM (SELECT doc_id FROM inside WHERE doc_id NOT IN (SELECT c_id FROM picked) AND doc_id NOT IN (SELECT d_id FROM picked) ORDER BY doc_id LIMIT 20)) AS unmatched, "
    "CAST(0 AS BIGINT) AS failures, CAST(0 AS BIGINT) AS changed_rows",
)
def match_dry_run(spark: SparkSession, sf: str) -> DataFrame:
    stored = A.listings(spark, sf).withColumn(
        "predecessor_id", F.when(F.col("parapi_unique_id") % 9 == 0, F.lit("left from before"))
    )
    run = dry_run.match_dry_run(stored, 240, 20, RULES, A.ntz(A.NOW))

    def joined(rows: DataFrame, value: Column) -> Column:
        return rows.agg(F.array_join(F.sort_array(F.collect_list(value)), ",").alias("v")).scalar()

    return run.summary.select(
        "*",
        run.metrics.agg(F.sum("processed").alias("v")).scalar().alias("processed"),
        run.metrics.agg(F.sum("matches_found").alias("v")).scalar().alias("matches_found"),
        joined(run.matched, F.concat_ws(">", "candidate_id", "predecessor_id")).alias("matched"),
        joined(run.unmatched, F.col("id")).alias("unmatched"),
        run.failures.agg(F.count("*").alias("v")).scalar().alias("failures"),
        run.changed.agg(F.count("*").alias("v")).scalar().alias("changed_rows"),
    )


# Every listing should be linked as it is, but for every hundredth one.


@query(
    "scenario_invariants",
    f"WITH RECURSIVE {LINKS_CTE}, {WHOLE_CYCLES} SELECT 'unexpected_links' AS kind, doc_id AS example FROM links WHERE CAST(substr(doc_id, 2) AS BIGINT) % 100 = 7 "
    "UNION ALL SELECT 'missing_successors', doc_id || ' -> ' || successor_id FROM links WHERE successor_id IS NOT NULL AND successor_id NOT IN (SELECT doc_id FROM links) "
    "UNION ALL SELECT 'shared_successor', successor_id FROM links WHERE successor_id IS NOT NULL GROUP BY successor_id HAVING count(*) > 1 "
    "UNION ALL SELECT 'cycles', text FROM cycle_text",
)
def scenario_invariants(spark: SparkSession, sf: str) -> DataFrame:
    rows = A.chains(spark, sf)
    other = F.substring("doc_id", 2, 20).cast("bigint") % 100 == 7
    expected = links(spark, sf).withColumn("predecessor_id", F.when(other, F.lit("other")).otherwise(F.col("predecessor_id")))
    return V.scenario_violations(rows, expected)
