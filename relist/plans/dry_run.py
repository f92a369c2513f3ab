"""Trial match run on a copy: match a window twice and report on it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relist.functions.scoring import MatchRules
from relist.operators.links import RESET_COLUMNS, reset_links
from relist.operators.sampling import matched_sample, site_time_window, top_site, unmatched_sample
from relist.operators.validation import (
    failure_details,
    link_snapshot,
    snapshot_diff,
    verify_window_chains,
    window_violations,
)
from relist.plans.matching import match_incremental
from relist.runtime import cut_lineage
from relist.sources.tables import has_links


@dataclass
class DryRun:
    summary: DataFrame
    metrics: DataFrame
    matched: DataFrame
    unmatched: DataFrame
    failures: DataFrame
    changed: DataFrame


def match_dry_run(
    listings: DataFrame, window_hours: int, sample_size: int, rules: MatchRules = MatchRules(), now: Column | None = None
) -> DryRun:
    """Reset links, match the last hours of the largest site twice, verify chains and compare the runs.

    The second run starts where the first one left the marker, as the next scheduled run would.
    """
    linked = has_links(*[name for name in RESET_COLUMNS if name == "is_duplicate" and name in listings.columns])
    fresh = reset_links(listings, linked)
    site = top_site(fresh).select("site")
    seed = cut_lineage(site_time_window(fresh.join(site.withColumnRenamed("site", "site_name"), "site_name", "left_semi"), window_hours))
    uploads = seed.select("site", F.col("upper_bound").alias("ts"))
    markers = seed.select("site", F.col("lower_bound").alias("ts"))

    def in_window(rows: DataFrame) -> DataFrame:
        bounds = seed.withColumnRenamed("site", "site_name")
        return (
            rows.join(bounds, "site_name")
            .where(F.col("offer_start").between(F.col("lower_bound"), F.col("upper_bound")))
            .drop("lower_bound", "upper_bound")
        )

    first = match_incremental(fresh, uploads, markers, rules, now=now)
    after_first = cut_lineage(first.listings)
    second = match_incremental(after_first, uploads, cut_lineage(first.markers), rules, now=now)
    after_second = cut_lineage(second.listings)

    window = in_window(after_first)
    changed = cut_lineage(
        snapshot_diff(link_snapshot(window), link_snapshot(in_window(after_second)))
    )
    violations = window_violations(window, after_first)
    chains = verify_window_chains(window, after_first)
    changes = changed.agg(F.count("*").alias("n")).scalar()
    summary = chains.select(
        (F.col("is_valid") & (changes == 0)).alias("ok"),
        (changes == 0).alias("idempotent"),
        changes.alias("changed_docs"),
        first.links.agg(F.count("*").alias("n")).scalar().alias("linked"),
        "*",
    )
    causes = violations.unionByName(changed.select(F.lit("idempotency_failed").alias("kind"), F.col("doc_id").alias("example")))
    return DryRun(
        summary=summary,
        metrics=first.metrics,
        matched=matched_sample(window, after_first, sample_size),
        unmatched=unmatched_sample(window, sample_size),
        failures=failure_details(causes),
        changed=changed,
    )
