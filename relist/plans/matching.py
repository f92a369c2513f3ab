"""Incremental match run: cursor windows, links, marker advance."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relist.functions.scoring import MatchRules
from relist.operators.candidates import new_listings, site_subset
from relist.operators.links import apply_links
from relist.operators.mapping import candidate_defaults
from relist.operators.resolver import resolve_links, run_metrics
from relist.runtime import cut_lineage
from relist.schemas import LINK_COLUMNS
from relist.sources.state import advance_markers, site_windows
from relist.sources.tables import ensure_columns


@dataclass
class MatchRun:
    windows: DataFrame
    links: DataFrame
    listings: DataFrame
    markers: DataFrame
    metrics: DataFrame


def match_incremental(
    listings: DataFrame,
    uploads: DataFrame,
    markers: DataFrame,
    rules: MatchRules = MatchRules(),
    sites: list[str] | None = None,
    now: Column | None = None,
) -> MatchRun:
    """Link the listings of every site's open window; all sites go in one job."""
    listings = ensure_columns(listings, {name: "string" for name in LINK_COLUMNS})
    windows = site_windows(site_subset(uploads, sites), markers)
    window = new_listings(listings, windows.where(F.col("status") == "run"))
    candidates = candidate_defaults(window, now)
    links = cut_lineage(resolve_links(candidates, listings, rules))
    return MatchRun(
        windows=windows,
        links=links,
        listings=apply_links(listings, links),
        markers=advance_markers(markers, windows, window),
        metrics=run_metrics(window, links),
    )
