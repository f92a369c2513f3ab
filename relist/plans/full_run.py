"""Ingest, match and archive in strict order under one fixed upper bound."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from relist.functions.scoring import MatchRules
from relist.plans.archive import run_archive
from relist.plans.matching import match_incremental
from relist.runtime import committed_versions
from relist.schemas import CURSOR_SCHEMA, LINK_COLUMNS
from relist.sources.feed import read_raw
from relist.sources.state import read_version, write_state
from relist.sources.tables import read_listings
from relist.streaming.ingest import ingest, load_cursors


LINKS_SCHEMA = "doc_id string, predecessor_id string, successor_id string"


@dataclass
class StageReport:
    done: list[str] = field(default_factory=list)
    failed: str | None = None
    error: str | None = None


def run_stages(stages: dict[str, Callable[[], None]]) -> StageReport:
    """Run stages in order; the first failure ends the run."""
    report = StageReport()
    for name, stage in stages.items():
        try:
            stage()
        except Exception as error:
            report.failed, report.error = name, str(error)
            return report
        report.done.append(name)
    return report


def full_run(
    spark: SparkSession, landing: str, out: str, run_no: int, now: Column, rules: MatchRules = MatchRules()
) -> StageReport:
    """One run of all three stages over the tables under ``out``; ``run_no`` grows from run to run.

    A run reads only what earlier runs finished: links and markers of the newest number below its own
    that has both. So it can be repeated under its number, and links and markers cannot part ways.
    """

    def ingest_stage() -> None:
        query = ingest(spark, landing, out, now, load_till=now)
        if query is not None:
            query.awaitTermination()

    def match_stage() -> None:
        links_path, markers_path = f"{out}/links", f"{out}/markers"
        earlier = set(committed_versions(spark, links_path, run_no)) & set(committed_versions(spark, markers_path, run_no))
        newest = max(earlier, default=None)
        links = read_version(spark, links_path, newest, LINKS_SCHEMA)
        markers = read_version(spark, markers_path, newest, CURSOR_SCHEMA)
        run = match_incremental(read_listings(spark, f"{out}/listings", links), load_cursors(spark, out), markers, rules, now=now)
        linked = run.listings.where(F.col("predecessor_id").isNotNull() | F.col("successor_id").isNotNull())
        linked.select("doc_id", *LINK_COLUMNS).write.mode("overwrite").parquet(f"{links_path}/version={run_no}")
        write_state(run.markers, markers_path, run_no)

    def archive_stage() -> None:
        run_archive(spark, read_raw(spark, f"{out}/raw"), out, now)

    return run_stages({"ingest": ingest_stage, "match": match_stage, "archive": archive_stage})
