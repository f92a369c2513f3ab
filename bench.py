"""Time the headline queries and print one JSON line.

Each query runs once to warm up and is then timed to a full materialisation (a no-op sink).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from relist.catalog import load

HEADLINE = (
    "map_listing",
    "candidate_pairs",
    "candidate_pairs_sparse",
    "best_duplicate",
    "greedy_links",
    "greedy_links_sparse",
    "match_incremental",
    "backfill_links",
    "validate_chains",
    "listing_upsert",
    "feed_flatten",
    "archive_batches",
    "archive_write",
)


def session(cpus: str) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("relist-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="relist-bench-"))
        .getOrCreate()
    )


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    queries = load().queries
    seconds: dict[str, float] = {}
    for name in names:
        for _ in range(2):
            started = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, warm, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
