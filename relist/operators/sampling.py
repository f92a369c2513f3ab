"""Report samples and the windows they come from; every limit here is the size of a report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relist.functions.scoring import MatchRules
from relist.functions.text import strip
from relist.functions.times import plus_days
from relist.operators.candidates import best_duplicate
from relist.operators.mapping import SUMMARY_FIELDS, listing_summary, short_view

# Fields a sampled listing must have, rows per (brand, model), score worth inspecting.
REQUIRED_FIELDS = ("brand", "model", "site_name", "seller_type", "name", "offer_end", "latest_price", "is_new")
GROUP_ROWS = 8
HIGH_SCORE = 0.65


def sample_filter(listings: DataFrame, anchor: Column, recent_days: int) -> DataFrame:
    condition = F.col("offer_end") >= plus_days(anchor, -recent_days)
    for name in REQUIRED_FIELDS:
        condition = condition & F.col(name).isNotNull()
    return listings.where(condition)


def stratified_sample(listings: DataFrame, size: int, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``size`` newest listings, at most ``group_rows`` per brand and model unless too few are left."""
    keyed = listings.withColumns({"_brand": F.lower(strip(F.col("brand"))), "_model": F.lower(strip(F.col("model")))})
    keyed = keyed.where((F.col("_brand") != "") & (F.col("_model") != ""))
    newest = [F.col("offer_end").desc(), F.col("doc_id")]
    in_group = Window.partitionBy("_brand", "_model").orderBy(*newest)
    first = keyed.withColumn("_n", F.row_number().over(in_group)).where(F.col("_n") <= group_rows).drop("_n")
    rest = keyed.join(first.select("doc_id"), "doc_id", "left_anti")
    return (
        first.withColumn("overflow", F.lit(0))
        .unionByName(rest.orderBy(*newest).limit(size).withColumn("overflow", F.lit(1)))
        .orderBy("overflow", *newest)
        .limit(size)
        .drop("_brand", "_model")
    )


def match_quality(
    sample: DataFrame, candidates: DataFrame, listings: DataFrame, rules: MatchRules = MatchRules(), score: float = HIGH_SCORE
) -> DataFrame:
    """Sampled candidates with a high-scored best duplicate, both shown side by side."""
    asked = candidates.join(sample.select("doc_id"), "doc_id", "left_semi")
    best = best_duplicate(asked, listings, rules, min_score=score).where(F.col("score") > F.lit(score))
    view = short_view(listings)

    def side(prefix: str, key: str) -> DataFrame:
        return view.select(F.col("doc_id").alias(key), *[F.col(c).alias(f"{prefix}_{c}") for c in view.columns if c != "doc_id"])

    return (
        best.select(F.col("c_id").alias("candidate_id"), F.col("d_id").alias("duplicate_id"), "score")
        .join(side("candidate", "candidate_id"), "candidate_id", "left")
        .join(side("duplicate", "duplicate_id"), "duplicate_id", "left")
    )


def matched_sample(window: DataFrame, listings: DataFrame, size: int) -> DataFrame:
    """First linked listings of a window beside their predecessors, which may lie outside it."""
    candidate = listing_summary(window.where(F.col("predecessor_id").isNotNull())).orderBy("id").limit(max(1, size))
    predecessor = listing_summary(listings)
    left = candidate.select(*[F.col(name).alias(f"candidate_{name}") for name in ("id", *SUMMARY_FIELDS)])
    right = predecessor.select(*[F.col(name).alias(f"predecessor_{name}") for name in ("id", *SUMMARY_FIELDS)])
    return left.join(right, F.col("candidate_predecessor_id") == F.col("predecessor_id"), "left")


def unmatched_sample(window: DataFrame, size: int) -> DataFrame:
    free = window.where(F.col("predecessor_id").isNull() & F.col("successor_id").isNull())
    return listing_summary(free).orderBy("id").limit(max(1, size))


def top_site(listings: DataFrame) -> DataFrame:
    """Site with the most listings; the smallest name wins a tie."""
    return (
        listings.where(F.col("site_name").isNotNull())
        .groupBy(F.col("site_name").alias("site"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.col("n").desc(), "site")
        .limit(1)
    )


def site_time_window(listings: DataFrame, hours: int) -> DataFrame:
    """Per site the last ``hours`` of listing starts, never before the first and at least a second long."""
    low, high = F.col("earliest"), F.col("latest")
    wide = F.greatest(high - F.make_dt_interval(F.lit(0), F.lit(max(1, hours))), low)
    second = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(1).cast("decimal(18,6)"))
    return (
        listings.groupBy(F.col("site_name").alias("site"))
        .agg(F.min("offer_start").alias("earliest"), F.max("offer_start").alias("latest"))
        .where(high.isNotNull())
        .select(
            "site",
            F.when(wide >= high, high - second).otherwise(wide).alias("lower_bound"),
            high.alias("upper_bound"),
        )
    )
