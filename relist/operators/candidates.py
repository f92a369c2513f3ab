"""Candidate generation: which earlier listings may a listing be a re-post of."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relist.functions import scoring
from relist.functions.scoring import MatchRules
from relist.functions.text import blank_to_null
from relist.functions.times import epoch_day, epoch_micros, plus_days
from relist.functions.walk import walk
from relist.runtime import cut_lineage

# Fields that must agree exactly or be missing on both sides.
BLOCK_TEXT_FIELDS = (
    "site_name",
    "region",
    "seller_type",
    "name",
    "brand",
    "model",
    "generation",
    "vin",
    "place",
    "steering_position",
    "gear_box",
    "gear_type",
    "body_type",
    "doors_num",
    "modification",
    "complectation",
    "fuel",
    "body_color",
    "condition",
)
BLOCK_VALUE_FIELDS = ("build_year", "engine_power", "engine_volume_liters", "count_owner", "is_new")
BLOCK_FIELDS = (*BLOCK_TEXT_FIELDS, *BLOCK_VALUE_FIELDS)
DOUBLE_FIELDS = ("engine_power", "engine_volume_liters")

# A span of a block has about BUCKET_WISHES times LIST_LENGTH candidates: so many listings go one after the other.
BUCKET_WISHES = 2_000
LIST_LENGTH = 32

# A block of many spans is looked through in steps of so many.
STEP = 32

# A block with more earlier listings than this is also split by price and mileage.
HOT_BLOCK_ROWS = 10_000
# Hot blocks are broadcast up to this number of 8-byte hashes.
BROADCAST_ROWS = 1_000_000
# Most ways over which the rows of a hot block that no bound splits are dealt.
MOST_WAYS = 64
# Marks "not split on this dimension"; real cells are small integers.
WHOLE = -(2**31)


def cleaned_key(name: str) -> Column:
    """Block field as a searching listing sees it: text stripped, blank counts as missing."""
    return blank_to_null(F.col(name)) if name in BLOCK_TEXT_FIELDS else stored_key(name)


def stored_key(name: str) -> Column:
    """Block field as stored; adding 0.0 folds the negative zero."""
    return F.col(name) + F.lit(0.0) if name in DOUBLE_FIELDS else F.col(name)


def clean_keys(listings: DataFrame) -> DataFrame:
    return listings.withColumns({name: cleaned_key(name) for name in BLOCK_FIELDS})


def block_key(values: list[Column]) -> Column:
    """All block fields as one text; equal texts mean every field is equal or missing on both sides.

    Each value is written with its length in front and a missing one as a dash, so no two different
    lists of values share a text. One key compares and shuffles cheaper than 24 null-safe ones.
    """

    def part(value: Column) -> Column:
        written = value.cast("string")
        return F.coalesce(F.concat(F.length(written).cast("string"), F.lit(":"), written), F.lit("-"))

    return F.concat(*[part(value) for value in values])


def block_digest(values: list[Column]) -> Column:
    """SHA-256 of :func:`block_key`: 32 bytes stand for all block fields wherever rows are shuffled or copied."""
    # never null, and declared so: otherwise joins on it copy the whole expression into filters
    return F.coalesce(F.unhex(F.sha2(block_key(values), 256)), F.lit("").cast("binary"))


def candidate_side(candidates: DataFrame) -> DataFrame:
    """Columns the join needs of the searching listings; every other column is pruned."""
    return (
        candidates.where(F.col("offer_start").isNotNull())
        .select(
            F.col("doc_id").alias("c_id"),
            F.col("offer_start").alias("c_start"),
            F.col("initial_price").cast("double").alias("c_price"),
            F.col("mileage").cast("double").alias("c_mileage"),
            block_digest([cleaned_key(name) for name in BLOCK_FIELDS]).alias("c_fields"),
        )
        .withColumn("c_block", F.xxhash64("c_fields"))
    )


def document_side(listings: DataFrame) -> DataFrame:
    """Listings that can be claimed: ended, started, and without a successor."""
    claimable = (
        F.col("successor_id").isNull() & F.col("offer_end").isNotNull() & F.col("offer_start").isNotNull()
    )
    return (
        listings.where(claimable)
        .select(
            F.col("doc_id").alias("d_id"),
            F.col("offer_start").alias("d_start"),
            F.col("offer_end").alias("d_end"),
            F.col("latest_price").cast("double").alias("d_price"),
            F.col("mileage").cast("double").alias("d_mileage"),
            block_digest([stored_key(name) for name in BLOCK_FIELDS]).alias("d_fields"),
        )
        .withColumn("d_block", F.xxhash64("d_fields"))
    )


def temporal_band(rules: MatchRules) -> Column:
    start = F.col("c_start")
    low, high = plus_days(start, -rules.time_window_days), plus_days(start, rules.parser_lag_days)
    return F.col("d_end").between(low, high) & (F.col("d_start") < start)


def with_bounds(candidates: DataFrame, rules: MatchRules) -> DataFrame:
    """Bounds of each candidate, computed once per row; null means unbounded."""
    bounds = {
        "c_end_low": plus_days(F.col("c_start"), -rules.time_window_days),
        "c_end_high": plus_days(F.col("c_start"), rules.parser_lag_days),
    }
    for name, tolerance in (("price", rules.price_tolerance), ("mileage", rules.mileage_tolerance)):
        low, high = scoring.relative_bounds(F.col(f"c_{name}"), tolerance)
        usable = (low <= high) if tolerance >= 0 else F.lit(False)
        bounds[f"c_{name}_low"] = F.when(usable, low)
        bounds[f"c_{name}_high"] = F.when(usable, high)
    return candidates.withColumns(bounds)


def _close(name: str, tolerance: float) -> Column:
    """As :func:`scoring.within_relative`, pair by pair: bounds are rounded, which is dear, only where that can matter.

    So copies of candidates need not carry their bounds.
    """
    if tolerance < 0:
        return F.lit(True)
    value, target = F.col(f"d_{name}"), F.col(f"c_{name}")
    # rounding moves a bound by less than the 2e-6 and the 1e-12 of it that lie between surely inside and surely outside
    away = F.abs(value - target)
    finite = F.abs(target) < 1e300
    outside = (target > 0) & finite & F.coalesce(away > target * (tolerance + 1e-12) + 2e-6, F.lit(True))
    inside = (away < target * (tolerance - 1e-12) - 2e-6) | ((target * tolerance < -1e-5) & finite)
    return ~F.coalesce(outside, F.lit(False)) & (inside | scoring.within_relative(value, target, tolerance))


def _in_bounds(rules: MatchRules) -> Column:
    after = F.col("d_end_at") - F.col("c_start_at")
    day = 86_400_000_000
    return (
        after.between(-rules.time_window_days * day, rules.parser_lag_days * day)
        & (F.col("d_start") < F.col("c_start"))
        & _close("price", rules.price_tolerance)
        & _close("mileage", rules.mileage_tolerance)
    )


def _cell(value: Column, tolerance: float) -> Column:
    # floor(ln(x) / width) never decreases in x, so the cells of two bounds enclose those of all values between
    width = F.lit(max(tolerance, 0.001) * 2)
    return F.floor(F.ln(value) / width).cast("int")


def _document_cells(hot: Column, value: Column, tolerance: float) -> Column:
    split = hot & (value > F.lit(0.0))
    return F.when(split, F.array(_cell(value, tolerance), F.lit(WHOLE))).otherwise(F.array(F.lit(WHOLE)))


def _candidate_cells(hot: Column, name: str, tolerance: float) -> Column:
    low, high = F.col(f"c_{name}_low"), F.col(f"c_{name}_high")
    split = hot & (low > F.lit(0.0))
    return F.when(split, F.sequence(_cell(low, tolerance), _cell(high, tolerance))).otherwise(F.array(F.lit(WHOLE)))


def hot_blocks(documents: DataFrame, hot_rows: int = HOT_BLOCK_ROWS, candidates: DataFrame | None = None) -> DataFrame | None:
    """Hashes of blocks too large to be one join key and the ways their unsplit rows are dealt, or None when there are none.

    A block is hot by the rows of either side. Counted once up front, since the usual answer saves both
    sides a join. There are at most rows / hot_rows of them; the list is broadcast only up to a checked size.
    """
    sides = [documents.select(F.col("d_block").alias("hot_block"))]
    if candidates is not None:
        sides.append(candidates.select(F.col("c_block").alias("hot_block")))
    sizes = [side.groupBy("hot_block").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > hot_rows) for side in sides]
    larger = reduce(DataFrame.unionByName, sizes).groupBy("hot_block").agg(F.max("rows").alias("rows"))
    # each way is a copy of the block's unsplit listings, so only blocks too large for one task are dealt
    ways = F.least(F.ceil(F.col("rows") / F.lit(max(hot_rows, HOT_BLOCK_ROWS))), F.lit(MOST_WAYS)).cast("int")
    hot = cut_lineage(larger.select("hot_block", ways.alias("ways")))
    found = hot.count()
    if not found:
        return None
    return F.broadcast(hot) if found <= BROADCAST_ROWS else hot


def _dealt(df: DataFrame, prefix: str, every: bool) -> DataFrame:
    """Spread the rows of hot blocks that no bound splits over the block's ways.

    Searching rows take one way each by hash; listings are there in every way, as an unsplit searching
    row may claim any of them. All other rows go way 0.
    """
    whole = (F.col(f"{prefix}_cell_price") == WHOLE) & (F.col(f"{prefix}_cell_mileage") == WHOLE) & (F.col("ways") > 1)
    if every:
        ways = F.when(whole, F.sequence(F.lit(0), F.col("ways") - 1)).otherwise(F.array(F.lit(0)))
        return df.withColumn(f"{prefix}_way", F.explode(ways)).drop("ways")
    way = F.when(whole, F.pmod(F.xxhash64(f"{prefix}_id"), F.col("ways")).cast("int")).otherwise(F.lit(0))
    return df.withColumn(f"{prefix}_way", way).drop("ways")


def _add_cells(df: DataFrame, prefix: str, cells: dict[str, Column]) -> DataFrame:
    """One row per combination of cells; every listed dimension becomes a join key."""
    grid = F.transform(cells["day"], lambda day: F.struct(day.alias("day")))
    for name in ("price", "mileage"):
        if name in cells:
            grid = F.flatten(_extended(grid, name, cells[name]))
    return (
        df.withColumn("cell", F.explode(grid))
        .withColumns({f"{prefix}_cell_{name}": F.col(f"cell.{name}") for name in cells})
        .drop("cell", "hot_block")
    )


def _extended(grid: Column, name: str, values: Column) -> Column:
    return F.transform(
        grid, lambda cell: F.transform(values, lambda value: cell.withField(name, value))
    )


def pair_listings(
    candidates: DataFrame,
    documents: DataFrame,
    rules: MatchRules,
    hot: DataFrame | None = None,
    min_score: float | None = None,
) -> DataFrame:
    """Join of :func:`candidate_side` and :func:`document_side` on block, time, price and mileage.

    The time band becomes an equi key: an earlier listing lies in one bucket of its end date, a
    candidate looks into the two buckets its band can touch. Rows of hot blocks carry price and
    mileage cells as well; a candidate without a usable bound looks into the unsplit copy.

    ``min_score`` belongs to the join condition, behind the cheap bounds: as a filter on top it would
    be pushed in front of them and the score computed for every compared pair.
    """
    width = max(rules.time_window_days + rules.parser_lag_days, 1)

    def bucket(value: Column) -> Column:
        return F.floor(epoch_day(value) / F.lit(width)).cast("int")

    candidates = with_bounds(candidates, rules)
    left_cells = {"day": F.sequence(bucket(F.col("c_end_low")), bucket(F.col("c_end_high")))}
    right_cells = {"day": F.array(bucket(F.col("d_end")))}
    if hot is not None:
        candidates = candidates.join(hot, F.col("c_block") == F.col("hot_block"), "left")
        documents = documents.join(hot, F.col("d_block") == F.col("hot_block"), "left")
        is_hot = F.col("hot_block").isNotNull()
        for name, tolerance in (("price", rules.price_tolerance), ("mileage", rules.mileage_tolerance)):
            left_cells[name] = _candidate_cells(is_hot, name, tolerance)
            right_cells[name] = _document_cells(is_hot, F.col(f"d_{name}"), tolerance)
    left, right = _add_cells(candidates, "c", left_cells), _add_cells(documents, "d", right_cells)
    # every copy is shuffled: they go without the bounds and with half of the digest, 128 bits, as the only key of the block
    left = left.withColumns({"c_start_at": epoch_micros(F.col("c_start")), "c_key": F.substring("c_fields", 1, 16)})
    left = left.drop("c_block", "c_fields", *(f"c_{name}_{bound}" for name in ("end", "price", "mileage") for bound in ("low", "high")))
    right = right.withColumns({"d_end_at": epoch_micros(F.col("d_end")), "d_key": F.substring("d_fields", 1, 16)}).drop("d_block", "d_fields")
    same_cells = [F.col(f"c_cell_{name}") == F.col(f"d_cell_{name}") for name in left_cells]
    if hot is not None:
        left, right = _dealt(left, "c", every=False), _dealt(right, "d", every=True)
        same_cells.append(F.col("c_way") == F.col("d_way"))
    condition = (
        (F.col("c_key") == F.col("d_key"))
        & reduce(and_, same_cells)
        & _in_bounds(rules)
        & (F.col("c_id") != F.col("d_id"))
    )
    if min_score is not None:
        condition = condition & (pair_parts(rules)["score"] >= F.lit(min_score))
    return left.join(right, condition, "inner")


def pair_parts(rules: MatchRules) -> dict[str, Column]:
    return scoring.score_parts(
        F.col("c_start"), F.col("c_price"), F.col("c_mileage"), F.col("d_end"), F.col("d_price"), F.col("d_mileage"), rules
    )


def score_pairs(pairs: DataFrame, rules: MatchRules) -> DataFrame:
    return pairs.withColumns(pair_parts(rules))


def candidate_pairs(
    candidates: DataFrame, listings: DataFrame, rules: MatchRules = MatchRules(), hot_rows: int = HOT_BLOCK_ROWS, min_score: float | None = None
) -> DataFrame:
    """All (candidate, earlier listing) pairs the rules allow, or those of at least ``min_score``."""
    documents, searching = document_side(listings), candidate_side(candidates)
    hot = hot_blocks(documents, hot_rows, searching)
    return pair_listings(searching, documents, rules, hot, min_score).select(
        "c_id", "d_id", "c_start", "c_price", "c_mileage", "d_start", "d_end", "d_price", "d_mileage"
    )


def _minute(value: Column) -> Column:
    return F.floor(epoch_micros(value) / F.lit(60_000_000)).cast("bigint")


def _span_starts(searching: DataFrame, span_rows: int) -> DataFrame:
    """First minute of each span of each block, ascending: (fields, starts). A minute is never cut."""
    so_far = Window.partitionBy("fields").orderBy("minute").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        searching.groupBy("fields", _minute(F.col("c_start")).alias("minute"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("span", F.floor((F.sum("rows").over(so_far) - 1) / F.lit(span_rows)))
        .groupBy("fields", "span")
        .agg(F.min("minute").alias("start"), F.sum("rows").alias("rows"))
        .groupBy("fields")
        .agg(F.sort_array(F.collect_list("start")).alias("starts"), F.sum("rows").alias("block_rows"))
    )


def _span_of(minute: Column) -> Column:
    """Number of the last span that begins by ``minute``: looked for among every ``STEP``-th start, then among those up to the next."""
    step = F.greatest(F.size(F.filter(F.filter("starts", lambda _, n: n % STEP == 0), lambda start: start <= minute)) - 1, F.lit(0)) * STEP
    return step + F.size(F.filter(F.slice("starts", step + 1, F.lit(STEP)), lambda start: start <= minute)) - 1


def _bin(bins: int) -> Column:
    """Blocks of one span share bins, so that a great many small ones are no groups of their own."""
    block = F.xxhash64("fields")
    return F.when(F.size("starts") > 1, block).otherwise(F.pmod(block, F.lit(bins)))


def span_sides(candidates: DataFrame, listings: DataFrame, rules: MatchRules, span_rows: int, bin_rows: int) -> tuple[DataFrame, DataFrame]:
    """Searching rows with their ``span`` and listings with the ``first`` and ``last`` span they are in reach of, by ``bin``.

    Each block is cut along time into spans of about ``span_rows`` searching rows. Rows without id are left out.
    """
    # read and digested once; later joins on the digest do not carry its expression
    searching = with_bounds(cut_lineage(candidate_side(candidates).where(F.col("c_id").isNotNull()).drop("c_block")), rules)
    searching = searching.withColumnRenamed("c_fields", "fields")
    documents = cut_lineage(document_side(listings).where(F.col("d_id").isNotNull()).drop("d_block"))
    starts = cut_lineage(_span_starts(searching, span_rows))
    bins = starts.agg(F.ceil(F.sum("block_rows") / F.lit(bin_rows))).first()[0] or 1
    asking = searching.join(starts, "fields").select(
        _bin(bins).alias("bin"),
        _span_of(_minute(F.col("c_start"))).alias("span"),
        "fields",
        "c_id",
        *[epoch_micros(F.col(name)).alias(name) for name in ("c_start", "c_end_low", "c_end_high")],
        *[f"c_{name}{bound}" for name in ("price", "mileage") for bound in ("", "_low", "_high")],
    )
    # the starts of searching listings that a listing is in reach of
    low = F.greatest(_minute(F.col("d_start")), _minute(plus_days(F.col("d_end"), -rules.parser_lag_days)))
    high = _minute(plus_days(F.col("d_end"), rules.time_window_days))
    offered = (
        documents.withColumnRenamed("d_fields", "fields")
        .join(starts, "fields")
        .select(
            _bin(bins).alias("bin"),
            F.greatest(_span_of(low), F.lit(0)).alias("first"),
            _span_of(high).alias("last"),
            "fields",
            "d_id",
            *[epoch_micros(F.col(name)).alias(name) for name in ("d_start", "d_end")],
            "d_price",
            "d_mileage",
        )
        .where(F.col("first") <= F.col("last"))
    )
    return asking, offered


def walk_spans(asking: DataFrame, offered: DataFrame, run: Callable[[tuple, pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``run`` over the searching rows and the listings of every span."""
    spark = asking.sparkSession
    parts = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    sides = [side.repartition(parts, "bin", "span").groupBy("bin", "span") for side in (asking, offered)]
    return sides[0].cogroup(sides[1]).applyInArrow(run, schema)


BEST = "c_id string, d_id string, score double, c_start timestamp_ntz, d_start timestamp_ntz"


def _best_of(rules: MatchRules, min_score: float | None) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    def run(key: tuple[pa.Scalar, ...], searching: pa.Table, offered: pa.Table) -> pa.Table:
        found = walk(searching, offered, rules, 0.0 if min_score is None else min_score, take=False)
        types = (pa.string(), pa.string(), pa.float64(), pa.timestamp("us"), pa.timestamp("us"))
        columns = list(zip(*found, strict=True))[1:] if found else [()] * 5
        return pa.table([pa.array(column, kind) for column, kind in zip(columns, types, strict=True)], names=["c_id", "d_id", "score", "c_start", "d_start"])

    return run


def best_duplicate(
    candidates: DataFrame,
    listings: DataFrame,
    rules: MatchRules = MatchRules(),
    hot_rows: int = HOT_BLOCK_ROWS,
    min_score: float | None = None,
) -> DataFrame:
    """Best-scored earlier listing per candidate among all of its pairs; the smallest id wins a tie.

    ``min_score`` leaves weaker pairs out: candidates whose best is below it have no row. Every candidate looks among the
    listings close in price first, and farther only as long as one there could be better; no pair is written.
    """
    asking, offered = span_sides(candidates, listings, rules, BUCKET_WISHES * LIST_LENGTH, hot_rows)
    asking, offered = cut_lineage(asking), cut_lineage(offered)
    in_spans = offered.withColumn("span", F.explode(F.sequence("first", "last"))).drop("first", "last")
    found = walk_spans(asking, in_spans, _best_of(rules, min_score), BEST)
    best = F.min(F.struct((-F.col("score")).alias("loss"), "d_id", "score", "c_start", "d_start")).alias("best")
    return found.groupBy("c_id").agg(best).select("c_id", "best.d_id", "best.score", "best.c_start", "best.d_start")


def score_gate(best: DataFrame, rules: MatchRules = MatchRules()) -> DataFrame:
    """Best duplicates that may be claimed."""
    return best.where(
        (F.col("score") >= F.lit(rules.min_score))
        & (F.col("c_id") != F.col("d_id"))
        & F.col("d_start").isNotNull()
        & (F.col("d_start") < F.col("c_start"))
    )


def new_listings(listings: DataFrame, windows: DataFrame) -> DataFrame:
    """Unlinked listings inside their site's ``windows(site, lower_bound, upper_bound)``, both ends included."""
    # a row per site; joined by a shuffle, all listings of a site would be one task
    windows = F.broadcast(windows.select("site", "lower_bound", "upper_bound"))
    return (
        listings.where(F.col("predecessor_id").isNull())
        .join(windows, F.col("site_name") == F.col("site"))
        .where(F.col("offer_start").between(F.col("lower_bound"), F.col("upper_bound")))
        .drop("site", "lower_bound", "upper_bound")
    )


def backfill_slice(listings: DataFrame, site: str | None, start: Column, end: Column) -> DataFrame:
    """Listings of a site with ``offer_start`` in [start, end), linked or not."""
    inside = (F.col("offer_start") >= start) & (F.col("offer_start") < end)
    return listings.where(inside if site is None else inside & (F.col("site_name") == F.lit(site)))


def distinct_sites(listings: DataFrame) -> DataFrame:
    return (
        listings.select(blank_to_null(F.col("site_name")).alias("site"))
        .where(F.col("site").isNotNull())
        .distinct()
        .orderBy("site")
    )


def site_subset(sites: DataFrame, requested: list[str] | None) -> DataFrame:
    """Sites asked for (names stripped, blanks ignored); all of them when no request is made."""
    if requested is None:
        return sites
    wanted = sorted({name.strip() for name in requested if name.strip()})
    return sites.where(F.col("site").isin(wanted)) if wanted else sites.where(F.lit(False))
