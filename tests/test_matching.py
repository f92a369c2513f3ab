from __future__ import annotations

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from relist.functions.scoring import MatchRules
from relist.functions import walk as walking
from relist.functions.walk import rounded
from relist.operators import candidates as C
from relist.operators import resolver
from relist.operators.links import apply_links
from relist.operators.mapping import candidate_defaults
from relist.operators.validation import scenario_violations, validate_chains
import relist.plans.backfill as backfill_plan
from relist.plans.backfill import run_backfill
from relist.plans.matching import match_incremental
from relist.schemas import CURSOR_SCHEMA
from tests.builders import hours, listing, listings, rows_of

RULES = MatchRules()
START = datetime(2026, 1, 10, 10)


# --- plain model of the sequential rule -------------------------------------------------------


def close(value, target, tolerance):
    if target is None:
        return True
    low, high = round(target * (1 - tolerance), 6), round(target * (1 + tolerance), 6)
    return low > high or (value is not None and low <= value <= high)


def model_score(c, d, rules=RULES):
    earned = reachable = 0.0
    distance = abs((d["offer_end"] - c["offer_start"]).total_seconds())
    earned += round(max(0.0, 1 - distance / (rules.time_window_days * 86400)) * 3.0, 6)
    reachable += 3.0
    for a, t, tolerance, weight in (
        (d["latest_price"], c["initial_price"], rules.price_tolerance, 2.0),
        (d["mileage"], c["mileage"], rules.mileage_tolerance, 1.5),
    ):
        if a is not None and t is not None:
            earned += round(max(0.0, 1 - abs(a - t) / max(abs(t) * tolerance, 1.0)) * weight, 6)
            reachable += weight
    return round(min(max(earned / reachable, 0.0), 1.0), 6)


def clean(name, value):
    if name in C.BLOCK_TEXT_FIELDS and isinstance(value, str):
        return value.strip() or None
    return value


def model_pairs(rows):
    for c in rows:
        if c["offer_start"] is None:
            continue
        for d in rows:
            if d["doc_id"] == c["doc_id"] or d.get("successor_id") or d["offer_end"] is None or d["offer_start"] is None:
                continue
            if any(clean(k, c.get(k)) != d.get(k) for k in C.BLOCK_FIELDS):
                continue
            low, high = c["offer_start"] - timedelta(days=5), c["offer_start"] + timedelta(days=3)
            if not (low <= d["offer_end"] <= high and d["offer_start"] < c["offer_start"]):
                continue
            if close(d["latest_price"], c["initial_price"], 0.1) and close(d["mileage"], c["mileage"], 0.05):
                yield c, d


def model_links(rows, threshold):
    wishes = {}
    for c, d in model_pairs(rows):
        score = model_score(c, d)
        if score >= threshold:
            wishes.setdefault(c["doc_id"], []).append((-score, d["doc_id"]))
    taken, links = set(), set()
    for c in sorted(rows, key=lambda r: (r["offer_start"] or START, r["doc_id"])):
        pick = next((d for _, d in sorted(wishes.get(c["doc_id"], [])) if d not in taken), None)
        if pick is not None:
            taken.add(pick)
            links.add((c["doc_id"], pick))
    return links


def random_rows(seed, count):
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        start = START + timedelta(minutes=30 * rng.randrange(400))
        end = None if rng.random() < 0.1 else start + timedelta(hours=rng.randrange(72))
        price = rng.choice([None, 0.0, -5.0, 100.0, 101.0, 104.0, 109.0, 120.0])
        rows.append(
            listing(
                f"d{i}",
                start,
                end,
                # one block holds most rows
                brand=rng.choice(["A", "A", "A", "A", "B", " A ", None, ""]),
                engine_power=rng.choice([0.0, -0.0]),
                initial_price=price,
                latest_price=rng.choice([price, None, 102.0]),
                mileage=rng.choice([None, 1000, 1020, 1049, 1100]),
                successor_id="x" if rng.random() < 0.05 else None,
            )
        )
    return rows


@pytest.mark.parametrize("hot_rows", [10**9, 1])
def test_pairs_equal_brute_force(spark, hot_rows):
    rows = random_rows(1, 250)
    table = listings(spark, rows)
    want = {(c["doc_id"], d["doc_id"], model_score(c, d)) for c, d in model_pairs(rows)}
    got = C.score_pairs(C.candidate_pairs(table, table, RULES, hot_rows), RULES)
    assert len(want) > 300
    assert rows_of(got, "c_id", "d_id", "score") == want
    assert got.count() == len(want)


@pytest.mark.parametrize(
    ("seed", "bucket_wishes", "list_length", "hot_rows"), [(2, 50_000, 32, 10**9), (3, 40, 32, 10**9), (4, 60, 2, 20)]
)
def test_links_equal_the_sequential_rule(spark, seed, bucket_wishes, list_length, hot_rows):
    rows = random_rows(seed, 200)
    table = listings(spark, rows)
    got = resolver.resolve_links(table, table, MatchRules(min_score=0.5), bucket_wishes, list_length, hot_rows)
    want = model_links(rows, 0.5)
    assert len(want) > 30
    assert rows_of(got, "candidate_id", "duplicate_id") == want


def test_one_block_in_one_hour_is_spread(spark):
    rows = [listing(f"old{i:03}", START - hours(50), START - hours(2) + timedelta(seconds=i)) for i in range(25)]
    rows += [listing(f"new{i:03}", START + timedelta(seconds=i), None) for i in range(40)]
    table = listings(spark, rows)
    asked = table.where(F.col("doc_id").startswith("new"))
    got = resolver.resolve_links(asked, table, RULES, bucket_wishes=8, list_length=4)
    assert rows_of(got, "candidate_id", "duplicate_id") == {
        (c, d) for c, d in model_links(rows, 0.7) if c.startswith("new")
    }
    assert got.count() == 25


def test_block_key_separates_what_concatenation_would_join(spark):
    frame = spark.createDataFrame([("a", "b"), ("ab", ""), ("ab", None), (None, "ab"), ("1:a", "b")], "x string, y string")
    keys = [r[0] for r in frame.select(C.block_key([F.col("x"), F.col("y")])).collect()]
    assert len(set(keys)) == 5


# --- scores and bounds -------------------------------------------------------------------------


def score_of(spark, candidate, *documents):
    table = listings(spark, [candidate, *documents])
    asked = table.where(F.col("doc_id") == candidate["doc_id"])
    return {r["c_id"]: (r["d_id"], r["score"]) for r in C.best_duplicate(asked, table, RULES).collect()}


def test_scores_of_known_cases(spark):
    day = START - timedelta(days=1)
    asked = listing("new", START)
    weaker = listing("weaker", START - timedelta(days=9), day, latest_price=8_400.0, mileage=41_200)
    best = listing("best", START - timedelta(days=9), START - timedelta(days=2), latest_price=8_160.0, mileage=39_200)
    assert score_of(spark, asked, weaker, best) == {"new": ("best", 0.661538)}
    no_mileage = listing("old", START - timedelta(days=9), day, mileage=None)
    assert score_of(spark, asked | {"mileage": None}, no_mileage) == {"new": ("old", 0.88)}
    bare = listing("old", START - timedelta(days=9), day, latest_price=None, mileage=None)
    endless = listing("endless", START - timedelta(days=9), None)
    assert score_of(spark, asked | {"initial_price": None, "mileage": None}, bare, endless) == {"new": ("old", 0.8)}


def test_bounds_are_inclusive(spark):
    def found(**change):
        document = listing("old", START - timedelta(days=9), START) | change
        return bool(score_of(spark, listing("new", START), document))

    assert found(latest_price=7_200.0) and found(latest_price=8_800.0) and not found(latest_price=7_199.0)
    assert found(mileage=38_000) and found(mileage=42_000) and not found(mileage=42_001) and not found(mileage=None)
    assert found(offer_end=START - timedelta(days=5)) and found(offer_end=START + timedelta(days=3))
    assert not found(offer_end=START + timedelta(days=3, seconds=1)) and not found(offer_start=START)
    assert not found(successor_id="taken") and not found(brand=None)


def test_blank_candidate_does_not_match_blank_document(spark):
    old = listing("old", START - timedelta(days=9), START, brand="")
    assert not score_of(spark, listing("new", START, brand=""), old)
    assert score_of(spark, listing("new", START, brand=" "), old | {"brand": None})


# --- four situations in one table: a chain, two rivals, an only one, and two that differ in their engine ---

BASE = datetime(2027, 2, 1, 6)


def scenario_rows():
    def row(name, start, price, mileage, ends=True, **block):
        return listing(
            name, start, start + hours(2) if ends else None, initial_price=float(price), latest_price=float(price), mileage=mileage, **block
        )

    boat, sled, cart = {"brand": "Boat"}, {"brand": "Sled", "model": "Two"}, {"brand": "Cart", "model": "Nine"}
    rows = [row(f"chain-{k}", BASE + timedelta(days=4 * k), 7000 - 30 * k, 31000 + 150 * k, **boat) for k in range(3)]
    rows += [
        row("rivals-old", BASE + timedelta(days=15), 5200, 44000, **sled),
        row("rivals-first", BASE + timedelta(days=19), 5150, 44200, ends=False, **sled),
        row("rivals-second", BASE + timedelta(days=19, minutes=5), 5160, 44100, ends=False, **sled),
        row("only-one", BASE + hours(3), 9900, 12000, brand="Raft"),
        row("engine-small", BASE + hours(5), 3100, 20000, engine_power=40.0, gear_box="lever", **cart),
        row("engine-large", BASE + hours(9), 3090, 20100, engine_power=55.0, gear_box="belt", **cart),
    ]
    return rows + [row(f"else-{k}", BASE + hours(11 + k), 1000 + 90 * k, 9000 + 700 * k, brand=f"E{k}") for k in range(7)]


EXPECTED = {
    "chain-0": (None, "chain-1"),
    "chain-1": ("chain-0", "chain-2"),
    "chain-2": ("chain-1", None),
    "rivals-old": (None, "rivals-first"),
    "rivals-first": ("rivals-old", None),
}


@pytest.mark.parametrize(("threshold", "linked"), [(0.5, True), (0.8, False)])
def test_scenario(spark, threshold, linked):
    rows = scenario_rows()
    table = listings(spark, rows)
    bounds = spark.createDataFrame([("site", BASE + timedelta(days=40))], CURSOR_SCHEMA)
    start = spark.createDataFrame([("site", BASE - timedelta(days=1))], CURSOR_SCHEMA)
    run = match_incremental(table, bounds, start, MatchRules(min_score=threshold))
    expected = spark.createDataFrame(
        [(r["doc_id"], *(EXPECTED.get(r["doc_id"], (None, None)) if linked else (None, None))) for r in rows],
        "doc_id string, predecessor_id string, successor_id string",
    )
    assert scenario_violations(run.listings, expected).collect() == []
    assert run.metrics.first()["linked"] == (3 if linked else 0)
    assert rows_of(run.markers, "site", "ts") == {("site", BASE + timedelta(days=19, minutes=5))}
    wrong = expected.where("doc_id <> 'else-1'").unionByName(spark.createDataFrame([("else-1", "nobody", None)], expected.schema))
    assert rows_of(scenario_violations(run.listings, wrong), "kind", "example") == {("unexpected_links", "else-1")}


def test_scenario_pairs(spark):
    table = listings(spark, scenario_rows())
    scored = C.score_pairs(C.candidate_pairs(table, table, RULES), RULES).collect()
    assert {(r["c_id"], r["d_id"]) for r in scored} == {
        ("chain-1", "chain-0"), ("chain-2", "chain-1"), ("rivals-first", "rivals-old"), ("rivals-second", "rivals-old"),
    }
    assert all(0.5 < r["score"] < 0.8 for r in scored)


# --- jobs --------------------------------------------------------------------------------------


def test_match_run_twice_changes_nothing(spark):
    rows = random_rows(5, 150)
    for row in rows:
        row["site_name"] = "one" if int(row["doc_id"][1:]) % 2 else "two"
        row["successor_id"] = None
    upload = START + timedelta(days=30)
    uploads = spark.createDataFrame([("one", upload), ("two", upload), ("three", upload)], CURSOR_SCHEMA)
    markers = spark.createDataFrame([("one", START - timedelta(days=1)), ("three", upload)], CURSOR_SCHEMA)
    rules = MatchRules(min_score=0.5)
    first = match_incremental(listings(spark, rows), uploads, markers, rules)
    linked = rows_of(first.listings, "doc_id", "predecessor_id", "successor_id")
    # 'two' had no marker: it only gets one
    assert {r["status"] for r in first.windows.collect()} == {"run", "init", "skip_caught_up"}
    assert all(pred is None and succ is None for d, pred, succ in linked if int(d[1:]) % 2 == 0)
    assert any(pred for _, pred, _ in linked)
    again = match_incremental(first.listings, uploads, markers, rules)
    assert rows_of(again.listings, "doc_id", "predecessor_id", "successor_id") == linked
    assert validate_chains(first.listings).count() == 0


def test_backfill_by_month_equals_one_pass(spark):
    rng = random.Random(9)
    rows = []
    for i in range(200):
        start = datetime(2024, 8, 1) + timedelta(hours=rng.randrange(24 * 100))
        rows.append(listing(f"d{i}", start, start + timedelta(hours=rng.randrange(72)), brand=rng.choice("AB")))
        rows[-1]["predecessor_id"] = "stale" if i % 11 == 0 else None
    table = listings(spark, rows)
    progress = spark.createDataFrame([], "site string, next_from timestamp_ntz, reset_completed boolean, updated_at timestamp_ntz")
    now = F.lit(datetime(2024, 11, 5)).cast("timestamp_ntz")
    whole = run_backfill(table, progress, now, RULES)
    monthly = run_backfill(table, progress, now, RULES, by_month=True)
    links = rows_of(whole.listings, "doc_id", "predecessor_id", "successor_id")
    assert links == rows_of(monthly.listings, "doc_id", "predecessor_id", "successor_id")
    assert rows_of(whole.links, "candidate_id", "duplicate_id") == rows_of(monthly.links, "candidate_id", "duplicate_id")
    assert sum(1 for _, pred, _ in links if pred) > 20 and not any(pred == "stale" for _, pred, _ in links)
    # nothing from the running month on is linked, and progress stands at its start
    late = {r["doc_id"] for r in rows if r["offer_start"] >= datetime(2024, 11, 1)}
    assert late and not any(pred for d, pred, _ in links if d in late)
    assert rows_of(whole.progress, "site", "next_from", "reset_completed") == {("site", datetime(2024, 11, 1), True)}
    # a finished backfill has nothing left to do
    resumed = run_backfill(whole.listings, whole.progress, now, RULES)
    assert rows_of(resumed.listings, "doc_id", "predecessor_id", "successor_id") == links


def test_backfill_goes_on_after_the_last_finished_month(spark, tmp_path, monkeypatch):
    rng = random.Random(10)
    rows = []
    for i in range(150):
        start = datetime(2024, 8, 1) + timedelta(hours=rng.randrange(24 * 90))
        rows.append(listing(f"d{i}", start, start + timedelta(hours=rng.randrange(72)), brand=rng.choice("AB")))
    table = listings(spark, rows)
    progress = spark.createDataFrame([], "site string, next_from timestamp_ntz, reset_completed boolean, updated_at timestamp_ntz")
    now = F.lit(datetime(2024, 11, 5)).cast("timestamp_ntz")
    whole = rows_of(run_backfill(table, progress, now, RULES).listings, "doc_id", "predecessor_id", "successor_id")
    asked = []
    real = backfill_plan._month_links

    def stopping(listings, candidates, rules, earlier, start, end):
        asked.append(start.month)
        if len(asked) == 4:
            raise RuntimeError("lost")
        return real(listings, candidates, rules, earlier, start, end)

    monkeypatch.setattr(backfill_plan, "_month_links", stopping)
    with pytest.raises(RuntimeError, match="lost"):
        run_backfill(table, progress, now, RULES, by_month=True, out=str(tmp_path))
    (tmp_path / "links" / "version=202410").mkdir()  # of a month whose write did not finish
    again = run_backfill(table, progress, now, RULES, by_month=True, out=str(tmp_path))
    assert asked == [7, 8, 9, 10, 10]
    assert rows_of(again.listings, "doc_id", "predecessor_id", "successor_id") == whole


def test_apply_links_respects_claims(spark):
    table = listings(spark, [listing("a", START, successor_id="z"), listing("b", START), listing("c", START, predecessor_id="old")])
    links = spark.createDataFrame([("c", "a"), ("a", "b")], "candidate_id string, duplicate_id string")
    out = rows_of(apply_links(table, links), "doc_id", "predecessor_id", "successor_id")
    assert out == {("a", "b", "z"), ("b", None, "a"), ("c", "a", None)}


def test_defaults_do_not_hide_missing_start(spark):
    table = listings(spark, [listing("a", None, None)])
    asked = candidate_defaults(table, F.lit(START).cast("timestamp_ntz"))
    assert asked.first()["offer_start"] == START


def test_rows_of_pairs_carry_digests_not_texts(spark):
    table = listings(spark, [listing("a", START, brand="B" * 300), listing("b", START, brand="B" * 300), listing("c", START, brand="B")])
    keys = {r["c_id"]: bytes(r["c_fields"]) for r in C.candidate_side(table).collect()}
    assert {len(key) for key in keys.values()} == {32}
    assert keys["a"] == keys["b"] != keys["c"]


def test_copies_of_candidates_carry_neither_bounds_nor_whole_digests(spark):
    table = listings(spark, random_rows(11, 40))
    pairs = C.pair_listings(C.candidate_side(table), C.document_side(table), RULES)
    assert not {"c_fields", "d_fields", "c_block", "d_block", "c_price_low", "c_mileage_high", "c_end_low"} & set(pairs.columns)


@pytest.mark.parametrize("tolerance", [0.1, 0.05, 0.0, 1e-7, -1.0])
def test_closeness_of_pairs_equals_rounded_bounds(spark, tolerance):
    targets = [None, 0.0, -0.0, 1e-7, 1.0, -5.0, -1e-6, 100.0, 123.456789, 1e12, -1e12, float("inf"), float("-inf"), float("nan")]
    known = [t for t in targets if t is not None]
    edges = [round(t * (1 + sign * max(tolerance, 0.0)), 6) + step for t in known if abs(t) < 1e13 for sign in (1, -1) for step in (0.0, 1e-6, -1e-6, 4e-6, -4e-6)]
    frame = spark.createDataFrame([(t, v) for t in targets for v in [*targets, *edges]], "c_price double, d_price double")
    found = frame.select("*", F.coalesce(C._close("price", tolerance), F.lit(False)).alias("got"), C.scoring.within_relative(F.col("d_price"), F.col("c_price"), tolerance).alias("want"))
    wrong = found.where(~F.col("got").eqNullSafe(F.col("want"))).collect()
    assert wrong == [] and (tolerance < 0 or found.where("not want").count() > 50)


def test_small_hot_blocks_are_not_dealt(spark):
    rows = [listing(f"d{i}", START, START + hours(1)) for i in range(40)]
    hot = C.hot_blocks(C.document_side(listings(spark, rows)), 1)
    assert [r["ways"] for r in hot.collect()] == [1]


# --- spans of a block -------------------------------------------------------------------------


def test_many_spans_equal_the_sequential_rule_without_a_join(spark, monkeypatch):
    rows = random_rows(6, 120)
    table = listings(spark, rows)
    monkeypatch.setattr(C, "pair_listings", None)
    got = resolver.resolve_links(table, table, MatchRules(min_score=0.5), bucket_wishes=5, list_length=6, hot_rows=20)
    want = model_links(rows, 0.5)
    assert len(want) > 15
    assert rows_of(got, "candidate_id", "duplicate_id") == want
    assert not hasattr(resolver, "pair_listings")


def test_repeated_rows_take_once(spark):
    rows = random_rows(7, 60)
    table = listings(spark, rows + rows)
    got = resolver.resolve_links(table, table, MatchRules(min_score=0.5))
    assert rows_of(got, "candidate_id", "duplicate_id") == model_links(rows, 0.5)
    assert got.count() == len(model_links(rows, 0.5))


def test_small_spans_grow_together(spark, monkeypatch):
    """Every span wants what the one before has taken: with spans of two candidates all along, a round would settle one of 20."""
    rows = [listing(f"old{i:03}", START - hours(50), START - hours(2)) for i in range(40)]
    rows += [listing(f"new{i:03}", START + timedelta(minutes=i), None) for i in range(40)]
    table = listings(spark, rows)
    rounds = []

    def counted(*given):
        rounds.append(1)
        return C.walk_spans(*given)

    monkeypatch.setattr(resolver, "walk_spans", counted)
    asked = table.where(F.col("doc_id").startswith("new"))
    got = resolver.resolve_links(asked, table, RULES, bucket_wishes=2, list_length=1)
    assert rows_of(got, "candidate_id", "duplicate_id") == {(c, d) for c, d in model_links(rows, 0.7) if c.startswith("new")}
    assert got.count() == 40
    assert len(rounds) <= 5


def test_span_of_a_minute_in_steps(spark):
    starts = [3 * n for n in range(100)]
    frame = spark.createDataFrame([(starts[:most], m) for most in (1, 32, 33, 64, 100) for m in (-1, 0, 2, 3, 95, 96, 97, 191, 192, 400)], "starts array<bigint>, minute bigint")
    for row in frame.select("*", C._span_of(F.col("minute")).alias("span")).collect():
        assert row["span"] == sum(start <= row["minute"] for start in row["starts"]) - 1


@pytest.mark.parametrize(("stride", "noted", "run_out", "enough", "pairs"), [(256, 32, 16, 8, 200_000), (16, 2, 2, 1, 50), (64, 3, 1, 2, 1000)])
def test_walk_together_equals_one_by_one(spark, monkeypatch, stride, noted, run_out, enough, pairs):
    """Candidates that want the same listings, looked at together; some of them run out of those noted."""
    rng = random.Random(9)
    rows = []
    for i in range(300):
        start = START + timedelta(minutes=rng.randrange(6000))
        price = rng.choice([None, 100.0, 100.0, 1000.0 + rng.randrange(150)])
        rows.append(listing(f"d{i:03}", start, start + hours(rng.randrange(1, 60)) if rng.random() < 0.9 else None, initial_price=price, latest_price=price, mileage=rng.choice([None, 1000, 1010])))
    table = listings(spark, rows)
    asking, offered = C.span_sides(table, table, RULES, 10**6, 10**6)
    for name, value in (("STRIDE", stride), ("NOTED", noted), ("RUN_OUT", run_out), ("ENOUGH", enough), ("PAIRS", pairs)):
        monkeypatch.setattr(walking, name, value)
    sides = asking.toArrow(), offered.toArrow()
    links = {(c, d) for _, c, d, *_ in walking.walk(*sides, RULES, RULES.min_score, take=True)}
    assert len(links) > 100 and links == model_links(rows, RULES.min_score)
    want = {}
    for c, d in model_pairs(rows):
        want[c["doc_id"]] = min(want.get(c["doc_id"], (0.0, "~")), (-model_score(c, d), d["doc_id"]))
    assert {(c, d, -score) for _, c, d, score, *_ in walking.walk(*sides, RULES, 0.0, take=False)} == {(c, d, loss) for c, (loss, d) in want.items()}


def test_walk_rounds_and_scores_as_spark_does(spark):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.random(500) * 3, (np.arange(300) * 2 + 1) / 2e6, [0.0, 0.5, 1.0, 2.0000005, 0.6999995]])
    frame = spark.createDataFrame([(float(v),) for v in values], "x double").select("x", F.round("x", 6).alias("r")).collect()
    assert [r["r"] for r in frame] == list(rounded(np.array([r["x"] for r in frame])))


def test_best_equals_brute_force_without_a_join(spark, monkeypatch):
    rows = random_rows(8, 200)
    table = listings(spark, rows)
    monkeypatch.setattr(C, "pair_listings", None)
    want = {}
    for c, d in model_pairs(rows):
        want[c["doc_id"]] = min(want.get(c["doc_id"], (0.0, "~")), (-model_score(c, d), d["doc_id"]))
    got = rows_of(C.best_duplicate(table, table, RULES), "c_id", "d_id", "score")
    assert len(want) > 100
    assert got == {(c, d, -loss) for c, (loss, d) in want.items()}


def test_listings_of_one_site_are_no_single_task(spark, monkeypatch):
    rows = [listing(f"d{i}", datetime(2024, 8, 1) + hours(i), datetime(2024, 8, 2) + hours(i)) for i in range(200)]
    table = listings(spark, rows).repartition(8)
    seen = []

    def watched(candidates, documents, rules):
        seen.extend(side.select(F.spark_partition_id()).distinct().count() for side in (candidates, documents))
        return resolver.resolve_links(candidates, documents, rules)

    monkeypatch.setattr(backfill_plan, "resolve_links", watched)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        windows = spark.createDataFrame([("site", datetime(2024, 8, 1), datetime(2024, 9, 1))], "site string, lower_bound timestamp_ntz, upper_bound timestamp_ntz")
        window = C.new_listings(table, windows)
        assert window.count() == 200 and window.select(F.spark_partition_id()).distinct().count() > 1
        progress = spark.createDataFrame([], "site string, next_from timestamp_ntz, reset_completed boolean, updated_at timestamp_ntz")
        run_backfill(table, progress, F.lit(datetime(2024, 11, 5)).cast("timestamp_ntz"), RULES, validate=False)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(seen) == 2 and min(seen) > 1
