"""Near-duplicate documents: fast similarity sketches, banding, exact verification.

A document's set holds the hashes of its distinct word shingles. The sketch places the elements
into ``coordinates`` bins in rounds: round r hashes every element to a bin and a value; a bin keeps
the smallest value of the first round that reached it. Rounds up to ``coordinates`` choose the bin by
hash, later ones fill bin after bin with the whole set, so after twice as many rounds at most every
coordinate is filled; for a set much larger than the sketch the first round does nearly all the work.
Two coordinates agree with the probability of the Jaccard similarity, concentrated like sampling.

Sets that are equal are folded into one node before anything is compared. Bands of the sketch are
the buckets; ``grouping.linked_groups`` compares and joins them, each link confirmed on full sets.

A pair at similarity 0.85 escapes all 24 bands of 4 coordinates with a probability of about 2e-8.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relist.llm.grouping import linked_groups, shared_keys
from relist.llm.hashing import Words, digest, mix, shingles, signed
from relist.llm.runtime import bounded, column, cut_lineage, map_rows, split_evenly, stored, texts


@dataclass(frozen=True)
class NearDedup:
    """words: shingle width; percent: least Jaccard similarity of a link, in percent."""

    words: int = 5
    percent: int = 80
    bands: int = 32
    band_rows: int = 4


def sketch(elements: np.ndarray, coordinates: int) -> np.ndarray:
    """The filled coordinates of a non-empty set: round in the high, hashed value in the low 32 bits."""
    filled = np.full(coordinates, np.iinfo(np.uint64).max, np.uint64)
    done, step = 0, max(1, -(-2 * coordinates // max(1, len(elements))))
    while done < 2 * coordinates:
        rounds = np.arange(done, min(done + step, 2 * coordinates), dtype=np.uint64)[:, None]
        hashed = mix(elements[None, :] + mix(rounds + np.uint64(1)))
        bins = ((hashed >> np.uint64(32)) * np.uint64(coordinates)) >> np.uint64(32)
        bins = np.where(rounds < coordinates, bins, rounds - np.minimum(rounds, np.uint64(coordinates)))
        np.minimum.at(filled, bins.ravel().astype(np.int64), ((rounds << np.uint64(32)) | (hashed & np.uint64(0xFFFFFFFF))).ravel())
        if filled.max() != np.iinfo(np.uint64).max:
            break
        done += step
    return filled


def band_keys(filled: np.ndarray, bands: int) -> np.ndarray:
    parts = filled.reshape(bands, -1)
    key = np.arange(bands, dtype=np.uint64)
    for k in range(parts.shape[1]):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, k])
    return key


def shingle_set(text: str, words: int) -> np.ndarray:
    return shingles(Words(text.encode("utf-8", "surrogatepass").lower()).hash, words)


def sketches(docs: DataFrame, plan: NearDedup) -> DataFrame:
    """(doc_id, n_shingles, low, high, bands): set size, set digest and band keys (none for an empty set)."""

    def run(batch: pa.RecordBatch) -> dict[str, object]:
        sizes, lows, highs, keys = [], [], [], []
        for text in texts(batch):
            elements = shingle_set(text, plan.words)
            low, high = digest(elements)
            sizes.append(len(elements))
            lows.append(low)
            highs.append(high)
            keys.append(signed(band_keys(sketch(elements, plan.bands * plan.band_rows), plan.bands)) if len(elements) else [])
        return {"doc_id": column(batch, "doc_id"), "n_shingles": sizes, "low": lows, "high": highs, "bands": keys}

    return map_rows(split_evenly(docs.select("doc_id", "text")), "doc_id bigint, n_shingles bigint, low bigint, high bigint, bands array<bigint>", run)


def candidate_sets(ids: DataFrame, docs: DataFrame, plan: NearDedup) -> DataFrame:
    """(id, elements): the full sets of the documents in ``ids``, written once for all rounds of comparison.

    A doc_id that occurs with several texts has a row for each.
    """

    def run(batch: pa.RecordBatch) -> dict[str, object]:
        return {"id": column(batch, "doc_id"), "elements": [signed(shingle_set(text, plan.words)) for text in texts(batch)]}

    named = docs.select("doc_id", "text").join(bounded(ids.withColumnRenamed("id", "doc_id")), "doc_id", "left_semi")
    return stored(map_rows(named, "id bigint, elements array<bigint>", run), "near-sets")


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) with ``left`` and ``right``, their full sets, and ``common``, the size of the intersection."""
    both = pairs.join(sets.select(F.col("id").alias("b"), F.col("elements").alias("right")), "b")
    both = both.join(sets.select(F.col("id").alias("a"), F.col("elements").alias("left")), "a")
    return both.withColumn("common", F.size(F.array_intersect("left", "right")))


def confirmed(pairs: DataFrame, sets: DataFrame, plan: NearDedup) -> DataFrame:
    """The pairs (a, b, size_a, size_b) whose full sets are similar enough."""
    return overlaps(pairs, sets).where(F.col("common") * 100 >= (F.col("size_a") + F.col("size_b") - F.col("common")) * plan.percent)


def links_by_differences(rest: DataFrame, sets: DataFrame, plan: NearDedup) -> DataFrame:
    """The links (a, b) between different groups of large buckets, by how the sets differ from that of their leader.

    D(x) is what x and the leader do not share, c(x) what they share. Then |x & y| is exactly
    c(x) + c(y) - |leader| + |D(x) & D(y)|, so x and y are linked if and only if their differences share at
    least f(x) + f(y) elements, with f(x) = percent * |x| / (100 + percent) - c(x) + |leader| / 2. A row outside the
    group of the leader has an f so large that this is always above zero, whatever the other row. So only
    elements count that some row outside has and a row of another group too. A row that has fewer of
    them than it needs with the best of partners is done; the rest is looked at once more without it. Random
    edits of one text share few differences, so few pairs are left whose counts allow a link.
    """
    grouped = cut_lineage(rest.select("lead", "id", "root", "lead_root").distinct())
    star = overlaps(grouped.select(F.col("lead").alias("a"), F.col("id").alias("b")), sets)
    differing = F.concat(F.array_except("right", "left"), F.array_except("left", "right"))
    unit = 2 * (100 + plan.percent)  # f is counted in whole numbers: times this
    f = 2 * plan.percent * F.size("right") - unit * F.col("common") + (100 + plan.percent) * F.size("left")
    star = star.select(F.col("a").alias("lead"), F.col("b").alias("id"), F.xxhash64("left").alias("of"), f.cast("bigint").alias("f"), differing.alias("elements"))
    known = grouped.join(star, ["lead", "id"]).withColumn("out", F.col("root") != F.col("lead_root")).drop("lead_root")
    leader = ["lead", "of"]
    for _ in range(2):
        rows = cut_lineage(known).withColumn("row", F.xxhash64("elements"))
        each = rows.select(*leader, "id", "row", "root", "f", "out", F.explode("elements").alias("element"))
        sides = each.groupBy(*leader, "element").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.max("out").alias("some_out"))
        shared = each.join(sides.where("low < high and some_out").select(*leader, "element"), [*leader, "element"])
        kept = shared.groupBy(*leader, "id", "row", "root", "f", "out").agg(F.collect_list("element").alias("elements"))
        least = kept.groupBy(*leader).agg(F.min("f").alias("least"), F.min(F.when(F.col("out"), F.col("f"))).alias("least_out"))
        best = F.when(F.col("out"), F.col("least")).otherwise(F.col("least_out"))
        known = kept.join(least, leader).where(F.col("f") + best <= unit * F.size("elements")).drop("least", "least_out", "row")
    known = cut_lineage(known.withColumn("many", F.size("elements")))
    x, y = (known.select(*leader, *(F.col(name).alias(f"{name}_{side}") for name in ("id", "root", "f", "out", "many", "elements"))) for side in "xy")
    open_pairs = F.col("out_x") & (F.col("root_x") != F.col("root_y")) & (~F.col("out_y") | (F.col("id_x") < F.col("id_y")))
    enough = F.col("f_x") + F.col("f_y") <= unit * F.least("many_x", "many_y")
    same_leader = (x["lead"] == y["lead"]) & (x["of"] == y["of"])
    met = x.join(y, same_leader & open_pairs & enough)
    linked = met.where(F.size(F.array_intersect("elements_x", "elements_y")) * unit >= F.col("f_x") + F.col("f_y"))
    return linked.select(F.least("id_x", "id_y").alias("a"), F.greatest("id_x", "id_y").alias("b")).distinct()


def near_duplicates(docs: DataFrame, plan: NearDedup = NearDedup()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), a row per row of ``docs`` (doc_id, text; more columns are ignored).

    Nulls and texts without words have an empty set and stand alone. Rows of equal text share a
    component. A doc_id that occurs again is the same document: its rows are nodes of one name, which
    is linked when any of its texts is. A row without doc_id links with nothing and is kept.
    """
    rows = cut_lineage(sketches(docs, plan))
    nodes = (
        rows.where("n_shingles > 0 and doc_id is not null")
        .groupBy("low", "high")
        .agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("size"), F.first("bands").alias("bands"))
    )
    nodes = cut_lineage(nodes)
    keyed = shared_keys(nodes.select(F.explode("bands").alias("key"), "id", "size"))
    sets = candidate_sets(cut_lineage(keyed.select("id").distinct()), docs, plan)
    smaller, larger = F.least("size_a", "size_b"), F.greatest("size_a", "size_b")
    roots = linked_groups(
        keyed,
        lambda pairs: confirmed(pairs, sets, plan),
        smaller * 100 >= larger * plan.percent,
        lambda rest: links_by_differences(rest, sets, plan),
    )
    named = nodes.join(roots.withColumnRenamed("node", "id"), "id", "left").select("low", "high", F.coalesce("root", "id").alias("node_root"))
    found = rows.drop("bands").join(named, ["low", "high"], "left")
    root = F.when(F.col("n_shingles") > 0, F.coalesce("node_root", "doc_id")).otherwise(F.col("doc_id"))
    return found.select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), root).alias("component_id"), F.coalesce(root == F.col("doc_id"), F.lit(True)).alias("kept")
    )


def one_of_each(docs: DataFrame, plan: NearDedup = NearDedup()) -> DataFrame:
    """``docs`` with one document of each component: the smallest doc_id. Of rows that repeat a doc_id one stays; rows without doc_id all stay."""
    found = near_duplicates(docs, plan).where("doc_id is not null").groupBy("doc_id")
    found = cut_lineage(found.agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("times")))
    gone = cut_lineage(found.where("not kept or times > 1").select("doc_id", "kept"))
    again = docs.join(bounded(gone.where("kept").select("doc_id")), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return docs.join(bounded(gone.select("doc_id")), "doc_id", "left_anti").unionByName(again)
