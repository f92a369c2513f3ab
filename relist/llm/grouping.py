"""Connected groups from bucketed candidates, with every link confirmed and no bucket expanded into all its pairs.

Rows of a bucket are first compared with one leader, which is linear in the bucket. Rows that end up
in one group need no further comparison. A bucket that still holds several groups, if small, names the pairs of
different groups outright. Of a large one, a caller that knows more of its rows finds the remaining links
itself; otherwise it goes into another round without its leader, with a new one from outside the group
of the last, and what stays open over all rounds names its pairs, so that no link is missed. Two rows
of one group are never paired.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relist.llm.runtime import bounded, cut_lineage, discard, release, stored

Confirm = Callable[[DataFrame], DataFrame]
Finish = Callable[[DataFrame], DataFrame]

#: An open bucket of at most this many rows names its pairs outright; how a larger one is compared leads to the same links.
SMALL_BUCKET = 8
#: Rounds of leaders before what is still open names its pairs.
ROUNDS = 6


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable from each node of ``edges`` (a, b).

    Alternates the two star operations until nothing changes; each takes the minimum per node as a
    partial aggregate and joins it back, so a node with very many neighbours is split by the join.
    """
    links = cut_lineage(_turned(edges))
    state = _state(links)
    while state[0]:
        large = _star(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), F.col("b") > F.col("a"), own=False)
        links = cut_lineage(_star(large, F.lit(True), own=True))
        before, state = state, _state(links)
        if state == before:
            break
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


def joined_roots(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` (node, root) after ``links`` (a, b) have joined groups; only roots that a link moves are looked at."""
    links = cut_lineage(links.select("a", "b"))
    if links.isEmpty():
        return roots
    between = with_roots(links, roots).select(F.col("root_a").alias("a"), F.col("root_b").alias("b")).where("a <> b").distinct()
    moved = cut_lineage(components(between))
    top = moved.select(F.col("node").alias("root"), F.col("root").alias("top"))
    kept = roots.join(top, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return cut_lineage(kept.unionByName(moved).distinct())


def with_roots(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """``pairs`` (a, b, ...) with root_a and root_b; a node without a root is its own."""
    for side in ("a", "b"):
        of = roots.select(F.col("node").alias(side), F.col("root").alias("of"))
        pairs = pairs.join(of, side, "left").withColumn(f"root_{side}", F.coalesce("of", side)).drop("of")
    return pairs


def _state(links: DataFrame) -> tuple:
    """Number and hash sum of the links; they change as long as the links do."""
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first())


def _turned(edges: DataFrame) -> DataFrame:
    """Each edge once, from the larger to the smaller node."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()


def _star(directed: DataFrame, wanted: Column, own: bool) -> DataFrame:
    """Link the wanted neighbours of each node (and, if asked, the node itself) to the smallest of them and the node."""
    lowest = directed.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    moved = directed.where(wanted).join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    if own:
        moved = moved.unionByName(lowest.select("a", F.col("m").alias("b")))
    return moved.where("a > b").distinct()


#: Shared keys, of two numbers each, up to which they are sent to every executor instead of all keys being shuffled.
BROADCAST_KEYS = 2_000_000


def shared_keys(keyed: DataFrame) -> DataFrame:
    """(key, id, size, rows): the rows of keys that several ids have, with how many rows; written once."""
    shared = keyed.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count(F.lit(1)).alias("rows")).where("low < high")
    shared = bounded(cut_lineage(shared.select("key", "rows")), BROADCAST_KEYS)
    return stored(keyed.join(shared, "key"), "shared-keys")


def chained_groups(members: DataFrame, confirm: Confirm, may_link: Column, small: int, rounds: int) -> DataFrame:
    """(node, root) of all nodes that are linked with another one: ``linked_groups`` for links that are dear to confirm.

    Each row first meets one leader, the best one over all its buckets, and the leaders of its other buckets only if they are
    in another group still. So a group of many copies costs about a link per row, however many buckets its rows share.
    What a step has written is deleted as soon as the next one is there; ``members`` stay.
    """
    spark, rest = members.sparkSession, None
    met = members.groupBy("id").agg(F.sum("rows").alias("weight"))
    members = members.select("key", "id", "size").join(met, "id").withColumn("lead_root", F.lit(None).cast("bigint"))
    roots = spark.createDataFrame([], "node bigint, root bigint")
    for turn in range(rounds):
        rooted = members.join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
        outside = F.coalesce(F.col("root") != F.col("lead_root"), F.lit(True))
        leaders = rooted.groupBy("key").agg(F.max(F.struct(outside.alias("out"), F.col("weight"), (-F.col("id")).alias("id"), F.col("size"))).alias("top"))
        leaders = leaders.select("key", (-F.col("top.id")).alias("lead"), F.col("top.size").alias("lead_size"), F.col("top.weight").alias("lead_weight"))
        members = stored(members.drop("lead_root").join(leaders, "key"), "led-keys")
        if rest is not None:
            discard(rest)
        stars = members.where("id <> lead").select(F.col("lead").alias("a"), F.col("id").alias("b"), F.col("lead_size").alias("size_a"), F.col("size").alias("size_b"), "lead_weight")
        stars = stored(stars.where(may_link).select("a", "b", "lead_weight").distinct(), "stars")
        apart = stars if turn == 0 else with_roots(stars, roots).where("root_a <> root_b").select(*stars.columns)
        best = apart.groupBy("b").agg(F.max(F.struct("lead_weight", (-F.col("a")).alias("a"))).alias("top"))
        best = cut_lineage(best.select((-F.col("top.a")).alias("a"), "b"))
        roots = joined_roots(roots, confirm(best))
        others = with_roots(stars.join(best, ["a", "b"], "left_anti"), roots).where("root_a <> root_b")
        roots = joined_roots(roots, confirm(others.select("a", "b")))
        discard(stars)
        release(spark)

        rooted = members.drop("lead_size", "lead_weight").join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
        sides = rooted.groupBy("key").agg(
            F.min(F.when(F.col("id") != F.col("lead"), F.col("root"))).alias("low"),
            F.max(F.when(F.col("id") != F.col("lead"), F.col("root"))).alias("high"),
            F.max(F.when(F.col("id") == F.col("lead"), F.col("root"))).alias("lead_root"),
            F.count(F.lit(1)).alias("rows"),
        )
        rest = stored(rooted.where("id <> lead").join(sides.where("low < high").select("key", "lead_root", "rows"), "key"), "open-keys")
        discard(members)
        last = turn == rounds - 1
        direct = crossing_pairs(rest if last else rest.where(F.col("rows") - 1 <= small), may_link)
        roots = joined_roots(roots, confirm(direct.select("a", "b")))
        large = rest.where(F.col("rows") - 1 > small)
        release(spark)
        if last or large.isEmpty():
            discard(rest)
            break
        members = large.select("key", "id", "size", "lead_root", "weight")
    return roots


def linked_groups(members: DataFrame, confirm: Confirm, may_link: Column, finish: Finish | None = None) -> DataFrame:
    """(node, root) of all nodes that are linked with another one.

    ``members``: (key, id, size, rows), one row per bucket of a node, as ``shared_keys`` gives them. ``confirm`` keeps the true links among
    the pairs (a, b, size_a, size_b) that it gets. ``may_link`` is a cheap necessary condition on
    size_a and size_b. ``finish`` may take the large open buckets (key, id, size, lead, root, lead_root;
    without their leaders) and give all links (a, b) between their groups.

    The first leader of a bucket is the node that meets most others over all its buckets, which in a group
    of edited copies tends to be the one that is nearest to all of them.
    """
    met = members.groupBy("id").agg(F.sum("rows").alias("weight"))
    members = members.select("key", "id", "size").join(met, "id").withColumns({"root": F.col("id"), "lead_root": F.lit(None).cast("bigint")})
    links, roots = None, None
    for turn in range(ROUNDS):
        outside = F.coalesce(F.col("root") != F.col("lead_root"), F.lit(True))
        leaders = members.groupBy("key").agg(F.max(F.struct(outside.alias("out"), F.col("weight"), (-F.col("id")).alias("id"), F.col("size"), F.col("root"))).alias("top"))
        leaders = leaders.select("key", (-F.col("top.id")).alias("lead"), F.col("top.size").alias("lead_size"), F.col("top.root").alias("of"))
        members = cut_lineage(members.drop("lead_root").join(leaders, "key"))
        stars = members.where("root <> of").select(F.col("lead").alias("a"), F.col("id").alias("b"), F.col("lead_size").alias("size_a"), F.col("size").alias("size_b"))
        found = cut_lineage(confirm(stars.where(may_link).distinct()).select("a", "b"))
        if turn == 0 or not found.isEmpty():
            links = found if links is None else links.unionByName(found)
            roots = components(links)
        rooted = members.drop("root", "of").join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
        lead_root = F.max(F.when(F.col("id") == F.col("lead"), F.col("root"))).alias("lead_root")
        sides = rooted.groupBy("key").agg(
            F.min(F.when(F.col("id") != F.col("lead"), F.col("root"))).alias("low"),
            F.max(F.when(F.col("id") != F.col("lead"), F.col("root"))).alias("high"),
            lead_root,
            F.count(F.lit(1)).alias("rows"),
        )
        rest = cut_lineage(rooted.where("id <> lead").join(sides.where("low < high").select("key", "lead_root", "rows"), "key"))
        if rest.isEmpty():
            return roots
        last = turn == ROUNDS - 1
        direct = crossing_pairs(rest if last else rest.where(F.col("rows") - 1 <= SMALL_BUCKET), may_link)
        found = cut_lineage(confirm(direct).select("a", "b"))
        if not found.isEmpty():
            links = links.unionByName(found)
            roots = components(links)
        large = rest.where(F.col("rows") - 1 > SMALL_BUCKET)
        if last or large.isEmpty():
            return roots
        if finish:
            more = cut_lineage(finish(large))
            return roots if more.isEmpty() else components(links.unionByName(more))
        members = large.select("key", "id", "size", "root", "lead_root", "weight")
    return roots


def crossing_pairs(rest: DataFrame, may_link: Column) -> DataFrame:
    """(a, b, size_a, size_b): the rows of different groups in each bucket that may be linked, each pair once.

    ``rest``: (key, id, size, root, lead_root). Rows of the group of the bucket's last leader meet those outside it alone.
    """
    left = rest.where("root <> lead_root").select("key", F.col("id").alias("a"), F.col("size").alias("size_a"), F.col("root").alias("root_a"))
    right = rest.select("key", F.col("id").alias("b"), F.col("size").alias("size_b"), F.col("root").alias("root_b"), (F.col("root") == F.col("lead_root")).alias("led"))
    once = (left["root_a"] != right["root_b"]) & (right["led"] | (left["a"] < right["b"]))
    met = left.join(right, (left["key"] == right["key"]) & once & may_link)
    return met.select(*ordered("a", "b", "size_a", "size_b")).distinct()


def ordered(a: str, b: str, size_a: str, size_b: str) -> list[Column]:
    """A pair with its sizes, the smaller node first."""
    first = F.col(a) < F.col(b)
    return [
        F.least(a, b).alias("a"),
        F.greatest(a, b).alias("b"),
        F.when(first, F.col(size_a)).otherwise(F.col(size_b)).alias("size_a"),
        F.when(first, F.col(size_b)).otherwise(F.col(size_a)).alias("size_b"),
    ]
