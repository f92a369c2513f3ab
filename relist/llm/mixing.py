"""Mixing sources to target weights: capped water-filling and seeded repetitions.

Each source asks for its weight's share of all words but may not be repeated beyond ``most_epochs``.
Sources above their cap are clamped, and what is left is shared among the others in proportion to
their weights, until none is above. A document is taken whole as many times as its source's
repetition rate has whole epochs. For the rest, the documents of a source are laid end to end in a
seeded order and taken up to the fractional part of the source's words: the document in which it
ends is repeated by a fraction, its first words, so that each source meets its target to a word.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from relist.llm.runtime import bounded, cut_lineage

#: Words are what stands between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Mixing:
    """cycle: the weights given to the sources in order, again and again; most_epochs: repetitions a source may reach; seed: of the drawing."""

    cycle: int = 3
    most_epochs: int = 3
    seed: int = 42


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def ranked(df: DataFrame, key: str) -> DataFrame:
    """``df`` with ``rank`` from 0 in ascending order of ``key``, nulls last: ranges are sorted apart and offset by the sizes of those before."""
    ranges = cut_lineage(df.repartitionByRange(F.col(key).asc_nulls_last()).withColumn("part", F.spark_partition_id()))
    sizes = ranges.groupBy("part").agg(F.count(F.lit(1)).alias("own"))
    offsets = sizes.select("part", (F.sum("own").over(Window.orderBy("part")) - F.col("own")).alias("offset"))  # a row per partition
    place = F.row_number().over(Window.partitionBy("part").orderBy(F.col(key).asc_nulls_last())) - 1
    return ranges.withColumn("place", place).join(F.broadcast(offsets), "part").withColumn("rank", F.col("offset") + F.col("place")).drop("part", "place", "offset")


def source_targets(sizes: DataFrame, plan: Mixing) -> DataFrame:
    """(source, source_size, weight, target) from (source, size); only a few totals per round reach the driver."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = ranked(sources, "source").withColumn("weight", F.col("rank") % plan.cycle + 1).withColumn("cap", F.col("source_size") * plan.most_epochs)
    sources = cut_lineage(sources.drop("rank"))
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    left, weights = total, None
    share = F.lit(None).cast("double")
    clamped = F.lit(False)
    while True:
        free = sources.agg(F.sum(F.when(clamped, F.col("cap"))).alias("capped"), F.sum(F.when(~clamped, F.col("weight"))).alias("weights")).first()
        if (left, weights) == (total - (free.capped or 0), free.weights) or not free.weights:
            break
        left, weights = total - (free.capped or 0), free.weights
        share = F.col("weight") * F.lit(left).cast("bigint") / F.lit(weights)
        clamped = share > F.col("cap")
    return sources.select("source", "source_size", "weight", F.when(clamped, F.col("cap").cast("double")).otherwise(share).alias("target"))


def mixed(docs: DataFrame, plan: Mixing = Mixing()) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken), a row per row of ``docs``.

    ``size`` counts the words of the whole text, a null text has none. A null source is a source, last
    in order. Rows without words are never taken. Rows that repeat a doc_id are drawn side by side;
    where they differ, the smaller text comes first. More columns are ignored.
    """
    key = F.md5(F.concat_ws(":", F.lit(str(plan.seed)), F.col("doc_id").cast("string")))
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), key.alias("key"), F.md5("text").alias("tie"))
    rows = cut_lineage(rows.withColumn("slot", F.substring("key", 1, 3)))
    targets = source_targets(rows, plan)
    epochs = F.coalesce(F.floor(F.col("target") / F.nullif("source_size", F.lit(0))), F.lit(0)).cast("bigint")
    targets = cut_lineage(targets.withColumn("epochs", epochs).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")))

    slots = rows.groupBy("source", "slot").agg(F.sum("size").alias("words"))
    running = F.sum("words").over(Window.partitionBy("source").orderBy("slot"))
    slots = slots.withColumn("before", running - F.col("words")).withColumnRenamed("source", "_source")
    slots = slots.join(targets.select("source", "source_size", "target", "epochs", "rest"), F.col("_source").eqNullSafe(F.col("source"))).drop("source")
    slots = cut_lineage(slots.withColumnRenamed("slot", "_slot"))
    placed = rows.join(bounded(slots), F.col("source").eqNullSafe(F.col("_source")) & (F.col("slot") == F.col("_slot"))).drop("_source", "_slot")

    # Only the slot that the rest ends in is put in order; the slots before it are taken whole, those behind it not at all.
    ends_here = (F.col("before") < F.col("rest")) & (F.col("before") + F.col("words") > F.col("rest"))
    whole = placed.where(~ends_here).withColumn("extra", F.when(F.col("before") < F.col("rest"), F.col("size")).otherwise(F.lit(0).cast("bigint")))
    order = Window.partitionBy("source", "slot").orderBy("key", "tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = F.col("before") + F.sum("size").over(order) - F.col("size")
    left = F.greatest(F.floor("rest").cast("bigint") - start, F.lit(0).cast("bigint"))
    partly = placed.where(ends_here).withColumn("extra", F.least("size", left))
    taken = F.col("size") * F.col("epochs") + F.col("extra")
    return whole.unionByName(partly).select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"))
