"""Merkle fixity audit of web-archive replicas.

The records of an archive file lie one behind another. The digests of the records that begin in one
range of offsets are hashed into a leaf, ``fan_out`` neighbouring nodes into their parent, up to a
root per file; file roots are combined the same way up to one root of the whole archive. Two replicas
are compared from the top: only children of nodes that differ are looked at, level by level, and
records are only compared in ranges that differ. All levels are small next to the records and stay
distributed; every group that is hashed has a bounded number of members.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from relist.llm.runtime import cut_lineage, stored


@dataclass(frozen=True)
class Fixity:
    """pages_per_file: width of the range of page_id that one archive file holds; range_bytes: of a leaf; fan_out: children of a node."""

    pages_per_file: int = 1000
    range_bytes: int = 65_536
    fan_out: int = 16


def record_text(url: Column, html: Column) -> Column:
    """The archive record of a page: header lines, the payload and two line breaks. Nulls count as empty."""
    body = F.coalesce(html, F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
        body,
        F.lit("\r\n\r\n"),
    )


def records(pages: DataFrame, plan: Fixity = Fixity()) -> DataFrame:
    """(file, offset, length, copies, page_id, sha256) from (page_id, url, html).

    Records lie in the order of page_id; equal rows are one entry with ``copies`` in a row, at the
    offset of the first, so that a page repeated very often is no large group. Rows without page_id
    are spread over files of their own with negative numbers. More columns are ignored.
    """
    text = record_text(F.col("url"), F.col("html"))
    rows = pages.select("page_id", F.sha2(text, 256).alias("sha256"), F.octet_length(text).cast("bigint").alias("length"))
    file = F.coalesce(F.floor(F.col("page_id") / plan.pages_per_file), -1 - F.pmod(F.xxhash64("sha256"), F.lit(1024))).cast("bigint")
    rows = rows.groupBy("page_id", "sha256", "length").agg(F.count(F.lit(1)).alias("copies")).withColumn("file", file)
    order = Window.partitionBy("file").orderBy("page_id", "sha256").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.col("length") * F.col("copies")
    return rows.withColumn("offset", F.sum(size).over(order) - size).select("file", "offset", "length", "copies", "page_id", "sha256")


def digest_of(members: list[str]) -> Column:
    """One digest of the ordered members of a node."""
    return F.sha2(F.to_json(F.sort_array(F.collect_list(F.struct(*members)))), 256).alias("hash")


def leaves(placed: DataFrame, plan: Fixity) -> DataFrame:
    """(file, node, hash): a digest of the records that begin in each range of offsets."""
    node = F.floor(F.col("offset") / plan.range_bytes).cast("bigint").alias("node")
    return placed.groupBy("file", node).agg(digest_of(["offset", "length", "copies", "sha256"]))


def steps(left: DataFrame, right: DataFrame, plan: Fixity) -> list[dict[str, Column]]:
    """How each level names its parents, from the leaves to the root; deep enough for both replicas."""
    bounds = left.unionByName(right).agg(F.max("node").alias("deepest"), F.min("file").alias("first"), F.max("file").alias("last")).first()
    zero, above = F.lit(0).cast("bigint"), F.floor(F.col("node") / plan.fan_out).cast("bigint")
    found, deepest, first, last = [], bounds.deepest or 0, bounds.first or 0, bounds.last or 0
    while deepest > 0:
        found.append({"file": F.col("file"), "node": above})
        deepest //= plan.fan_out
    found.append({"file": zero, "node": F.floor(F.col("file") / plan.fan_out).cast("bigint")})
    first, last = first // plan.fan_out, last // plan.fan_out
    while first < -1 or last > 0:
        found.append({"file": zero, "node": above})
        first, last = first // plan.fan_out, last // plan.fan_out
    return [*found, {"file": zero, "node": zero}]


def tree(lowest: DataFrame, parents: list[dict[str, Column]]) -> list[DataFrame]:
    """The levels (file, node, hash) from the leaves to the root."""
    levels = [lowest]
    for parent in parents:
        levels.append(levels[-1].withColumns({f"up_{k}": v for k, v in parent.items()}).groupBy(F.col("up_file").alias("file"), F.col("up_node").alias("node")).agg(digest_of(["file", "node", "hash"])))
    return levels


def differing(left: DataFrame, right: DataFrame) -> DataFrame:
    """(file, node) of the nodes of one level whose digests differ or that one replica lacks."""
    other = right.withColumnRenamed("hash", "other")
    return left.join(other, ["file", "node"], "full").where(~F.col("hash").eqNullSafe(F.col("other"))).select("file", "node")


def differing_ranges(ours: DataFrame, theirs: DataFrame, plan: Fixity) -> DataFrame:
    """(file, node) of the leaves that differ, found from the roots down."""
    parents = steps(ours, theirs, plan)
    left, right = tree(ours, parents), tree(theirs, parents)
    wrong = differing(left[-1], right[-1])
    for level in range(len(parents) - 1, -1, -1):
        under = wrong.withColumnsRenamed({"file": "up_file", "node": "up_node"})

        def children(nodes: DataFrame, level: int = level, under: DataFrame = under) -> DataFrame:
            named = nodes.withColumns({f"up_{k}": v for k, v in parents[level].items()})
            return named.join(under, ["up_file", "up_node"], "left_semi").select("file", "node", "hash")

        wrong = cut_lineage(differing(children(left[level]), children(right[level])))
    return wrong


def audit(pages: DataFrame, replica: DataFrame, plan: Fixity = Fixity()) -> DataFrame:
    """(file, offset, length, page_id, kind, expected_sha256, found_sha256): the records in which ``replica`` departs from ``pages``.

    The trees lead to the ranges that differ. There the records are aligned by page_id and digest, so a record of another
    length, an inserted or a lost one moves those behind it without their being reported. What is left of a page on
    both sides is ``changed``, in the order of the digests; on one side it is ``missing`` or ``extra``. A record whose number of
    copies differs is changed too. offset, length and page_id are those of the sound record where there is one.
    Equal or empty replicas give no row. Rows without page_id are aligned by digest alone, and so are never changed.
    """
    good, found = (stored(records(p, plan), "records") for p in (pages, replica))
    wrong = differing_ranges(cut_lineage(leaves(good, plan)), cut_lineage(leaves(found, plan)), plan)
    columns = ("offset", "length", "copies", "page_id", "sha256")

    def suspects(placed: DataFrame) -> DataFrame:
        named = placed.withColumn("node", F.floor(F.col("offset") / plan.range_bytes).cast("bigint")).join(wrong, ["file", "node"], "left_semi")
        return named.withColumn("name", F.coalesce(F.col("page_id").cast("string"), F.lit(""))).select("file", "name", *columns)

    def tagged(rows: DataFrame, tag: str) -> DataFrame:
        return rows.withColumnsRenamed({name: f"{name}_{tag}" for name in columns})

    ours, theirs = cut_lineage(suspects(good)), cut_lineage(suspects(found))
    record = ["file", "name", "sha256"]
    both = ours.join(theirs.select(*record, F.col("copies").alias("found_copies")), record)
    recounted = tagged(both.where("copies <> found_copies").drop("found_copies"), "a").withColumns({"sha256_b": F.col("sha256_a"), "page_id_b": F.col("page_id_a")})
    known = both.select(*record)
    nth = Window.partitionBy("file", "name").orderBy("sha256")

    def unmatched(rows: DataFrame, tag: str) -> DataFrame:
        left = rows.join(known, record, "left_anti")
        nameless = F.when(F.col("page_id").isNull(), F.concat(F.lit(tag), "sha256"))
        return tagged(left.withColumn("nth", F.coalesce(nameless, F.row_number().over(nth).cast("string"))), tag)

    paired = unmatched(ours, "a").join(unmatched(theirs, "b"), ["file", "name", "nth"], "full")
    differing_records = paired.unionByName(recounted, allowMissingColumns=True)
    kind = F.when(F.col("sha256_b").isNull(), "missing").when(F.col("sha256_a").isNull(), "extra").otherwise("changed")
    return differing_records.select(
        "file",
        F.coalesce("offset_a", "offset_b").alias("offset"),
        F.coalesce("length_a", "length_b").alias("length"),
        F.coalesce("page_id_a", "page_id_b").alias("page_id"),
        kind.alias("kind"),
        F.col("sha256_a").alias("expected_sha256"),
        F.col("sha256_b").alias("found_sha256"),
    )
