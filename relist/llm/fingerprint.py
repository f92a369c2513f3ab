"""Lempel-Ziv fingerprints: the phrase set of a parse, compared by minimum hashes.

A text is parsed into dictionary phrases: each phrase is the shortest string that the parse has not
met before, so repeated material gives few and long phrases. Texts that share material share
phrases, much as they would compress well together. The fingerprint is the smallest hashes of the
phrase set of the whole text; the likeness of two texts is the share of the smallest hashes of both
sets together that lie in both, an estimate of the sets' Jaccard similarity.

Each document is compared with the next one in the order of doc_id and with a copy of itself that
ends like the next one begins. Texts are dealt out and sorted by ranges of doc_id once. A task
walks through its range with one text in hand; only the last document of a range needs the first of
the following range, and these few rows are completed afterwards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from relist.llm.hashing import Powers, mix
from relist.llm.runtime import column, map_rows, stored, texts

RESULT = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
#: A row of a range, or with ``head`` and ``tail`` its border: its first text, and its last text that waits for its successor.
RANGED = f"{RESULT}, part int, head string, tail string"


@dataclass(frozen=True)
class Fingerprints:
    """hashes: of the phrase set that are kept; cut: the part 1 / cut of a text that the edited one replaces."""

    hashes: int = 64
    cut: int = 4


def parse(text: str, seen: set[str], start: int, end: int, bounds: list[int]) -> int:
    """Parse from ``start`` as far as whole phrases reach; adds to ``seen`` and ``bounds`` and returns where it stopped.

    The prefixes of a known phrase are known, so the length of the next one is searched from that of the last.
    """
    length = 1
    while start < end:
        if text[start : start + length] in seen:
            length += 1
            while start + length <= end and text[start : start + length] in seen:
                length += 1
        else:
            while length > 1 and text[start : start + length - 1] not in seen:
                length -= 1
        if start + length > end:
            break
        seen.add(text[start : start + length])
        start += length
        bounds.append(start)
    return start


def smallest(text: str, bounds: list[int], hashes: int) -> np.ndarray:
    """The smallest 32-bit hashes of the phrases that end at ``bounds``."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    Powers.grow(len(points) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(points.astype(np.uint64) + np.uint64(1)) * Powers.up[: len(points)])])
    end = np.array(bounds, np.int64)
    start = np.concatenate([np.zeros(1, np.int64), end])[: len(end)]
    hashed = mix((sums[end] - sums[start]) * Powers.down[start])
    return np.unique((hashed >> np.uint64(32)).astype(np.uint32))[:hashes]


def fingerprint(text: str, plan: Fingerprints = Fingerprints()) -> np.ndarray:
    bounds: list[int] = []
    parse(text, set(), 0, len(text), bounds)
    return smallest(text, bounds, plan.hashes)


def likeness(left: np.ndarray, right: np.ndarray, hashes: int) -> float:
    """Estimated Jaccard similarity; two empty sets are alike."""
    both = np.union1d(left, right)[:hashes]
    if not len(both):
        return 1.0
    return float(np.isin(both, np.intersect1d(left, right, assume_unique=True), assume_unique=True).sum()) / len(both)


class Parsed:
    """A text parsed up to the part that an edit would replace, then to its end."""

    def __init__(self, text: str, plan: Fingerprints) -> None:
        self.text, self.plan = text, plan
        self.kept = len(text) - len(text) // plan.cut
        seen: set[str] = set()
        self.bounds: list[int] = []
        self.reached = parse(text, seen, 0, self.kept, self.bounds)
        self.seen = set(seen)
        whole = list(self.bounds)
        parse(text, seen, self.reached, len(text), whole)
        self.hashes = smallest(text, whole, plan.hashes)

    def against(self, following: str, following_hashes: np.ndarray) -> tuple[int, str, bytes, bytes, float, float]:
        """n_chars, edited_sha256, both fingerprints and both likenesses, given the next document."""
        edited = self.text[: self.kept] + following[: len(self.text) - self.kept]
        bounds = list(self.bounds)
        parse(edited, self.seen, self.reached, len(edited), bounds)
        other = smallest(edited, bounds, self.plan.hashes)
        return (
            len(self.text),
            hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
            self.hashes.astype(">u4").tobytes(),
            other.astype(">u4").tobytes(),
            likeness(self.hashes, other, self.plan.hashes),
            likeness(self.hashes, following_hashes, self.plan.hashes),
        )


def fingerprints(docs: DataFrame, plan: Fingerprints = Fingerprints()) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next), a row per row of ``docs``.

    Null texts count as empty. Rows without doc_id come last; rows that repeat a doc_id follow each
    other in the order of their texts. The last document is followed by the first, a single one by
    itself. An empty text has an empty fingerprint. More columns are ignored.
    """
    spark = docs.sparkSession
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).repartitionByRange(count, F.col("doc_id").asc_nulls_last())
    ranges = ranges.sortWithinPartitions(F.col("doc_id").asc_nulls_last(), "text").withColumn("part", F.spark_partition_id())
    schema = StructType.fromDDL(RANGED)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, last, last_id, part = None, None, None, None
        for batch in batches:
            rows = []
            for doc_id, own_part, text in zip(column(batch, "doc_id").to_pylist(), column(batch, "part").to_pylist(), texts(batch), strict=True):
                now = Parsed(text, plan)
                if last is None:
                    head, part = text, own_part
                else:
                    rows.append((last_id, *last.against(text, now.hashes), part, None, None))
                last, last_id = now, doc_id
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)
        if last is not None:
            border = (last_id, None, None, None, None, None, None, part, head, last.text)
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(border, arrow, strict=True)], schema=arrow)

    ranged = stored(ranges.mapInArrow(run, schema), "fingerprints")
    borders = ranged.where("head is not null")
    parts = borders.select("part")
    order = Window.orderBy("part")  # a row per range
    following = parts.select("part", F.coalesce(F.lead("part").over(order), F.first("part").over(order)).alias("following"))
    heads = borders.select(F.col("part").alias("following"), F.col("head").alias("next_text"))

    def complete(batch: pa.RecordBatch) -> dict[str, object]:
        rows = [Parsed(text, plan).against(follower, fingerprint(follower, plan)) for text, follower in zip(texts(batch, "tail"), texts(batch, "next_text"), strict=True)]
        names = ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
        return {"doc_id": column(batch, "doc_id"), **dict(zip(names, zip(*rows, strict=True) if rows else ([],) * 6, strict=True))}

    ends = map_rows(borders.select("doc_id", "part", "tail").join(following, "part").join(heads, "following").select("doc_id", "tail", "next_text"), RESULT, complete)
    found = ranged.where("head is null").drop("part", "head", "tail").unionByName(ends)
    return found.withColumns({name: F.lower(F.hex(name)) for name in ("fingerprint", "edited_fingerprint")})
