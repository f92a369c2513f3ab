"""Token counts of flat, unindexed token files by a scan for the end-of-document identifier.

A flat file is nothing but token identifiers of fixed width, each document closed by the separator
identifier. Files are cut into blocks of bytes and every block is searched on its own: one vectorised
comparison gives the places of all separators, and a document belongs to the block that it starts in.
A block that ends inside a document does not know where that document ends, nor how many documents
came before. Both follow from one summary row per block: the number of separators by a prefix sum,
the next separator by a scan from the end. No task reads more than a block and a few tokens beyond.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from relist.llm.hashing import Words
from relist.llm.runtime import column, map_rows, scratch_folder, split_evenly, stored, texts

SEPARATOR = 0
#: Identifiers of words are 1 to 65,535. A document begins with five tokens that spell its doc_id, 15 bits and one more than zero each.
WORDS, DIGITS, BITS = 65_535, 5, 15
NO_ID = 1 << BITS


@dataclass(frozen=True)
class TokenScan:
    """separator: identifier that closes a document; head: first tokens of a document to return; block_bytes: read by a task at once, a multiple of two."""

    separator: int = SEPARATOR
    head: int = DIGITS
    block_bytes: int = 8 << 20


def read_range(path: str, start: int, size: int) -> bytes:
    """Bytes of a file in any store that Spark has listed."""
    if path.startswith("file:"):
        with open(unquote(path[5:].replace("//", "/", 1) if path.startswith("file://") else path[5:]), "rb") as stream:
            stream.seek(start)
            return stream.read(size)
    system, name = pyarrow.fs.FileSystem.from_uri(path)
    with system.open_input_file(name) as stream:
        return stream.read_at(min(size, max(0, stream.size() - start)), start)


def document_lengths(spark: SparkSession, path: str, plan: TokenScan = TokenScan()) -> DataFrame:
    """(path, document, start, tokens, closed, head) of every document of the 16-bit token files below ``path``.

    ``document`` counts from 0 in each file, ``start`` and ``tokens`` are in tokens without the
    separator. Tokens behind the last separator are a document that is not closed. Two separators in
    a row enclose a document of no tokens; an empty file has none.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "length")
    begin = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(plan.block_bytes).cast("bigint")))
    blocks = files.where("length > 0").select("path", "length", begin.alias("begin"))
    blocks = blocks.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path", "begin")

    def scan(batch: pa.RecordBatch) -> dict[str, object] | None:
        out: dict[str, list] = {name: [] for name in ("path", "begin", "local", "start", "end", "head", "separators", "first")}
        for path, length, begin in zip(*(column(batch, c).to_pylist() for c in ("path", "length", "begin")), strict=True):
            data = np.frombuffer(read_range(path, begin, plan.block_bytes + 2 * plan.head), "<u2")
            size, offset = min(plan.block_bytes, length - begin) // 2, begin // 2
            places = np.flatnonzero(data[:size] == plan.separator)
            starts = places + 1 if begin else np.concatenate([[0], places + 1])
            starts = starts[starts + offset < length // 2]
            ends = np.searchsorted(places, starts)
            n = len(starts)
            heads = [data[s : s + plan.head].astype(np.int32) for s in starts]
            heads = [head[: np.append(np.flatnonzero(head == plan.separator), len(head))[0]] for head in heads]
            out["path"] += [path] * (n + 1)
            out["begin"] += [begin] * (n + 1)
            out["local"] += [*range(n), None]
            out["start"] += [*(starts + offset).tolist(), None]
            out["end"] += [*(int(places[e]) + offset if e < len(places) else None for e in ends), None]
            out["head"] += [*heads, None]
            out["separators"] += [None] * n + [n]
            out["first"] += [None] * n + [int(places[0]) + offset if len(places) else None]
        return out

    schema = "path string, begin bigint, local bigint, start bigint, end bigint, head array<int>, separators bigint, first bigint"
    found = stored(map_rows(blocks, schema, scan), "token-scan")
    order = Window.partitionBy("path").orderBy("begin")
    summary = found.where("separators is not null").select(
        "path",
        "begin",
        (F.sum("separators").over(order) - F.col("separators")).alias("before"),
        F.first("first", ignorenulls=True).over(order.rowsBetween(1, Window.unboundedFollowing)).alias("later"),
    )
    joined = found.where("local is not null").join(summary, ["path", "begin"]).join(files.withColumn("tokens", F.floor(F.col("length") / 2)), "path")
    end = F.coalesce("end", "later")
    return joined.select(
        "path", (F.col("before") + F.col("local")).alias("document"), "start", (F.coalesce(end, "tokens") - F.col("start")).alias("tokens"), end.isNotNull().alias("closed"), "head"
    )


def write_tokens(docs: DataFrame, path: str) -> None:
    """Flat token files of ``docs`` (doc_id, text): five tokens that spell doc_id, one hashed token per word, and the separator.

    Spark's text writer closes each row with the two zero bytes of the separator, so the files hold
    nothing else. A null doc_id is spelled by tokens that no other one has.
    """

    def encode(batch: pa.RecordBatch) -> dict[str, object]:
        rows = []
        for doc_id, text in zip(column(batch, "doc_id").to_pylist(), texts(batch), strict=True):
            unsigned = (doc_id or 0) % (1 << 64)
            digits = [(NO_ID if doc_id is None else (unsigned >> BITS * k) % NO_ID) + 1 for k in range(DIGITS)]
            words = Words(text.encode("utf-8", "surrogatepass")).hash % np.uint64(WORDS) + np.uint64(1)
            rows.append(np.concatenate([np.array(digits, "<u2"), words.astype("<u2")]).tobytes())
        return {"tokens": rows}

    encoded = map_rows(split_evenly(docs.select("doc_id", "text")), "tokens binary", encode)
    encoded.select(F.col("tokens").cast("string").alias("value")).write.option("lineSep", "\0\0").text(path)


def token_counts(docs: DataFrame, plan: TokenScan = TokenScan()) -> DataFrame:
    """(doc_id, n_tokens) of ``docs``, counted in flat token files that are written first. A null text has no tokens; equal rows are counted apart."""
    path = scratch_folder(docs.sparkSession, "tokens")
    write_tokens(docs, path)
    found = document_lengths(docs.sparkSession, path, plan)
    digits = [(F.get("head", F.lit(k)) - 1).cast("bigint") for k in range(DIGITS)]
    doc_id = reduce(Column.bitwiseOR, (F.shiftleft(digit, BITS * k) for k, digit in enumerate(digits)))
    return found.select(F.when(digits[0] < NO_ID, doc_id).alias("doc_id"), (F.col("tokens") - DIGITS).alias("n_tokens"))
