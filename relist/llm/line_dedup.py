"""Fuzzy line deduplication: SimHash blocks of normalised lines, verified edit similarity.

A line is normalised to its lower-case words, with ASCII punctuation and white space as one space.
Equal normalised lines are one node, aggregated before anything is compared. The SimHash of a node has
``BLOCKS`` blocks of 32 bits. A bit is the weighted majority of that bit of the word hashes; the weight
of a word is its squared length times its rarity over an exponential draw, cubed, with draws of its own for
each block. So a few words, other ones in each block, decide a block, and an edit leaves the
blocks alone that its words do not decide. By the pigeonhole principle, edits that reach at most three of
the five blocks leave two as they were: every two blocks are a key, and lines that share one are candidates,
unless their plain SimHashes, without draws, differ in more than ``MOST_BITS`` of 64 bits, as those of strangers do that share two words.

Lines of few words, and of scripts without spaces, have blocks over their character triples too.
A coarse length class is part of each key, as edit similarity bounds the ratio of two lengths; a line near
the end of its class also looks into the next one. Candidates are verified by edit distance
on the full normalised lines, and one occurrence of each connected group stays: the first by doc_id
and line number.

The README has measured recall. Edits scattered over most words of a line are missed the more often the
more there are.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relist.llm.edits import all_within, within
from relist.llm.grouping import chained_groups, shared_keys
from relist.llm.hashing import Words, mix, signed
from relist.llm.runtime import BROADCAST_ROWS, bounded, column, cut_lineage, discard, map_rows, release, shared, sliced, split_evenly, stored, texts

_PUNCTUATION = b"\t\r\x0b\x0c" + bytes(c for c in range(33, 127) if not chr(c).isalnum())
_PLAIN = bytes.maketrans(_PUNCTUATION, b" " * len(_PUNCTUATION))

#: Runs of scripts that are written without spaces: Thai, Lao, Myanmar, Khmer, Kana, Han.
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u30ff\u3400-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]{2,}")
#: Blocks of a SimHash; two of them make a key.
BLOCKS = 5
KEYS = tuple(combinations(range(BLOCKS), 2))
#: A line of at most this many words has blocks over its character triples too; one of fewer words than ``WORDS`` has these alone.
FEW_WORDS, WORDS = 6, 3
_SEEDS = mix(np.arange(101, 101 + BLOCKS, dtype=np.uint64))
_WORD_BLOCKS = tuple(f"block{n}" for n in range(BLOCKS))
_TRIPLE_BLOCKS = tuple(f"triple{n}" for n in range(BLOCKS))
#: The signs of four bits, each in 16 bits of a number, so that one addition counts four majorities.
_LANES = np.array([sum(1 << 16 * k for k in range(4) if nibble >> k & 1) for nibble in range(16)], np.uint64)
LENGTH_CLASS = 4.0
#: Bits in which the plain SimHashes of candidates may differ. Where half of the words are the same it is 21 on average, where one in ten is 30.
MOST_BITS = 24
#: A word is frequent if more than this share of all words are it; there cannot be more than 1 / FREQUENT of these.
FREQUENT = 1e-5
#: Buckets of lines up to this many rows are compared in pairs of numbers, before any text is read; larger ones have had this many leaders by then.
SMALL, LEADERS = 200, 2
#: Characters that are hashed together in one go, for speed alone.
JOINED = 100_000
#: Bytes of lines whose pairs are compared in one go, for speed alone.
TOGETHER_BYTES = 8_000_000


@dataclass(frozen=True)
class LineDedup:
    """percent: least edit similarity of a link, in percent."""

    percent: int = 80


def normalised(text: str) -> bytes:
    """The text in lower case, its punctuation as spaces; line breaks stay."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_PLAIN)


@dataclass
class Rarity:
    """Sorted hashes of the frequent words, and a factor below one for the weight of each; all other words have one."""

    hashes: np.ndarray
    factor: np.ndarray

    def of(self, words: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.ones(len(words))
        slot = np.minimum(np.searchsorted(self.hashes, words), len(self.hashes) - 1)
        return np.where(self.hashes[slot] == words, self.factor[slot], 1.0)


def rarity(docs: DataFrame) -> Rarity:
    """How frequent the frequent words of all lines are; a task sends a count per word of a batch."""

    def run(batch: pa.RecordBatch) -> dict[str, object] | None:
        hashes = [Words(normalised(text)).hash for text in texts(batch)]
        if not hashes:
            return None
        found, times = np.unique(np.concatenate(hashes), return_counts=True)
        return {"word": signed(found), "times": times}

    counts = cut_lineage(map_rows(split_evenly(docs.select("text")), "word bigint, times bigint", run).groupBy("word").agg(F.sum("times").alias("times")))
    total = counts.agg(F.sum("times")).first()[0] or 1
    rows = counts.where(F.col("times") > total * FREQUENT).collect()
    table = np.array(sorted((r.word % (1 << 64), r.times) for r in rows), np.uint64).reshape(-1, 2)
    return Rarity(table[:, 0], np.sqrt(np.log(table[:, 1].astype(np.float64) / total) / math.log(FREQUENT)))


NO_RARITY = Rarity(np.zeros(0, np.uint64), np.zeros(0))


def line_table(text: str, rare: Rarity = NO_RARITY) -> dict[str, np.ndarray]:
    """Line number, two digests, length in code points and blocks of each line with words; blocks over triples are 0 where the line has none (``triples``)."""
    data = normalised(text)
    words = Words(data)
    if not len(words):
        return {name: np.zeros(0, np.int64) for name in ("line_no", "low", "high", "chars", "sim", "triple_sim", *_WORD_BLOCKS, *_TRIPLE_BLOCKS)} | {name: np.zeros(0, bool) for name in ("by_words", "by_triples")}
    breaks = np.flatnonzero(words.raw == 10)
    line = np.searchsorted(breaks, words.start)
    first = np.flatnonzero(np.diff(line, prepend=-1))
    count = np.diff(first, append=len(line))
    term = mix(words.hash + mix((np.arange(len(line)) - np.repeat(first, count)).astype(np.uint64)))
    low = np.add.reduceat(term, first)
    high = np.add.reduceat(mix(term ^ np.uint64(0x2545F491)), first)
    points = np.concatenate([[0], np.cumsum((words.raw & 0xC0) != 0x80)])
    chars = np.add.reduceat(points[words.end] - points[words.start], first) + count - 1
    found = {"line_no": line[first], "low": signed(low), "high": signed(high), "chars": chars}
    weight = word_weights(words, rare)
    found["sim"] = plain_simhash(words, first, count, word_weights(words, NO_RARITY))
    found |= dict(zip(_WORD_BLOCKS, simhash_blocks(words, first, count, weight), strict=True))
    return found | triple_blocks(data, words.raw, line[first], count) | {"by_words": count >= WORDS}


def triple_blocks(data: bytes, raw: np.ndarray, lines: np.ndarray, count: np.ndarray) -> dict[str, np.ndarray]:
    """Blocks over the character triples of the lines of few words or of a script without spaces, 0 for all others."""
    found = {name: np.zeros(len(lines), np.int32) for name in _TRIPLE_BLOCKS} | {"triple_sim": np.zeros(len(lines), np.int64), "by_triples": np.zeros(len(lines), bool)}
    wide = np.unique(np.searchsorted(np.flatnonzero(raw == 10), np.flatnonzero(raw >= 0xE0)))  # lines with a character of three bytes or more
    chosen = np.flatnonzero((count <= FEW_WORDS) | np.isin(lines, wide))
    if not len(chosen):
        return found
    split, parts, places = data.split(b"\n"), [], []
    for place in chosen:
        line = b" ".join(split[lines[place]].split()).decode("utf-8", "replace")
        if count[place] <= FEW_WORDS or UNSPACED.search(line):
            marked = f"_{line.replace(' ', '_')}_"
            parts.append(" ".join(marked[k : k + 3] for k in range(len(marked) - 2)))
            places.append(place)
    if not places:
        return found
    words = Words("\n".join(parts).encode("utf-8", "surrogatepass"))
    line = np.searchsorted(np.flatnonzero(words.raw == 10), words.start)
    first = np.flatnonzero(np.diff(line, prepend=-1))
    each, weight = np.diff(first, append=len(line)), np.ones(len(words))
    found["triple_sim"][places] = plain_simhash(words, first, each, weight)
    for name, block in zip(_TRIPLE_BLOCKS, simhash_blocks(words, first, each, weight), strict=True):
        found[name][places] = block
    found["by_triples"][places] = True
    return found


def majorities(drawn: np.ndarray, weight: np.ndarray, first: np.ndarray, count: np.ndarray, nibbles: int) -> np.ndarray:
    """The weighted majority of each of the lowest bits of ``drawn``, by line.

    The weights of a line are scaled to a sum below 2^16, so that the sums of four bits stand side by side in one number.
    """
    scaled = (weight * np.repeat(65_000 / np.add.reduceat(weight, first), count)).astype(np.uint64)
    half = np.add.reduceat(scaled, first) // np.uint64(2)
    found = np.zeros(len(first), np.uint64)
    for nibble in range(nibbles):
        bits = (drawn >> np.uint64(4 * nibble)).astype(np.uint8) & 15
        total = np.add.reduceat(_LANES[bits] * scaled, first)
        for k in range(4):
            ones = (total >> np.uint64(16 * k)) & np.uint64(0xFFFF)
            found |= (ones > half).astype(np.uint64) << np.uint64(4 * nibble + k)
    return found


def plain_simhash(words: Words, first: np.ndarray, count: np.ndarray, weight: np.ndarray) -> np.ndarray:
    return majorities(mix(words.hash ^ np.uint64(0x5157)), weight, first, count, 16).view(np.int64)


def word_weights(words: Words, rare: Rarity) -> np.ndarray:
    return np.square(np.clip(words.end - words.start - 2, 0.2, 16)) * rare.of(words.hash)


def simhash_blocks(words: Words, first: np.ndarray, count: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    """The blocks of each line: ``first`` and ``count`` say which words it has.
    """
    blocks = []
    for seed in _SEEDS:
        drawn = mix(words.hash ^ seed)
        heavy = weight / -np.log(((drawn >> np.uint64(32)).astype(np.float64) + 0.5) / (1 << 32))
        heavy = heavy * heavy * heavy
        blocks.append(majorities(drawn, heavy, first, count, 8).astype(np.uint32).view(np.int32))
    return blocks


def line_rows(docs: DataFrame, rare: Rarity) -> DataFrame:
    """(doc_id, row, line_no, ...) of the lines of ``line_table``; ``row`` tells texts of one doc_id apart."""
    sent = shared(docs.sparkSession, rare)

    def run(batch: pa.RecordBatch) -> dict[str, object] | None:
        if not batch.num_rows:
            return None
        lines = [text.count("\n") + 1 for text in texts(batch)]
        begin = np.cumsum([0, *lines])
        parts, held, size, first = [], [], 0, 0
        for place, text in enumerate(texts(batch)):  # several texts at once: a line break stands between them as within them
            held.append(text)
            size += len(text)
            if size > JOINED or place == batch.num_rows - 1:
                found = line_table("\n".join(held), sent.value)
                found["line_no"] = found["line_no"] + begin[first]
                parts.append(found)
                held, size, first = [], 0, place + 1
        whole = {name: np.concatenate([part[name] for part in parts]) for name in parts[0]}
        number = whole["line_no"]
        owner = np.searchsorted(begin, number, "right") - 1
        doc_id, row = (column(batch, name).to_numpy()[owner] for name in ("doc_id", "row"))
        return whole | {"doc_id": doc_id, "row": row, "line_no": (number - begin[owner]).astype(np.int32)}

    blocks = ", ".join(f"{name} int" for name in (*_WORD_BLOCKS, *_TRIPLE_BLOCKS))
    schema = f"doc_id bigint, row bigint, line_no int, low bigint, high bigint, chars bigint, sim bigint, triple_sim bigint, by_words boolean, by_triples boolean, {blocks}"
    return map_rows(split_evenly(named(docs)), schema, run)


def named(docs: DataFrame) -> DataFrame:
    return docs.where("doc_id is not null and text is not null").select("doc_id", F.xxhash64("text").alias("row"), "text")


def block_keys(nodes: DataFrame, plan: LineDedup) -> DataFrame:
    """(key, id, size, rows): a key per two blocks of a node and length class looked into, those of several nodes alone; ``size`` is the length and the SimHash behind the key."""
    step = math.log(LENGTH_CLASS)
    own = F.floor(F.log(F.col("chars").cast("double")) / step)
    upper = F.floor(F.log(F.col("chars") * (100.0 / plan.percent) * 1.000001) / step)

    def keys(names: tuple[str, ...], kind: str) -> Column:
        return F.array(*(F.xxhash64(F.lit(f"{kind}{a}{b}"), names[a], names[b], "class") for a, b in KEYS))

    def of(names: tuple[str, ...], kind: str, wanted: str, sim: str) -> DataFrame:
        classed = nodes.where(wanted).withColumn("class", F.explode(F.array_distinct(F.array(own, upper))))
        return classed.select(F.explode(keys(names, kind)).alias("key"), "id", F.struct("chars", F.col(sim).alias("sim")).alias("size"))

    return shared_keys(of(_WORD_BLOCKS, "w", "by_words", "sim").unionByName(of(_TRIPLE_BLOCKS, "t", "by_triples", "triple_sim")))


def may_link(plan: LineDedup) -> Column:
    """What the lengths of two lines within the edit distance meet, and the SimHashes of candidates."""
    near = F.abs(F.col("size_a.chars") - F.col("size_b.chars")) * 100 <= F.greatest("size_a.chars", "size_b.chars") * (100 - plan.percent)
    bits = F.bit_count(F.col("size_a.sim").bitwiseXOR(F.col("size_b.sim")))
    return near & (bits <= MOST_BITS)


def first_lines(ids: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(id, line): the normalised line of each node in ``ids``, read again from the first document that has it."""
    wanted = cut_lineage(nodes.join(bounded(ids), "id", "left_semi").select("id", "first.doc_id", "first.row", "first.line_no"))
    by_text = wanted.groupBy("doc_id", "row").agg(F.collect_list(F.struct("id", "line_no")).alias("wanted"))
    few = wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS  # of the lists' members, not of the lists

    def run(batch: pa.RecordBatch) -> dict[str, object]:
        found, lines = [], []
        for text, members in zip(texts(batch), column(batch, "wanted"), strict=True):
            split = normalised(text).split(b"\n")
            for place in members.as_py():
                found.append(place["id"])
                lines.append(b" ".join(split[place["line_no"]].split()).decode("utf-8", "replace"))
        return {"id": found, "line": lines}

    read = named(docs).join(F.broadcast(by_text) if few else by_text, ["doc_id", "row"]).select("text", "wanted")
    return map_rows(read, "id bigint, line string", run)


def confirmed(pairs: DataFrame, lines: DataFrame, plan: LineDedup) -> DataFrame:
    """The pairs (a, b) whose whole lines are within the edit distance; ``lines`` (id, line) has those of all candidates."""
    pairs = cut_lineage(pairs.select("a", "b").distinct())
    ids = cut_lineage(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct())
    wanted = lines.join(bounded(ids), "id", "left_semi")
    both = pairs.join(wanted.select(F.col("id").alias("b"), F.col("line").alias("right")), "b").join(
        wanted.select(F.col("id").alias("a"), F.col("line").alias("left")), "a"
    )

    def near(part: pa.Table) -> pa.RecordBatch:
        left, right = (part.column(name).to_pylist() for name in ("left", "right"))
        limits = np.array([max(len(a), len(b)) * (100 - plan.percent) // 100 for a, b in zip(left, right, strict=True)], np.int64)
        kept = pa.array(all_within(left, right, limits), pa.bool_())
        return pa.RecordBatch.from_arrays([part.column(name).filter(kept).combine_chunks() for name in ("a", "b")], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for whole in batches:
            for batch in sliced(whole):
                held.append(batch)
                size += batch.nbytes
                if size >= TOGETHER_BYTES:
                    yield near(pa.Table.from_batches(held))
                    held, size = [], 0
        if held:
            yield near(pa.Table.from_batches(held))

    return both.select("a", "b", "left", "right").mapInArrow(run, "a bigint, b bigint")


def repeated_lines(docs: DataFrame, plan: LineDedup = LineDedup()) -> DataFrame:
    """(doc_id, row, dropped): the numbers of the lines to drop, for the documents that have any."""
    rows = stored(line_rows(docs, rarity(docs)), "lines")
    merged = rows.groupBy("low", "high").agg(
        F.min(F.struct("doc_id", "row", "line_no")).alias("first"),
        F.count(F.lit(1)).alias("times"),
        *(F.min(name).alias(name) for name in ("chars", "sim", "triple_sim", "by_words", "by_triples", *_WORD_BLOCKS, *_TRIPLE_BLOCKS)),
    )
    nodes = stored(merged.withColumn("id", F.monotonically_increasing_id()), "line-nodes")
    release(docs.sparkSession)
    members = block_keys(nodes, plan)
    release(docs.sparkSession)
    lines = first_lines(cut_lineage(members.select("id").distinct()), nodes, docs)
    lines = stored(lines.dropDuplicates(["id"]), "line-texts")  # a text that is there again gives its lines again
    release(docs.sparkSession)
    roots = chained_groups(members, lambda pairs: confirmed(pairs, lines, plan), may_link(plan), small=SMALL, rounds=LEADERS)
    discard(members, lines)
    grouped = nodes.select("low", "high", "id", "first", "times").join(roots.withColumnRenamed("node", "id"), "id", "left")
    leaders = grouped.where("root is not null").groupBy("root").agg(F.min("first").alias("leader"))
    repeated = grouped.where("times > 1 or root is not null").join(leaders, "root", "left")
    repeated = cut_lineage(repeated.select("low", "high", F.coalesce("leader", "first").alias("leader")))
    dropped = rows.select("doc_id", "row", "line_no", "low", "high").join(bounded(repeated), ["low", "high"])
    dropped = dropped.where(F.struct("doc_id", "row", "line_no") != F.col("leader")).distinct()
    found = cut_lineage(dropped.groupBy("doc_id", "row").agg(F.sort_array(F.collect_list("line_no")).alias("dropped")))
    discard(rows, nodes)
    release(docs.sparkSession)
    return found


def without_repeats(docs: DataFrame, plan: LineDedup = LineDedup()) -> DataFrame:
    """``docs`` with repeated lines cut out of ``text``, and n_lines and dropped (line numbers from 0) added.

    Line breaks are \\n. A null or empty text has no line to drop and stays as it is; a row without
    doc_id is left alone. Rows that repeat a doc_id with the same text keep the same lines; with
    another text they count as another document. Ties go to the smaller doc_id and line number.
    Columns named n_lines or dropped are replaced, all others pass through, whatever their names.
    """
    drops = repeated_lines(docs, plan).select(F.struct("doc_id", "row").alias("of"), "dropped")
    kept = docs.drop("n_lines", "dropped")
    whole = kept.select(F.struct(*kept.columns).alias("doc"), F.struct("doc_id", F.xxhash64("text").alias("row")).alias("of"))
    joined = whole.join(drops, "of", "left")
    text, dropped = F.col("doc.text"), F.col("dropped")
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    left = F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), dropped), lambda n: F.get(lines, n))
    cut = F.when(dropped.isNull(), text).otherwise(F.concat_ws("\n", left))
    return joined.select(
        *(cut.alias("text") if name == "text" else F.col("doc").getField(name).alias(name) for name in kept.columns),
        F.size(lines).alias("n_lines"),
        F.coalesce(dropped, F.array().cast("array<int>")).alias("dropped"),
    )
