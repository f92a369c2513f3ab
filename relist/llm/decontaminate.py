"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment of the words around them.

The test items are taken in blocks of bounded size, each sent to every executor and held against all
documents; a larger benchmark means more blocks, not a larger broadcast. For a block, a first pass
counts in how many documents each n-gram of the items occurs. Every stretch of ``stride`` n-grams of
an item contributes its rarest one as a seed, so each item keeps seeds all along, however often it was
copied. A second pass finds the seeds in whole texts, joins hits of one item that lie on nearby
diagonals into windows, and aligns item and window by local alignment over words. The score is the
best alignment relative to a perfect copy, so edited and partly rewritten copies still score high.
A copy also needs evidence of its own: a least number of aligned words. A long exact run of an item
counts whatever its share of the item, and an item too short for that evidence has to occur whole and
to be made of an n-gram that few documents have.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relist.llm.hashing import Words, mix, signed
from relist.llm.line_dedup import normalised
from relist.llm.runtime import column, cut_lineage, map_rows, shared, sliced, split_evenly, texts

HITS = "doc_id bigint, item_id bigint, score double, start_word int, end_word int"


@dataclass(frozen=True)
class Decontamination:
    """words: n-gram width; stride: n-grams per seed; least_score: relative alignment score that counts as a copy; block_words: test-item words per block;
    least_words: aligned words that a copy needs; least_run: words in a row that count as a copy of any item; rare_share, rare_documents: an item of fewer than ``least_words`` words counts where it is whole and its rarest n-gram is in at most that share of the documents, or in that many."""

    words: int = 3
    stride: int = 2
    least_score: float = 0.5
    match: int = 2
    mismatch: int = -1
    gap: int = 1
    block_words: int = 400_000
    least_words: int = 8
    least_run: int = 13
    rare_share: float = 0.001
    rare_documents: int = 3


def word_hashes(text: str) -> np.ndarray:
    return Words(normalised(text).replace(b"\n", b" ")).hash


def grams(words: np.ndarray, size: int) -> np.ndarray:
    """The hash of every ``size`` words in a row; a shorter sequence has one, of all its words."""
    width = min(size, len(words))
    if not width:
        return words
    total = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        total = mix(total + words[k : len(words) - width + 1 + k])
    return total


class Lookup:
    """Positions of hashes in a sorted table; a bit per hash prefix turns most others away."""

    BITS = 22

    def __init__(self, table: np.ndarray) -> None:
        self.table = table
        self.seen = np.zeros(1 << self.BITS, bool)
        self.seen[table >> np.uint64(64 - self.BITS)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in ``hashes``, places in the table) of those that are there."""
        at = np.flatnonzero(self.seen[hashes >> np.uint64(64 - self.BITS)])
        if not len(at) or not len(self.table):
            return at[:0], at[:0]
        slot = np.minimum(np.searchsorted(self.table, hashes[at]), len(self.table) - 1)
        right = self.table[slot] == hashes[at]
        return at[right], slot[right]


def align(item: np.ndarray, window: np.ndarray, plan: Decontamination) -> tuple[int, int, int]:
    """Best local alignment score, and the words of item and window up to its end. A row of the matrix is one numpy step."""
    row = np.zeros(len(window) + 1, np.int64)
    drift = np.arange(len(window) + 1) * plan.gap
    best = (0, 0, 0)
    for i, word in enumerate(item):
        step = row[:-1] + np.where(window == word, plan.match, plan.mismatch)
        open_row = np.concatenate([[0], np.maximum(np.maximum(step, row[1:] - plan.gap), 0)])
        row = np.maximum.accumulate(open_row + drift) - drift
        end = int(row.argmax())
        if row[end] > best[0]:
            best = (int(row[end]), i + 1, end)
    return best


def longest_run(item: np.ndarray, window: np.ndarray) -> int:
    """Length of the longest stretch of words in a row that item and window share."""
    row = np.zeros(len(window) + 1, np.int64)
    best = 0
    for word in item:
        row[1:] = np.where(window == word, row[:-1] + 1, 0)
        best = max(best, int(row.max()))
    return best


class Block:
    """The test items of one block: their words, and which n-gram occurs where."""

    def __init__(self, items: list[tuple[int, np.ndarray]], plan: Decontamination) -> None:
        self.plan = plan
        self.ids = [item_id for item_id, _ in items]
        self.words = [words for _, words in items]
        self.grams = [grams(words, plan.words) for words in self.words]
        self.widths = sorted({min(plan.words, len(words)) for words in self.words})
        self.table = np.unique(np.concatenate([*self.grams, np.zeros(0, np.uint64)]))

    def located(self, words: np.ndarray, lookup: Lookup) -> tuple[np.ndarray, np.ndarray]:
        """(places in the document, places in the table) of the items' n-grams, those of items shorter than an n-gram included."""
        found = [lookup.find(grams(words, width)) for width in self.widths if width <= len(words)]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, slot = (np.concatenate(x) for x in zip(*found, strict=True))
        return at, slot

    def seeded(self, documents: np.ndarray, total: int) -> Block:
        """Choose the seeds by the number of documents of each n-gram of ``table``, of ``total`` in all."""
        gram, item, place = [], [], []
        most = max(self.plan.rare_documents, self.plan.rare_share * total)
        self.rare = np.array([documents[np.searchsorted(self.table, own)].min() <= most for own in self.grams], bool)
        for n, own in enumerate(self.grams):
            count = documents[np.searchsorted(self.table, own)]
            for k in range(0, len(own), self.plan.stride):
                rarest = k + int(count[k : k + self.plan.stride].argmin())
                gram.append(own[rarest])
                item.append(n)
                place.append(rarest)
        order = np.argsort(np.array(gram, np.uint64), kind="stable")
        self.seed = np.array(gram, np.uint64)[order]
        self.seed_item = np.array(item, np.int64)[order]
        self.seed_place = np.array(place, np.int64)[order]
        return self

    def matches(self, words: np.ndarray, lookup: Lookup) -> Iterator[tuple[int, float, int, int]]:
        """(item, score, first word, end word) of the best copy of each item in a document."""
        at, slot = self.located(words, lookup)
        if not len(at):
            return
        low = np.searchsorted(self.seed, lookup.table[slot], "left")
        many = np.searchsorted(self.seed, lookup.table[slot], "right") - low
        entry = np.repeat(low - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
        item, diagonal = self.seed_item[entry], np.repeat(at, many) - self.seed_place[entry]
        order = np.lexsort((diagonal, item))
        item, diagonal = item[order], diagonal[order]
        lengths = np.array([len(w) for w in self.words])
        slack = lengths[item] // 4 + 4
        fresh = np.flatnonzero((np.diff(item, prepend=-1) != 0) | (np.diff(diagonal, prepend=diagonal[0]) > slack))
        best: dict[int, tuple[float, int, int]] = {}
        for first, end in zip(fresh, np.append(fresh[1:], len(item)), strict=True):
            n = int(item[first])
            start = max(0, int(diagonal[first] - slack[first]))
            window = words[start : int(diagonal[end - 1] + lengths[n] + slack[first])]
            short = lengths[n] < self.plan.least_words
            if short and not self.rare[n]:
                continue
            run = self.plan.least_run * self.plan.match
            least = self.plan.match * (lengths[n] if short else max(self.plan.least_score * lengths[n], self.plan.least_words))
            if np.isin(window, self.words[n]).sum() * self.plan.match < min(least, run):
                continue
            score, item_end, window_end = align(self.words[n], window, self.plan)
            if score <= best.get(n, (0, 0, 0))[0]:
                continue
            if score >= least or (score >= run and longest_run(self.words[n], window) >= self.plan.least_run):
                _, _, back = align(self.words[n][:item_end][::-1], window[:window_end][::-1], self.plan)
                best[n] = (score, start + window_end - back, start + window_end)
        for n, (score, first, end) in best.items():
            yield n, score / (self.plan.match * lengths[n]), first, end


def item_blocks(items: DataFrame, plan: Decontamination) -> Iterator[Block]:
    """The items with words, in blocks of about ``block_words`` words chosen by hash."""

    def run(batch: pa.RecordBatch) -> dict[str, object]:
        return {"item_id": column(batch, "item_id"), "words": [signed(word_hashes(text)) for text in texts(batch)]}

    hashed = map_rows(items.select("item_id", "text").where("item_id is not null"), "item_id bigint, words array<bigint>", run)
    hashed = cut_lineage(hashed.where("size(words) > 0"))
    total = hashed.agg(F.sum(F.size("words"))).first()[0] or 0
    blocks = -(-total // plan.block_words)
    for n in range(blocks):
        rows = hashed.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == n).orderBy("item_id").collect()
        if rows:
            yield Block([(r.item_id, np.array(r.words, np.int64).view(np.uint64)) for r in rows], plan)


def gram_documents(docs: DataFrame, block: Block) -> tuple[np.ndarray, int]:
    """In how many documents each n-gram of the block occurs, and of how many; each task sends a count per n-gram and one more at most."""
    sent = shared(docs.sparkSession, block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(sent.value.table)
        counts = np.zeros(len(lookup.table) + 1, np.int64)
        for batch in batches:
            counts[-1] += batch.num_rows
            for text in texts(batch):
                counts[np.unique(sent.value.located(word_hashes(text), lookup)[1])] += 1
        slots = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(counts[slots])], ["slot", "documents"])

    totals = np.zeros(len(block.table) + 1, np.int64)
    for row in docs.select("text").mapInArrow(run, "slot bigint, documents bigint").groupBy("slot").agg(F.sum("documents")).collect():
        totals[row[0]] = row[1]
    return totals[:-1], int(totals[-1])


def contaminated(docs: DataFrame, items: DataFrame, plan: Decontamination = Decontamination()) -> DataFrame:
    """(doc_id, item_id, score, start_word, end_word) of each document that holds a copy of a test item.

    ``docs`` has doc_id and text, ``items`` item_id and text; more columns are ignored. Null and empty
    texts match nothing, nor do items without id. Items of fewer than ``least_words`` words are sought whole. A
    repeated row gives repeated results; of several copies in one text the first best one is given.
    """
    source = split_evenly(docs.select("doc_id", "text"))
    found = source.sparkSession.createDataFrame([], HITS)
    for block in item_blocks(items, plan):
        sent = shared(source.sparkSession, block.seeded(*gram_documents(source, block)))

        def run(batch: pa.RecordBatch, sent=sent) -> dict[str, object]:
            own = sent.value
            if not hasattr(own, "lookup"):
                own.lookup = Lookup(np.unique(own.seed))
            rows = [
                (doc_id, own.ids[n], score, first, end)
                for doc_id, text in zip(column(batch, "doc_id").to_pylist(), texts(batch), strict=True)
                for n, score, first, end in own.matches(word_hashes(text), own.lookup)
            ]
            return dict(zip(("doc_id", "item_id", "score", "start_word", "end_word"), zip(*rows, strict=True) if rows else ([],) * 5, strict=True))

        found = found.unionByName(map_rows(source, HITS, run))
    return found


def without_copies(docs: DataFrame, items: DataFrame, plan: Decontamination = Decontamination()) -> DataFrame:
    """The rows of ``docs`` that hold no copy of a test item, all columns as they are; each row is judged by its own text, no join.

    Null and empty texts stay, and so does all where there are no items. Rows without doc_id or with a repeated one are judged like any other.
    """
    kept = split_evenly(docs)
    for block in item_blocks(items, plan):
        sent = shared(docs.sparkSession, block.seeded(*gram_documents(docs, block)))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            own = sent.value
            lookup = Lookup(np.unique(own.seed))
            for whole in batches:
                for batch in sliced(whole):
                    clean = [next(own.matches(word_hashes(text), lookup), None) is None for text in texts(batch)]
                    yield batch.filter(pa.array(clean, pa.bool_()))

        kept = kept.mapInArrow(run, docs.schema)
    return kept
