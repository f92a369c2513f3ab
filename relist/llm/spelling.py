"""Spelling variants: near words by a trie over letter counts, and the common form that each rare spelling goes back to.

A word is a path in a trie: its length, then how often each group of letters occurs in it, frequent
letters first. One inserted, deleted or replaced letter changes these counts by a surplus of at most
one in one group and a deficit of at most one in another. So the search walks down from the root with
a budget of one surplus and one deficit: into the child with the word's own count, or one beside it for
which it pays. What it reaches is verified letter by letter.

A pair is searched from one side only: from the shorter word, or, where the lengths are equal, from the
word of which the other differs by a surplus first; words of one leaf are compared once.

The top of the trie is spread by Spark: nodes with many words are split by the next letters until a node
is a shard of bounded size, and the walk over the split nodes is a chain of joins with the list of
nodes. Below, each shard is one task's sorted array, in which a set of words walks down together.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from relist.llm.runtime import bounded, cut_lineage, stored

#: The letters of words; all are below U+0100, so that a word has a byte per letter.
LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Groups in the order of the trie's levels; all other letters are one more group at the end.
GROUPS = "etaonisrhldcumfpgwybvkxjzq"
_GROUP = np.full(256, len(GROUPS), np.int64)
_GROUP[[ord(letter) for letter in GROUPS]] = np.arange(len(GROUPS))
#: A node with at most this many words is not split further; they are verified at once.
LEAF = 48
#: Letters compared at once, and pairs beyond which a leaf is verified by its words with a letter left out.
CELLS, PAIRS = 4_000_000, 1_000_000


@dataclass(frozen=True)
class Spelling:
    """least_points, least_times: what counts as a word; ratio: how much more often a form occurs; shard_words: most words of a node that one task takes, the plan alone depends on it; damage: one of so many occurrences loses a letter."""

    least_points: int = 7
    least_times: int = 2
    ratio: int = 10
    shard_words: int = 10_000
    damage: int = 31


def word_counts(docs: DataFrame, plan: Spelling) -> DataFrame:
    """(word, n): the damaged words of the texts that are long and frequent enough."""
    runs = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"[{LETTERS}]{{{plan.least_points},}}"), F.lit(0))
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), F.explode(runs).alias("run"))
    runs = runs.select("doc_id", F.translate("run", UPPER, LOWER).alias("run"))
    checksum = F.crc32(F.concat("doc_id", F.lit(":"), "run").cast("binary"))
    runs = runs.withColumns({"checksum": checksum, "place": (checksum % F.length("run")).cast("int")})
    cut = F.concat(F.expr("left(run, place)"), F.expr("substring(run, place + 2)"))
    words = runs.select(F.when(F.col("checksum") % plan.damage == 0, cut).otherwise(F.col("run")).alias("word"))
    counted = words.where(F.length("word") >= plan.least_points).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= plan.least_times)


def level_count(level: int) -> Column:
    """How often the letters of a level occur in ``word``; level 0 is the length."""
    if level == 0:
        return F.length("word")
    if level > len(GROUPS):
        return F.length(F.translate("word", GROUPS, ""))
    return F.length("word") - F.length(F.translate("word", GROUPS[level - 1], ""))


def trie_nodes(words: DataFrame, plan: Spelling) -> tuple[DataFrame, int]:
    """(path, split): the nodes at the top of the trie down to shards, and the deepest level at which a node is split."""
    rows = words.select("word", F.length("word").cast("string").alias("path"))
    levels = []
    for level in range(1, len(GROUPS) + 3):
        last = level == len(GROUPS) + 2
        split = F.lit(False) if last else F.col("words") > plan.shard_words
        counted = cut_lineage(rows.groupBy("path").agg(F.count(F.lit(1)).alias("words")).select("path", split.alias("split")))
        levels.append(counted)
        heavy = counted.where("split")
        if last or heavy.isEmpty():
            break
        rows = rows.join(bounded(heavy.select("path")), "path", "left_semi").withColumn("path", F.concat("path", F.lit("/"), level_count(level)))
    nodes = levels[0]
    for counted in levels[1:]:
        nodes = nodes.unionByName(counted)
    return cut_lineage(nodes), len(levels) - 1


def walks(words: DataFrame, nodes: DataFrame, depth: int) -> DataFrame:
    """(path, word, n, up, down): the shards that the walk of each word comes to, with what is left of its budget."""

    def state(path: Column, up: Column, down: Column) -> Column:
        return F.struct(path.alias("path"), up.alias("up"), down.alias("down"))

    nodes = bounded(nodes)
    yes, no = F.lit(True), F.lit(False)
    starts = F.array(state(F.length("word").cast("string"), yes, yes), state((F.length("word") + 1).cast("string"), yes, no))
    reached = words.select("word", "n", F.explode(starts).alias("s")).select("word", "n", "s.*").join(nodes, "path")
    for level in range(1, depth + 1):
        count, up, down = level_count(level), F.col("up"), F.col("down")

        def child(change: int) -> Column:
            return F.concat("path", F.lit("/"), count + change)  # noqa: B023

        children = F.array(
            state(child(0), up, down),
            F.when(up, state(child(1), no, down)),
            F.when(~up & down & (count > 0), state(child(-1), no, no)),
        )
        moves = F.when(F.col("split"), children).otherwise(F.array(state(F.col("path"), up, down)))
        reached = reached.select("word", "n", F.explode(F.filter(moves, lambda s: s.isNotNull())).alias("s"))
        reached = reached.select("word", "n", "s.*").join(nodes, "path")
    return reached.select("path", "word", "n", "up", "down")


def letter_counts(letters: np.ndarray) -> np.ndarray:
    """Counts of the groups in each row of a matrix of letters."""
    rows, groups = len(letters), len(GROUPS) + 1
    place = np.arange(rows)[:, None] * groups + _GROUP[letters]
    return np.bincount(place.ravel(), minlength=rows * groups).reshape(rows, groups)


class Shard:
    """The subtree of one node: the words in it, and those whose walk comes to it."""

    def __init__(self, length: int, words: list[bytes], up: np.ndarray, down: np.ndarray) -> None:
        size = np.array([len(word) for word in words])
        self.up, self.down = up, down
        self.same, self.shorter = np.flatnonzero(size == length), np.flatnonzero(size == length - 1)
        self.row = np.zeros(len(words), np.int64)
        self.letters, self.counts = {}, {}
        for ids, width in ((self.same, length), (self.shorter, length - 1)):
            self.row[ids] = np.arange(len(ids))
            joined = b"".join(words[k] for k in ids)
            self.letters[width] = np.frombuffer(joined, np.uint8).reshape(len(ids), width) if width else np.zeros((len(ids), 0), np.uint8)
            self.counts[width] = letter_counts(self.letters[width])
        self.length = length
        self.left: list[np.ndarray] = []
        self.right: list[np.ndarray] = []

    def search(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        """The near pairs, by index, from the trie's ``level`` on down."""
        members = self.same[self.up[self.same] & self.down[self.same]]
        counts = self.counts[self.length][self.row[members]]
        members = members[np.lexsort(counts.T[::-1])]
        visitors = self.same[~self.up[self.same]]
        self._down(level, members, (visitors, self.up[visitors], self.down[visitors]), (self.shorter, self.up[self.shorter], self.down[self.shorter]))
        if not self.left:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(self.left), np.concatenate(self.right)

    def _down(self, level: int, members: np.ndarray, *walking: tuple[np.ndarray, np.ndarray, np.ndarray]) -> None:
        """Search the sorted ``members`` of a node. ``walking``: the words of the same length, other than members, and the shorter ones, with their budgets."""
        if len(members) <= LEAF or level > len(GROUPS):
            self._verify(members, walking[0][0], walking[1][0])
            return
        own = self.counts[self.length][self.row[members], level]
        begin = np.flatnonzero(np.diff(own, prepend=-1))
        found = [(ids, up, down, self.counts[width][self.row[ids], level]) for (ids, up, down), width in zip(walking, (self.length, self.length - 1), strict=True)]
        for low, high in zip(begin, [*begin[1:], len(members)], strict=True):
            count = own[low]
            below = []
            for place, (ids, up, down, counts) in enumerate(found):
                change = count - counts
                go = (change == 0) | ((change == 1) & up) | ((change == -1) & ~up & down)
                spent = change[go]
                entering = [ids[go], up[go] & (spent == 0), down[go] & (spent != -1)]
                if place == 0:  # members of the node whose count is one less come to this child with the surplus spent
                    near = members[own == count - 1]
                    entering = [np.concatenate([entering[0], near]), np.concatenate([entering[1], np.zeros(len(near), bool)]), np.concatenate([entering[2], np.ones(len(near), bool)])]
                below.append(tuple(entering))
            self._down(level + 1, members[low:high], *below)

    def _add(self, a: np.ndarray, b: np.ndarray) -> None:
        if len(a):
            self.left.append(a)
            self.right.append(b)

    def _verify(self, members: np.ndarray, visitors: np.ndarray, shorter: np.ndarray) -> None:
        wide = self.letters[self.length][self.row[members]]
        every = np.concatenate([members, visitors])
        same = self.letters[self.length][self.row[every]]
        narrow = self.letters[self.length - 1][self.row[shorter]]
        if len(members) * (len(every) + len(shorter)) > PAIRS:
            self._verify_by_gaps(members, wide, every, same, shorter, narrow)
            return
        rows = max(1, CELLS // max(1, wide.size))
        for low in range(0, len(every), rows):
            near = (same[low : low + rows, None, :] != wide[None, :, :]).sum(axis=2) == 1
            a, b = np.nonzero(near)
            a += low
            once = (a >= len(members)) | (a < b)
            self._add(every[a[once]], members[b[once]])
        for low in range(0, len(shorter), rows):
            part = narrow[low : low + rows, None, :]
            begin = np.logical_and.accumulate(part == wide[None, :, :-1], axis=2).sum(axis=2)
            end = np.logical_and.accumulate((part == wide[None, :, 1:])[:, :, ::-1], axis=2).sum(axis=2)
            a, b = np.nonzero(begin + end >= self.length - 1)
            self._add(shorter[a + low], members[b])

    def _verify_by_gaps(self, members, wide, every, same, shorter, narrow) -> None:
        """The same pairs, in time linear in the words: equal words once one letter is left out."""
        pairs = []
        for gap in range(self.length):
            gapped = np.delete(same, gap, axis=1)
            a, b = _equal_rows(gapped, gapped[: len(members)])
            apart = (a >= len(members)) | (a < b)
            self._add(every[a[apart]], members[b[apart]])
            pairs.append(np.stack(_equal_rows(narrow, gapped[: len(members)])))
        found = np.concatenate(pairs, axis=1)
        if found.size:  # a letter left out of a run of equal ones is the same at each place
            a, b = np.unique(found, axis=1)
            self._add(shorter[a], members[b])


def _equal_rows(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of all equal rows of two matrices of one width."""
    if not len(a) or not len(b):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    _, name = np.unique(np.concatenate([a, b]), axis=0, return_inverse=True)
    name = name.ravel()
    left, right = name[: len(a)], name[len(a) :]
    order = np.argsort(right, kind="stable")
    low, high = np.searchsorted(right[order], left), np.searchsorted(right[order], left, "right")
    many = high - low
    place = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(low, many)
    return np.repeat(np.arange(len(a)), many), order[place]


def near_words(reached: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best): the near words of each word within a shard, how many, and the most frequent."""

    def run(table: pa.Table) -> pa.Table:
        path = table["path"][0].as_py()
        words = [word.encode("latin-1") for word in table["word"].to_pylist()]
        up, down = (table[name].combine_chunks().to_numpy(zero_copy_only=False).astype(bool) for name in ("up", "down"))
        n = table["n"].to_numpy()
        a, b = Shard(int(path.split("/")[0]), words, up, down).search(path.count("/"))
        order = sorted(range(len(words)), key=lambda k: (-n[k], words[k]))
        rank = np.empty(len(words), np.int64)
        rank[order] = np.arange(len(words))
        many = np.bincount(a, minlength=len(words)) + np.bincount(b, minlength=len(words))
        best = np.full(len(words), len(words), np.int64)
        np.minimum.at(best, a, rank[b])
        np.minimum.at(best, b, rank[a])
        found = np.flatnonzero(many)
        top = [order[k] for k in best[found]]
        columns = [[words[k].decode("latin-1") for k in found], many[found], n[top] if top else [], [words[k].decode("latin-1") for k in top]]
        return pa.table([pa.array(values, field.type) for values, field in zip(columns, arrow, strict=True)], schema=arrow)

    target = StructType.fromDDL("word string, n_near bigint, best_n bigint, best string")
    arrow = to_arrow_schema(target)
    return reached.groupBy("path").applyInArrow(run, target)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for the words with a form (word, form). Occurrences grow along forms, so there is no way back; each round doubles the step."""
    steps = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = cut_lineage(steps.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        steps = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return steps


def spelling_variants(docs: DataFrame, plan: Spelling = Spelling()) -> DataFrame:
    """(word, n, n_near, form, form_n, root), a row per word of the texts of ``docs`` (doc_id, text; more columns are ignored).

    Words are lower-cased in A-Z; every ``plan.damage``-th occurrence by checksum of doc_id and word
    loses a letter. A null text has no words, a null doc_id counts as an empty one, a repeated row
    counts again. The form of a word is its near word of most occurrences (ties: the smallest) if it
    has at least ``ratio`` times as many, else null; root is the last form, or the word itself.
    """
    words = stored(word_counts(docs, plan), "spelling-words")
    nodes, depth = trie_nodes(words, plan)
    near = near_words(walks(words, nodes, depth)).groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct(-F.col("best_n"), "best")).alias("top"))
    near = near.select("word", "n_near", (-F.col("top.col1")).alias("best_n"), F.col("top.best").alias("best"))
    common = F.col("best_n") >= F.col("n") * plan.ratio
    judged = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(common, F.col("best")).alias("form"), F.when(common, F.col("best_n")).alias("form_n")
    )
    judged = stored(judged, "spelling-near")
    found = roots(judged.where("form is not null"))
    return judged.join(found, "word", "left").withColumn("root", F.coalesce("root", "word"))
