"""Conversation structure repair: the cheapest edits that make a conversation `(s?(ua)+)?`, by checkpointed dynamic programming.

The states of a walk over the rows are START, SYSTEM, USER and ASSISTANT: what was emitted last. An
edit keeps a row, gives it the role that fits, deletes it, or inserts a row with no text before it.
The backward pass computes, for each state, the least cost of all that follows. Only its vectors at
every square-rootth row are held; the forward walk computes those of one block again at a time and
follows, among the edits that reach the least cost, the one whose letter comes first.

Rows are put in order by one range sort. A conversation that lies within a range and is short is
repaired as it passes by. What touches the border of a range or is long is left as rows: a segment
(the part of a conversation in one range) has a 4 x 4 matrix of least costs, the matrices of a
conversation give the vector behind each segment, and each segment is walked from all four
states at once, of which the walk of the segment before picks one. So no conversation is held by
one task, whatever its share of the rows; only its digest, which is sequential, reads it as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from relist.llm.runtime import stored

START, SYSTEM, USER, ASSISTANT = range(4)
FINE, TRUNCATED, BLANK, DUPLICATE = range(4)
Vector = list[int]
#: Cost and state change of a walk.
DELETE, INSERT, REROLE, LOSS = 2, 5, 1, 5
FAR = 1 << 60
#: What is still to pay behind the last row.
END = [0, 2 * INSERT, INSERT, 0]
#: White space of the data: what a blank text consists of.
SPACE = " \t\n\x0b\x0c\r"
_RANK = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
_NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_NAME = {USER: "user", ASSISTANT: "assistant"}


@dataclass(frozen=True)
class Repair:
    """held_rows, held_chars: a conversation beyond either is not held by one task but split into segments; the result is the same."""

    held_rows: int = 4096
    held_chars: int = 4_000_000


def entered(state: int, rank: int) -> int | None:
    """The state after a row of role ``rank`` is kept, or None where it may not stand."""
    if rank == SYSTEM:
        return SYSTEM if state == START else None
    return rank if rank and _NEXT[state] == rank else None


def code(rank: int, fault: int, copies: int) -> int:
    """A row in one number: its role, its fault and how many equal rows in sequence it stands for."""
    return rank | fault << 2 | copies << 4


def before(packed: int, after: Vector) -> Vector:
    """The vector in front of a row, from the one behind it. Copies of a row are deleted one by one."""
    rank, fault, copies = packed & 3, packed >> 2 & 3, packed >> 4
    found = [DELETE + cost for cost in after]
    if fault <= TRUNCATED:
        loss = LOSS if fault else 0
        for state in range(4):
            to = entered(state, rank)
            if to is not None:
                found[state] = min(found[state], loss + after[to])
            found[state] = min(found[state], REROLE + loss + after[_NEXT[state]])
    found = [min(cost + DELETE * (copies - 1), FAR) for cost in found]
    found[USER], found[ASSISTANT] = min(found[USER], INSERT + found[ASSISTANT]), min(found[ASSISTANT], INSERT + found[USER])
    return [min(found[START], INSERT + found[USER]), min(found[SYSTEM], INSERT + found[USER]), found[USER], found[ASSISTANT]]


def checkpoints(codes: list[int], end: Vector) -> tuple[int, dict[int, Vector]]:
    """Length of a block, and the vector in front of every block and behind the last one."""
    step = isqrt(len(codes)) + 1
    vector, held = end, {len(codes): end}
    for place in range(len(codes) - 1, -1, -1):
        vector = before(codes[place], vector)
        if place % step == 0:
            held[place] = vector
    return step, held


def walk(codes: list[int], end: Vector, state: int) -> tuple[str, int]:
    """The letters of the ASCII-least tight edits from ``state`` on, and the state they lead to.

    A letter per row (a copy is a row) and one per insertion, before the row in front of which it stands.
    """
    step, held = checkpoints(codes, end)
    letters: list[str] = []
    for low in range(0, len(codes), step):
        high = min(low + step, len(codes))
        vectors = [held[high]]
        for place in range(high - 1, low - 1, -1):
            vectors.append(before(codes[place], vectors[-1]))
        vectors.reverse()
        for place in range(low, high):
            here, after = vectors[place - low], vectors[place - low + 1]
            state = _one_row(codes[place], here, after, state, letters)
    return "".join(letters), state


def _one_row(packed: int, here: Vector, after: Vector, state: int, letters: list[str]) -> int:
    rank, fault, copies = packed & 3, packed >> 2 & 3, packed >> 4
    more = DELETE * (copies - 1)
    loss = LOSS if fault else 0
    while True:
        if here[state] == DELETE + more + after[state]:
            letters.append("D" * copies)
            return state
        to = _NEXT[state]
        if here[state] == INSERT + here[to]:
            letters.append("I")
            state = to
            continue
        kept = entered(state, rank)
        if kept is not None and here[state] == loss + more + after[kept]:
            letters.append("K" + "D" * (copies - 1))
            return kept
        letters.append("R" + "D" * (copies - 1))
        return to


def closing(state: int) -> str:
    """The letters behind the last row."""
    return "I" * (END[state] // INSERT)


def fault_of(text: str) -> int:
    """The fault that a text has of itself."""
    stripped = text.rstrip(SPACE)
    return BLANK if not stripped else FINE if stripped[-1] in ".!?" else TRUNCATED


class Report:
    """Counts and digest of a conversation whose rows come in order, in memory that does not grow with the texts."""

    def __init__(self) -> None:
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self.low: int | None = None
        self.high: int | None = None
        self.initial: str | None = None
        self.state = START
        self.digest, self.empty = hashlib.sha256(), True
        self.audit: list[str] = []

    def row(self, turn: int | None, role: str, text: str, fault: int, copies: int) -> None:
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.turns += 1
        initial = role[:1]
        self.illegal += copies - 1 + (self.initial is not None and self.initial + initial not in ("su", "ua", "au"))
        self.initial = initial
        self.blank += copies if fault == BLANK else 0
        self.duplicate += copies - (fault != DUPLICATE) if fault != BLANK else 0
        self.truncated += fault == TRUNCATED

    def edits(self, letters: str, role: str = "", text: str = "", fault: int = FINE) -> None:
        """Apply the letters up to and including those of one row (or the closing ones)."""
        self.audit.append(letters)
        for letter in letters:
            if letter == "D":
                self.cost += DELETE
                continue
            if letter == "I":
                self.state = _NEXT[self.state]
                self.cost += INSERT
                self._emit(_NAME[self.state], "")
                continue
            self.cost += LOSS if fault == TRUNCATED else 0
            if letter == "K":
                self.state = _RANK[role[:1]]
            else:
                self.cost += REROLE
                self.state = _NEXT[self.state]
                role = _NAME[self.state]
            self._emit(role, text)

    def _emit(self, role: str, text: str) -> None:
        self.digest.update(f"{'' if self.empty else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
        self.empty = False

    def result(self) -> tuple[object, ...]:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest()


RESULT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
_RESULT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def letters_of(letters: str, copies: int, place: int) -> int:
    """End of the letters of the row whose letters begin at ``place``: insertions, its own letter, and one for each further copy."""
    while letters[place] == "I":
        place += 1
    return place + copies


def repaired(rows: list[tuple]) -> tuple[object, ...]:
    """``RESULT`` of a whole conversation: (turn, role, text, copies) rows in order."""
    seen: set[tuple[str, str]] = set()
    faults = []
    for _, role, text, _ in rows:
        fault = fault_of(text)
        if fault != BLANK and (role, text) in seen:
            fault = DUPLICATE
        seen.add((role, text))
        faults.append(fault)
    codes = [code(_RANK.get(role[:1], 0), fault, copies) for (_, role, _, copies), fault in zip(rows, faults, strict=True)]
    letters, state = walk(codes, END, START)
    report, place = Report(), 0
    for (turn, role, text, copies), fault in zip(rows, faults, strict=True):
        report.row(turn, role, text, fault, copies)
        until = letters_of(letters, copies, place)
        report.edits(letters[place:until], role, text, fault)
        place = until
    report.edits(closing(state))
    return report.result()


_ROW = "conv_id bigint, turn bigint, role string, text string, copies bigint, part int, place bigint, whole boolean"


def _streamed(plan: Repair):
    """Repair the short conversations inside a range; pass the rows of all others on with their place."""
    arrow = to_arrow_schema(StructType.fromDDL(f"{_ROW}, {RESULT}"))
    names = arrow.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        out: list[dict] = []
        held: list[tuple] = []
        chars = place = 0
        current: tuple | None = None  # a conversation, as a tuple so that a null id is one too
        passing = True  # the first conversation of a range may have begun in the one before

        def emitted() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_pylist([{name: row.get(name) for name in names} for row in out], schema=arrow)
            out.clear()
            return batch

        def passed(rows: list[tuple]) -> None:
            nonlocal place
            for turn, role, text, copies in rows:
                out.append({"conv_id": current[0], "turn": turn, "role": role, "text": text, "copies": copies, "part": part, "place": place, "whole": False})
                place += 1

        size = 0
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                for row in zip(*(batch.slice(low, 256).column(n).to_pylist() for n in range(5)), strict=True):
                    conversation, rest = row[:1], row[1:]
                    if conversation != current:
                        if current is not None and not passing:
                            out.append({"conv_id": current[0], "whole": True, **dict(zip(_RESULT, repaired(held), strict=True))})
                        passing, held, chars = current is None, [], 0
                        current = conversation
                    size += len(rest[2])
                    if passing:
                        passed([rest])
                    else:
                        held.append(rest)
                        chars += len(rest[2])
                        if len(held) > plan.held_rows or chars > plan.held_chars:
                            passed(held)
                            passing, held = True, []
                    if size > plan.held_chars or len(out) > 10_000:
                        yield emitted()
                        size = 0
        passed(held)  # the last conversation may go on in the next range
        if out:
            yield emitted()

    return run


def _segments(rows: DataFrame) -> DataFrame:
    """(conv_id, part, codes, matrix): a segment's rows in order as numbers, and its least costs from each state to each state."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        codes = table["code"].to_pylist()
        columns = []
        for state in range(4):
            vector = [FAR] * 4
            vector[state] = 0
            for packed in reversed(codes):
                vector = before(packed, vector)
            columns.append(vector)
        matrix = [columns[to][state] for state in range(4) for to in range(4)]
        return pa.table({"conv_id": table["conv_id"][:1], "part": table["part"][:1], "codes": [codes], "matrix": [matrix]}, schema=arrow)

    target = StructType.fromDDL("conv_id bigint, part int, codes array<bigint>, matrix array<bigint>")
    arrow = to_arrow_schema(target)
    return rows.groupBy("conv_id", "part").applyInArrow(run, target)


def _ends(segments: DataFrame) -> DataFrame:
    """(conv_id, part, behind): the vector behind each segment, from the matrices of the segments that follow."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("part", "descending")])
        vector, found = END, []
        for matrix in table["matrix"].to_pylist():
            found.append(vector)
            vector = [min(min(matrix[4 * state + to] + vector[to] for to in range(4)), FAR) for state in range(4)]
        return pa.table({"conv_id": table["conv_id"], "part": table["part"], "behind": found}, schema=arrow)

    target = StructType.fromDDL("conv_id bigint, part int, behind array<bigint>")
    arrow = to_arrow_schema(target)
    return segments.select("conv_id", "part", "matrix").groupBy("conv_id").applyInArrow(run, target)


def _walked(segments: DataFrame) -> DataFrame:
    """(conv_id, part, exits, letters): where the walk from each state leads and by which edits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in range(batch.num_rows):
                row = batch.slice(place, 1).to_pylist()[0]
                walks = [walk(row["codes"], row["behind"], state) for state in range(4)]
                one = {"conv_id": row["conv_id"], "part": row["part"], "exits": [state for _, state in walks], "letters": [letters for letters, _ in walks]}
                yield pa.RecordBatch.from_pylist([one], schema=arrow)

    target = StructType.fromDDL("conv_id bigint, part int, exits array<int>, letters array<string>")
    arrow = to_arrow_schema(target)
    return segments.mapInArrow(run, target)


def _entries(walked: DataFrame) -> DataFrame:
    """(conv_id, part, entry): the state in which the walk comes to each segment."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        state, found = START, []
        for exits in table["exits"].to_pylist():
            found.append(state)
            state = exits[state]
        return pa.table({"conv_id": table["conv_id"], "part": table["part"], "entry": found}, schema=arrow)

    target = StructType.fromDDL("conv_id bigint, part int, entry int")
    arrow = to_arrow_schema(target)
    return walked.select("conv_id", "part", "exits").groupBy("conv_id").applyInArrow(run, target)


def _reported(ordered: DataFrame) -> DataFrame:
    """Counts and digests of conversations whose rows come in order, the letters of a segment with its first row."""
    target = StructType.fromDDL(f"conv_id bigint, {RESULT}")
    arrow = to_arrow_schema(target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, report, letters, place = None, Report(), "", 0

        def closed() -> pa.RecordBatch:
            report.edits(closing(report.state))
            return pa.RecordBatch.from_pylist([{"conv_id": current[0], **dict(zip(_RESULT, report.result(), strict=True))}], schema=arrow)

        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                for row in batch.slice(low, 256).to_pylist():
                    if (row["conv_id"],) != current:
                        if current is not None:
                            yield closed()
                        current, report = (row["conv_id"],), Report()
                    if row["letters"] is not None:
                        letters, place = row["letters"], 0
                    report.row(row["turn"], row["role"], row["text"], row["fault"], row["copies"])
                    until = letters_of(letters, row["copies"], place)
                    report.edits(letters[place:until], row["role"], row["text"], row["fault"])
                    place = until
        if current is not None:
            yield closed()

    return ordered.mapInArrow(run, target)


def _split(rows: DataFrame) -> DataFrame:
    """``RESULT`` of the conversations whose rows are spread over ranges or too long for one task."""
    stripped = F.rtrim("text", F.lit(SPACE))
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    own = F.when(stripped == "", BLANK).when(F.right(stripped, F.lit(1)).isin(".", "!", "?"), FINE).otherwise(TRUNCATED)
    rows = rows.withColumns({"own": own, "said": said})
    key = F.coalesce(F.col("conv_id").cast("string"), F.lit(""))
    rows = rows.withColumn("key", key)
    firsts = rows.where(F.col("own") != BLANK).groupBy("key", "said").agg(F.min(F.struct("part", "place")).alias("first"), F.count(F.lit(1)).alias("times"))
    judged = rows.join(firsts.where("times > 1").drop("times"), ["key", "said"], "left")
    again = (F.col("own") != BLANK) & F.coalesce(F.struct("part", "place") > F.col("first"), F.lit(False))
    judged = judged.withColumn("fault", F.when(again, DUPLICATE).otherwise(F.col("own")))
    rank = F.coalesce(*(F.when(F.substring("role", 1, 1) == letter, value) for letter, value in _RANK.items()), F.lit(0))
    packed = (rank + F.col("fault") * 4).cast("bigint") + F.col("copies") * 16
    judged = stored(judged.select("key", "conv_id", "turn", "role", "text", "copies", "part", "place", "fault", packed.alias("code")), "dialogue-rows")
    segments = stored(_segments(judged.select("conv_id", "part", "place", "code")), "dialogue-segments")

    def match(name: str) -> list:
        return [F.col("a.conv_id").eqNullSafe(F.col(f"{name}.conv_id")), F.col("a.part") == F.col(f"{name}.part")]

    walked = segments.alias("a").join(_ends(segments).alias("e"), match("e")).select("a.conv_id", "a.part", "a.codes", "e.behind")
    walked = stored(_walked(walked), "dialogue-walks")
    chosen = walked.alias("a").join(_entries(walked).alias("e"), match("e")).select("a.conv_id", "a.part", F.get("a.letters", F.col("e.entry")).alias("letters"))
    begun = judged.groupBy("conv_id", "part").agg(F.min("place").alias("place"))
    begun = begun.alias("a").join(chosen.alias("c"), match("c")).select("a.conv_id", "a.part", "a.place", "c.letters")
    told = judged.alias("a").join(begun.alias("b"), [*match("b"), F.col("a.place") == F.col("b.place")], "left")
    told = told.select("a.conv_id", "a.turn", "a.role", "a.text", "a.copies", "a.part", "a.place", "a.fault", "b.letters")
    return _reported(told.repartition("conv_id").sortWithinPartitions("conv_id", "part", "place").drop("part", "place"))


def repaired_conversations(turns: DataFrame, names: DataFrame | None = None, plan: Repair = Repair()) -> DataFrame:
    """Faults, cheapest edits and digest of every conversation of ``turns`` (conv_id, turn, role, text; more columns are ignored).

    A null role or text counts as one space; rows without conv_id are one conversation. Rows go by
    turn, nulls first; ties by role and text, so that equal rows stand side by side, and their order
    does not matter. An empty text is blank. ``names`` (conv_id) may list conversations that
    have no row left: they come with zeros, an empty audit and the digest of an empty text.
    """
    turns = turns.select("conv_id", "turn", *(F.coalesce(name, F.lit(" ")).alias(name) for name in ("role", "text")))
    folded = turns.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    order = ["conv_id", "turn", "role", "text"]
    ranged = folded.repartitionByRange(*order).sortWithinPartitions(*order)
    streamed = stored(ranged.mapInArrow(_streamed(plan), f"{_ROW}, {RESULT}"), "dialogue")
    rows = streamed.where("not whole").select("conv_id", "turn", "role", "text", "copies", "part", "place")
    found = streamed.where("whole").select("conv_id", *_RESULT).unionByName(_split(rows))
    if names is None:
        return found
    empty = [F.lit(""), F.lit(hashlib.sha256(b"").hexdigest())]
    blanks = [F.lit(0).cast("bigint")] * 6 + empty
    joined = names.select("conv_id").distinct().alias("n").join(found.alias("f"), F.col("n.conv_id").eqNullSafe(F.col("f.conv_id")), "left")
    return joined.select("n.conv_id", *(F.coalesce(f"f.{name}", blank).alias(name) for name, blank in zip(_RESULT, blanks, strict=True)))


def damaged(conversations: DataFrame) -> DataFrame:
    """The conversations with a fifth of their rows dropped, emptied, cut, repeated or given to the user, by a checksum of their key."""
    named = [F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn")]
    kind = F.crc32(F.concat(named[0], F.lit(":"), named[1]).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", *(F.coalesce(name, F.lit(" ")).alias(name) for name in ("role", "text")), kind.alias("kind"))
    rows = rows.where("kind <> 0").withColumns(
        {
            "text": F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")),
            "role": F.when(F.col("kind") == 4, "user").otherwise(F.col("role")),
            "times": F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))),
        }
    )
    return rows.select("conv_id", "turn", "role", "text")
