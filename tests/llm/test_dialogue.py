from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import pytest

from relist.llm.dialogue import END, FAR, Repair, before, checkpoints, closing, code, damaged, repaired_conversations, walk

SCHEMA = "conv_id bigint, turn bigint, role string, text string, part int, place string, code double, key string, letters string"
SPACES = " \t\n\x0b\x0c\r"


def frame(spark, rows):
    return spark.createDataFrame([(*row, 1, "x", 0.5, "key", "letters") for row in rows], SCHEMA)


def best(rows, state, place=0, inserted=0, memo=None):
    """Least (cost, audit, repaired rows) over every sequence of edits, at most two insertions in a row."""
    memo = {} if memo is None else memo
    key = (state, place, inserted)
    if key in memo:
        return memo[key]
    found = []
    if place == len(rows) and state in ("", "a"):
        found.append((0, "", ()))
    fits = "a" if state == "u" else "u"
    named = {"u": "user", "a": "assistant"}
    if inserted < 2:
        cost, audit, told = best(rows, fits, place, inserted + 1, memo)
        found.append((5 + cost, "I" + audit, (f"{named[fits]}:", *told)))
    if place < len(rows):
        role, text, fault = rows[place]
        cost, audit, told = best(rows, state, place + 1, 0, memo)
        found.append((2 + cost, "D" + audit, told))
        if fault not in ("blank", "duplicate"):
            loss = 5 if fault == "truncated" else 0
            if role[:1] == fits or (role[:1] == "s" and state == ""):
                cost, audit, told = best(rows, role[:1], place + 1, 0, memo)
                found.append((loss + cost, "K" + audit, (f"{role}:{text}", *told)))
            for to in "ua":
                if to == fits:
                    cost, audit, told = best(rows, to, place + 1, 0, memo)
                    found.append((1 + loss + cost, "R" + audit, (f"{named[to]}:{text}", *told)))
    memo[key] = min(found) if found else (10**9, "", ())
    return memo[key]


def brute(rows):
    """The result of one conversation of (turn, role, text) rows in order."""
    judged, seen, faults = [], set(), Counter()
    for _, role, text in rows:
        stripped = text.strip(SPACES)
        fault = "blank" if not stripped else "duplicate" if (role, text) in seen else "truncated" if stripped[-1] not in ".!?" else ""
        seen.add((role, text))
        faults[fault] += 1
        judged.append((role, text, fault))
    turns = [turn for turn, _, _ in rows if turn is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    memo = {}
    for place in range(len(judged), -1, -1):  # from the end, so that the recursion stays flat
        for state in ("", "s", "u", "a"):
            best(judged, state, place, 0, memo)
    cost, audit, told = memo["", 0, 0]
    return gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(told).encode()).hexdigest()


def conversations(rows):
    """Rows by conversation, in order."""
    found = {}
    for conv_id, turn, role, text in rows:
        found.setdefault(conv_id, []).append((turn, " " if role is None else role, " " if text is None else text))
    order = lambda row: (row[0] is not None, row[0] or 0, row[1].encode(), row[2].encode())
    return {conv_id: sorted(rows, key=order) for conv_id, rows in found.items()}


def drawn(seed, many, longest):
    draw = random.Random(seed)
    texts = ["a.", "b.", "c", "", " \n ", "d!", "é?", "x. ", None, "q ", "one\ntwo."]
    roles = ["user", "assistant", "system", "tool", "", None, "user", "assistant"]
    rows = []
    for conv_id in range(many):
        for _ in range(draw.randint(1, longest)):
            rows.append((conv_id if conv_id else None, draw.choice([None, *range(8)]), draw.choice(roles), draw.choice(texts)))
    return rows


def collected(found):
    return {row[0]: tuple(row)[1:] for row in found.collect()}


def test_equals_all_sequences_of_edits(spark):
    rows = drawn(1, 150, 7) + [(500, 1, "user", "Hello."), (500, 2, "assistant", "long " * 40_000 + ".")]
    want = {conv_id: brute(rows) for conv_id, rows in conversations(rows).items()}
    assert collected(repaired_conversations(frame(spark, rows))) == want


@pytest.mark.parametrize("plan", [Repair(held_rows=2), Repair(held_chars=5)])
def test_split_conversations_lead_to_the_same_result(spark, plan):
    draw = random.Random(3)
    rows = drawn(2, 30, 9)
    roles = ["user", "assistant", "assistant", "system"]
    rows += [(99, turn // 3, draw.choice(roles), draw.choice(["", "cut off", "Fine.", f"{draw.randint(0, 200)}."])) for turn in range(900)]
    rows += [(77, None, "user", "same.")] * 40 + [(77, None, "assistant", "")] * 40 + [(77, 3, "assistant", "other.")]
    found = repaired_conversations(frame(spark, rows), plan=plan)
    want = {conv_id: brute(rows) for conv_id, rows in conversations(rows).items()}
    assert collected(found) == want


def test_vectors_at_checkpoints_alone():
    draw = random.Random(5)
    codes = [code(draw.randrange(4), draw.randrange(4), draw.choice([1, 1, 1, 3])) for _ in range(1000)]
    step, held = checkpoints(codes, END)
    assert step == 32 and len(held) == 33
    vector = END
    for packed in reversed(codes):
        vector = before(packed, vector)
    assert held[0] == vector
    letters, state = walk(codes, END, 0)
    assert len((letters + closing(state)).replace("I", "")) == sum(packed >> 4 for packed in codes)


def test_matrices_of_parts_compose():
    draw = random.Random(6)
    codes = [code(draw.randrange(4), draw.randrange(4), 1) for _ in range(40)]

    def over(part, vector):
        for packed in reversed(part):
            vector = before(packed, vector)
        return vector

    unit = [[0 if k == n else FAR for k in range(4)] for n in range(4)]
    matrix = [over(codes[:17], row) for row in unit]
    behind = over(codes[17:], END)
    assert [min(matrix[to][state] + behind[to] for to in range(4)) for state in range(4)] == over(codes, END)


def test_damage_and_conversations_without_rows(spark):
    rows = [(conv_id, turn, role, "Said this. And that!") for conv_id in range(40) for turn, role in enumerate(["system", "user", "assistant"])]
    rows += [(None, None, None, None), (50, 0, "user", "One?")]
    hurt = []
    for conv_id, turn, role, text in rows:
        role, text = (" " if value is None else value for value in (role, text))
        name = ":".join(" " if value is None else str(value) for value in (conv_id, turn))
        kind = zlib.crc32(name.encode()) % 20
        text = "" if kind == 1 else text.translate(str.maketrans("", "", ".!?")) if kind == 2 else text
        hurt += [(conv_id, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    assert Counter(map(tuple, damaged(frame(spark, rows)).collect())) == Counter(hurt)
    names = spark.createDataFrame([(row[0],) for row in rows] + [(1000,)], "conv_id bigint")
    want = {conv_id: brute(rows) for conv_id, rows in conversations(hurt).items()}
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    found = repaired_conversations(damaged(frame(spark, rows)), names)
    assert collected(found) == {row[0]: want.get(row[0], empty) for row in names.collect()}
    assert found.count() == 43


def test_empty_table(spark):
    assert repaired_conversations(frame(spark, [])).count() == 0
    assert repaired_conversations(frame(spark, []), frame(spark, [])).count() == 0
