from __future__ import annotations

import math
import random

import numpy as np

from relist.llm import line_dedup
from relist.llm.hashing import Words, mix
from relist.llm.line_dedup import NO_RARITY, Rarity, line_table, normalised, simhash_blocks, within, without_repeats, word_weights
from tests.llm.cases import edited, frame, odd_rows, prose


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(rows, percent=80):
    """Places to drop: every pair of distinct normalised lines within the edit similarity is linked, whatever its length."""
    places = {}
    for doc_id, text in sorted((r for r in rows if r[0] is not None and r[1] is not None), key=lambda r: r[0]):
        for n, line in enumerate(normalised(text).split(b"\n")):
            if line.split():
                places.setdefault(b" ".join(line.split()).decode(), set()).add((doc_id, n))
    lines = list(places)
    root = {line: line for line in lines}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(lines):
        for b in lines[:i]:
            most = max(len(a), len(b)) * (100 - percent) // 100
            if abs(len(a) - len(b)) <= most and distance(a, b) <= most:
                root[find(a)] = find(b)
    groups = {}
    for line in lines:
        groups.setdefault(find(line), set()).update(places[line])
    return {place for group in groups.values() for place in group if place != min(group)}


def rows():
    boiler = prose(50, 30)
    made = []
    for k in range(25):
        own = [prose(400 + 10 * k + n, 12 + n) for n in range(3)]
        own.insert(k % 3, boiler if k % 4 else edited(boiler, k, 1))
        if k % 5 == 0:
            own += [boiler.upper() + "!!", "short line", "short line", ""]
        made.append((k + 20, "\n".join(own)))
    return [*made, (90, made[0][1])]


def test_equals_all_pairs(spark):
    want = brute(rows())
    found = without_repeats(frame(spark, rows())).collect()
    assert len(want) > 20
    assert {(r.doc_id, n) for r in found for n in r.dropped} == want
    texts = dict(rows())
    for r in found:
        lines = texts[r.doc_id].split("\n")
        assert r.n_lines == len(lines)
        assert r.text == "\n".join(line for n, line in enumerate(lines) if n not in set(r.dropped))


def test_written_steps_are_deleted(spark, monkeypatch, tmp_path):
    monkeypatch.setattr("relist.llm.runtime.scratch_path", lambda _, name: str(tmp_path / f"{name}-{random.random()}"))
    found = without_repeats(frame(spark, rows()))
    assert list(tmp_path.iterdir()) == []
    assert {(r.doc_id, n) for r in found.collect() for n in r.dropped} == brute(rows())


def test_odd_rows_and_columns(spark):
    docs = frame(spark, odd_rows()).withColumnsRenamed({"size": "dropped", "base": "n_lines", "root": "_id", "key": "_row", "part": "of", "row": "doc"})
    found = without_repeats(docs.withColumn("_dropped", docs.doc))
    assert set(found.columns) == {*docs.columns, "_dropped"}
    kept = {(r.doc_id, r.text, r._id, r._row, r.of, r.doc, r._dropped) for r in found.collect()}
    assert kept == {(r[0], r[1], "root", "key", "part", 0.5, 0.5) for r in odd_rows()}
    assert without_repeats(frame(spark, [])).count() == 0


def test_lines_of_one_document_repeat(spark):
    line = prose(3, 10)
    found = without_repeats(frame(spark, [(5, "\n".join([line] * 4)), (4, line), (5, line)])).collect()
    assert sorted((r.doc_id, r.text, len(r.dropped)) for r in found) == [(4, line, 0), (5, "", 1), (5, "", 4)]


def test_features_follow_the_words():
    text = "Alpha beta, gamma; delta EPSILON\nalpha  beta gamma delta epsilon!\n\nfew words\n- -"
    found = line_table(text)
    assert found["line_no"].tolist() == [0, 1, 3] and found["by_words"].tolist() == [True, True, False] and found["by_triples"].all()
    for name in ("low", "high", "chars", "block0", "block4", "triple0", "triple4"):
        assert found[name][0] == found[name][1]
    assert found["chars"].tolist() == [len("alpha beta gamma delta epsilon")] * 2 + [9]
    turned = line_table("beta alpha gamma delta epsilon")
    assert turned["low"][0] != found["low"][0] and turned["block2"][0] == found["block2"][0]


def test_blocks_are_weighted_majorities():
    """Against a plain sum over words and bits."""
    text = prose(3, 40)
    words = Words(text.encode())
    (blocks,) = zip(*simhash_blocks(words, np.array([0]), np.array([len(words)]), word_weights(words, NO_RARITY)), strict=True)
    for seed, block in zip(line_dedup._SEEDS, blocks, strict=True):
        sums = np.zeros(32)
        for h, length in zip(words.hash, words.end - words.start, strict=True):
            drawn = int(mix(np.array([h ^ seed]))[0])
            weight = (min(max(length - 2, 0.2), 16) ** 2 / -math.log(((drawn >> 32) + 0.5) / 2**32)) ** 3
            sums += [weight if drawn >> bit & 1 else -weight for bit in range(32)]
        clear = np.abs(sums) > 1e-3 * np.abs(sums).max()
        assert clear.sum() > 28
        assert [(int(block) >> bit & 1) == (sums[bit] > 0) for bit in range(32) if clear[bit]] == [True] * int(clear.sum())


def test_frequent_words_weigh_less(spark):
    rows = [(k, f"common {prose(k, 6)}") for k in range(50)]
    found = line_dedup.rarity(frame(spark, rows))
    words = Words(b"common never")
    assert found.of(words.hash)[0] < 0.5 and found.of(words.hash)[1] == 1.0 and NO_RARITY.of(words.hash).tolist() == [1.0, 1.0]
    assert word_weights(words, Rarity(words.hash[:1], np.array([0.5]))).tolist() == [8.0, 9.0]


def test_edit_distance_equals_the_matrix():
    draw = random.Random(2)
    for _ in range(300):
        a = "".join(draw.choice("abcé ") for _ in range(draw.randint(0, 14)))
        b = "".join(draw.choice("abcé ") for _ in range(draw.randint(0, 14))) if draw.random() < 0.5 else a[:3] + "x" + a[5:]
        exact = distance(a, b)
        assert [within(a, b, k) for k in range(16)] == [exact <= k for k in range(16)]


def scattered(line, seed, share):
    """Some of the letters replaced at random places."""
    draw = random.Random(seed)
    letters = list(line)
    for place in draw.sample(range(len(letters)), max(1, round(len(letters) * share))):
        letters[place] = draw.choice("aeioust") if letters[place] != " " else " "
    return "".join(letters)


def test_recall_of_changed_words_and_letters(spark):
    """Links by edit distance alone, over lines of 3 to 40 words: words replaced, letters replaced, short lines."""
    lines = [prose(7000 + k, 3 + k % 38) for k in range(400)]
    kinds = {
        "words": [(k, edited(line, k, max(1, len(line.split()) // 10))) for k, line in enumerate(lines) if len(line.split()) >= 8],
        "letters": [(k, scattered(line, k, 0.02)) for k, line in enumerate(lines)],
        "short": [(k, scattered(line, 5000 + k, 0.02)) for k, line in enumerate(lines) if len(line.split()) < 8],
    }
    docs = [(k, line) for k, line in enumerate(lines)]
    docs += [(1000 * n + k, line) for n, made in enumerate(kinds.values(), 1) for k, line in made]
    near = {1000 * n + k for n, made in enumerate(kinds.values(), 1) for k, line in made if distance(line, lines[k]) <= max(len(line), len(lines[k])) // 5}
    dropped = {r.doc_id for r in without_repeats(frame(spark, docs)).collect() if r.dropped}
    for n, name in enumerate(kinds, 1):
        of = {k for k in near if k // 1000 == n}
        assert len(of) > 40
        assert len(of & dropped) >= 0.9 * len(of), name
    assert dropped <= {doc_id for doc_id, _ in brute(docs)}


def test_short_and_unspaced_lines(spark):
    draw = random.Random(4)
    passage = "".join(chr(draw.randint(0x4E00, 0x5FFF)) for _ in range(60))
    other = passage[:30] + "国" + passage[31:]
    rows = [(4, "Copyright reserved Example Corporation"), (5, "Copyright reserved, Example Corporations"), (6, "Copyright")]
    rows += [(1, f"All rights reserved.\n\nonly here\n{passage}"), (2, f"ALL rights, reserved\n\n{other}\n---\n---"), (3, f"{passage[:10]}\nall rights\n{passage}")]
    found = {r.doc_id: r.dropped for r in without_repeats(frame(spark, rows)).collect()}
    assert found == {1: [], 2: [0, 2], 3: [2], 4: [], 5: [0], 6: []}
