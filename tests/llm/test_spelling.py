from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import relist.llm.spelling as spelling
from relist.llm.spelling import Shard, Spelling, spelling_variants
from tests.llm.cases import frame, odd_rows


def words_of(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            checksum = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            at = checksum % len(run)
            counts[run[:at] + run[at + 1 :] if checksum % 31 == 0 else run] += 1
    return {word: n for word, n in counts.items() if len(word) >= 7 and n >= 2}


def near(a, b):
    """Whether one inserted, deleted or replaced letter makes one word the other."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(rows):
    words = words_of(rows)
    judged = {}
    for word, n in words.items():
        others = [other for other in words if other != word and near(word, other)]
        form = min(others, key=lambda o: (-words[o], o), default=None)
        form = form if form is not None and words[form] >= 10 * n else None
        judged[word] = (n, len(others), form, words.get(form))

    def root(word):
        return word if judged[word][2] is None else root(judged[word][2])

    return {word: (*found, root(word)) for word, found in judged.items()}


def text_rows(seed, many):
    """Few letters, so that many words are near, with the same letters in another order, and of very different frequency."""
    draw = random.Random(seed)
    vocabulary = ["".join(draw.choice("aabenéÉÿ") for _ in range(draw.randint(6, 9))) for _ in range(many)]
    vocabulary += [word[:k] + draw.choice("abn") + word[k + 1 :] for word in vocabulary for k in (0, 3)]
    vocabulary += ["Tomorrow", "tomorow", "tommorow", "tomorrrow", "Straße", "Straßen", "xxxxxxxx", "xxxxxxxxx", "a×b÷cdefg"]
    rows = []
    for doc_id in range(60):
        rows.append((doc_id, ", ".join(draw.choice(vocabulary[: draw.choice([3, 30, len(vocabulary)])]) for _ in range(80))))
    return rows + [(1000 + k, "tomorrow " * 30 + "tomorow " * (k % 3)) for k in range(20)]


def found(frame_):
    return {row.word: (row.n, row.n_near, row.form, row.form_n, row.root) for row in frame_.select("word", "n", "n_near", "form", "form_n", "root").collect()}


@pytest.mark.parametrize(("shard", "leaf", "pairs"), [(10_000, 48, 1_000_000), (40, 4, 1_000_000), (3, 2, 0)])
def test_equals_all_pairs(spark, monkeypatch, shard, leaf, pairs):
    for name, value in {"LEAF": leaf, "PAIRS": pairs}.items():
        monkeypatch.setattr(spelling, name, value)
    rows = text_rows(1, 250) + odd_rows()
    assert found(spelling_variants(frame(spark, rows), Spelling(shard_words=shard))) == brute(rows)


def test_shards_in_this_process(monkeypatch):
    """The walk below the shards, with leaves of one word and with the leaves verified by gaps."""
    draw = random.Random(4)
    words = sorted({"".join(draw.choice("abcé") for _ in range(7)) for _ in range(700)} | {"abcabc" + c for c in "abcé"} | {"aaaaaa", "bbbbbb", "abcabc"})
    data = [word.encode("latin-1") for word in words]
    on = np.ones(len(words), bool)
    shorter = np.array([len(word) == 6 for word in words])
    want = {(a, b) for a in words for b in words if len(b) == 7 and near(a, b) and (len(a) == 6 or a < b)}
    for leaf, pairs in ((1, 10**6), (48, 10**6), (48, 0), (10**6, 0)):
        monkeypatch.setattr(spelling, "LEAF", leaf)
        monkeypatch.setattr(spelling, "PAIRS", pairs)
        left, right = Shard(7, data, on, ~shorter).search(1)
        got = [tuple(sorted((words[a], words[b]), key=lambda w: (len(w), w))) for a, b in zip(left, right, strict=True)]
        assert len(got) == len(set(got)) and set(got) == want


def test_long_and_repeated(spark):
    long = "x" * 30_000
    rows = [(1, f"{long} {long}"), (2, f"{long}y {long}y"), (3, f"{long[:-1]}y {long[:-1]}y"), (3, "repeated rows"), (3, "repeated rows")]
    result = found(spelling_variants(frame(spark, rows)))
    assert result == brute(rows)


def test_empty(spark):
    assert found(spelling_variants(frame(spark, []))) == {}
    assert found(spelling_variants(frame(spark, [(1, None), (2, ""), (3, "short")]))) == {}
