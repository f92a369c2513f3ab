from __future__ import annotations

import hashlib

from relist.llm.fingerprint import Fingerprints, fingerprint, fingerprints, likeness, parse
from tests.llm.cases import edited, frame, odd_rows, prose


def phrases(text):
    seen, word = set(), ""
    for c in text:
        word += c
        if word not in seen:
            seen.add(word)
            word = ""
    return seen


def test_parse_is_the_greedy_one():
    for text in ("", "a", "aaaaaaaaaa", "abcabcabcabc", prose(1, 200), "é\U0001f600" * 30):
        seen, bounds = set(), []
        parse(text, seen, 0, len(text), bounds)
        assert seen == phrases(text)
        assert {text[a:b] for a, b in zip([0, *bounds], bounds, strict=False)} == seen


def test_equals_plain_computation(spark):
    rows = odd_rows() + [(20 + k, prose(20 + k, 30 + k)) for k in range(40)]
    found = fingerprints(frame(spark, rows)).collect()
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    want = []
    for k, (doc_id, text) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        cut = len(text) // 4
        changed = text[: len(text) - cut] + following[:cut]
        prints = [fingerprint(t) for t in (text, changed, following)]
        hexed = [p.astype(">u4").tobytes().hex() for p in prints]
        sha = hashlib.sha256(changed.encode()).hexdigest()
        want.append((doc_id, len(text), sha, hexed[0], hexed[1], likeness(prints[0], prints[1], 64), likeness(prints[0], prints[2], 64)))
    key = str
    assert sorted(map(tuple, found), key=key) == sorted(want, key=key)


def test_one_document_and_none(spark):
    assert fingerprints(frame(spark, [])).count() == 0
    alone = fingerprints(frame(spark, [(4, prose(4, 50))])).first()
    assert alone.near_next == 1.0 and alone.n_chars == len(prose(4, 50))


def test_likeness_follows_the_phrase_sets():
    plan = Fingerprints(hashes=256)
    for seed in range(10):
        text = prose(seed, 300)
        other = edited(text, seed, 30 * (seed % 3))
        a, b = phrases(text), phrases(other)
        assert abs(likeness(fingerprint(text, plan), fingerprint(other, plan), 256) - len(a & b) / len(a | b)) < 0.12
