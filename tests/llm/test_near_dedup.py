from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pytest

import relist.llm.grouping as grouping
from relist.llm.grouping import components
from relist.llm.near_dedup import NearDedup, near_duplicates, one_of_each, sketch
from tests.llm.cases import edited, frame, odd_rows, prose


def brute(rows, words, percent):
    """Smallest doc_id reachable over links of all pairs."""
    sets = defaultdict(set)
    for doc_id, text in rows:
        parts = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        sets[doc_id] |= {tuple(parts[k : k + words]) for k in range(len(parts) - words + 1)} or ({tuple(parts)} if parts else set())
    root = {doc_id: doc_id for doc_id in sets}
    changed = True
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return {doc_id: (len(sets[doc_id]), root[doc_id]) for doc_id in sets}


def group_rows():
    """A group of copies at all distances from its base, in which most pairs are no links, beside small groups and strangers."""
    base = prose(1, 120)
    rows = [(10, base)] + [(11 + k, edited(base, k, k % 14)) for k in range(60)]
    rows += [(200 + k, prose(200 + k // 2, 60)) for k in range(30)]
    return rows + [(300 + k, prose(300 + k, 30)) for k in range(10)]


@pytest.mark.parametrize(("words", "percent", "bands"), [(3, 85, 24), (5, 80, 32)])
def test_equals_all_pairs(spark, words, percent, bands):
    rows = group_rows() + [r for r in odd_rows() if r[0] is not None]
    found = near_duplicates(frame(spark, rows), NearDedup(words, percent, bands, 4)).collect()
    want = brute(rows, words, percent)
    assert len(found) == len(rows)
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in found} == {(k, *v) for k, v in want.items()}
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def layered_rows():
    """Parts of one text, copies of it with common and with own additions, and additions shared by rows far from the base."""
    base = prose(5, 160).split()
    rows = [(1000 + k, " ".join(base[:k])) for k in range(60, 160, 3)]
    rows += [(2000 + k, " ".join(base[k:])) for k in range(5, 60, 5)]
    for block in range(4):
        extra = prose(50 + block, 30).split()
        rows += [(3000 + 100 * block + k, " ".join(base[: 150 - 2 * k] + extra[: 10 + 2 * k])) for k in range(9)]
        rows += [(4000 + 100 * block + k, edited(" ".join(base + extra), 7 * block + k, k)) for k in range(12)]
    return rows


@pytest.mark.parametrize("size", [0, 10_000])
def test_small_and_large_buckets_lead_to_the_same_groups(spark, monkeypatch, size):
    monkeypatch.setattr(grouping, "SMALL_BUCKET", size)
    rows = group_rows() + layered_rows()
    found = near_duplicates(frame(spark, rows), NearDedup(3, 85, 24, 4)).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in found} == {(k, *v) for k, v in brute(rows, 3, 85).items()}


def test_broadcast_and_shuffle_lead_to_the_same_groups(spark, monkeypatch):
    docs = frame(spark, group_rows())
    first = {tuple(r) for r in near_duplicates(docs).collect()}
    monkeypatch.setattr("relist.llm.runtime.bounded.__defaults__", (0,))
    assert {tuple(r) for r in near_duplicates(docs).collect()} == first


def test_odd_rows(spark):
    found = near_duplicates(frame(spark, odd_rows())).collect()
    assert len(found) == len(odd_rows())
    nameless = [r for r in found if r.doc_id is None]
    assert all(r.component_id is None and r.kept for r in nameless)
    assert {r.doc_id: r.n_shingles for r in found if r.doc_id in (1, 2, 3, 4)} == {1: 0, 2: 0, 3: 0, 4: 1}
    assert near_duplicates(frame(spark, [])).count() == 0


def test_one_of_each_keeps_columns_and_one_row(spark):
    docs = frame(spark, [*odd_rows(), (100, prose(6, 40))])
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 2, 3, 4, 5, 6, 7, 8, 9] and ids.count(None) == 2


def test_sketch_fills_and_estimates():
    draw = np.random.default_rng(1)
    for size in (1, 2, 7, 50, 2000):
        assert sketch(draw.integers(0, 2**63, size).astype(np.uint64), 96).max() < np.iinfo(np.uint64).max
    errors = []
    for _ in range(40):
        pool = draw.integers(0, 2**63, 1100).astype(np.uint64)
        errors.append(np.mean(sketch(pool[:1000], 96) == sketch(pool[100:], 96)) - 900 / 1100)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(1, 60)] + [(1000, k) for k in range(1001, 1100)] + [(5, 5)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {k: 1 for k in range(1, 61)} | {k: 1000 for k in range(1000, 1100)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
