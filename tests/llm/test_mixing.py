from __future__ import annotations

import re
from collections import Counter

import pytest

from relist.llm.mixing import Mixing, mixed
from tests.llm.cases import frame, odd_rows, prose


def water_fill(sizes, cycle, epochs):
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode()) + [n for n in sizes if n is None]
    weight = {n: k % cycle + 1 for k, n in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(epochs * sizes[n] for n in capped)
        free = sum(weight[n] for n in names if n not in capped)
        target = {n: epochs * sizes[n] if n in capped else weight[n] * left / free for n in names}
        above = {n for n in names if n not in capped and target[n] > epochs * sizes[n]}
        if not above:
            return target
        capped |= above


def rows():
    made = [(k, prose(k, 5 + k % 40), f"s{k % 7}") for k in range(300)]
    made += [(500 + k, prose(900 + k, 30), None) for k in range(6)] + [(600, prose(1, 2), "tiny"), (601, prose(1, 2_000), "é"), (602, "", "empty")]
    return made + [(700 + k, prose(40 + k, 60), "s0") for k in range(100)] + [(r[0], r[1], "s1") for r in odd_rows()]


def test_targets_and_taken_words(spark):
    found = mixed(frame(spark, rows())).collect()
    sizes = Counter()
    for doc_id, text, source in rows():
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want = water_fill(dict(sizes), 3, 3)
    assert len(found) == len(rows())
    taken = Counter()
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for source, target in want.items():
        assert abs(taken[source] - target) <= 1
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))


def test_reruns_and_partitions_agree(spark):
    docs = frame(spark, rows())
    first = sorted(map(str, mixed(docs).collect()))
    assert sorted(map(str, mixed(docs.repartition(5)).collect())) == first
    assert sorted(map(str, mixed(docs, Mixing(seed=43)).collect())) != first


def test_empty(spark):
    assert mixed(frame(spark, [])).count() == 0
    assert [(r.size, r.taken) for r in mixed(frame(spark, [(1, None), (2, "")])).collect()] == [(0, 0), (0, 0)]
