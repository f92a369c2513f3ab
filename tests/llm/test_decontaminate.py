from __future__ import annotations

import random

import numpy as np
import pytest

from relist.llm.decontaminate import Decontamination, align, contaminated, without_copies, word_hashes
from tests.llm.cases import edited, frame, odd_rows, prose


def plain_align(item, window, plan):
    best = 0
    rows = [[0] * (len(window) + 1) for _ in range(len(item) + 1)]
    for i in range(1, len(item) + 1):
        for j in range(1, len(window) + 1):
            step = plan.match if item[i - 1] == window[j - 1] else plan.mismatch
            rows[i][j] = max(0, rows[i - 1][j - 1] + step, rows[i - 1][j] - plan.gap, rows[i][j - 1] - plan.gap)
            best = max(best, rows[i][j])
    return best


def items(spark, rows):
    return spark.createDataFrame([(i, t, "more") for i, t in rows], "item_id bigint, text string, score string")


@pytest.mark.parametrize("seed", range(20))
def test_alignment_equals_the_full_matrix(seed):
    draw = random.Random(seed)
    plan = Decontamination()
    item = np.array([draw.randint(0, 6) for _ in range(draw.randint(1, 25))], np.uint64)
    window = np.array([draw.randint(0, 6) for _ in range(draw.randint(0, 60))], np.uint64)
    score, item_end, window_end = align(item, window, plan)
    assert score == plain_align(item.tolist(), window.tolist(), plan)
    assert plain_align(item[:item_end].tolist(), window[:window_end].tolist(), plan) == score


def corpus():
    tests = [(k, prose(1000 + k, 20 + 3 * k)) for k in range(8)] + [(8, None), (9, ""), (10, "two words"), (3, prose(1003, 29))]
    docs = [(100 + k, f"{prose(k, 50)} {edited(tests[k % 8][1], k, k % 9)} {prose(k + 500, 40)}") for k in range(24)]
    docs += [(200, prose(77, 300)), (201, " ".join([prose(78, 20), tests[2][1], prose(79, 200), edited(tests[2][1], 1, 2)])), (202, "with two words inside")]
    return docs, tests


def test_equals_alignment_of_all_pairs(spark):
    docs, tests = corpus()
    plan = Decontamination()
    found = contaminated(frame(spark, docs), items(spark, tests), plan).collect()
    want = {}
    for doc_id, text in docs:
        words = word_hashes(text)
        for item_id, item in tests:
            own = word_hashes(item or "")
            score = align(own, words, plan)[0] / (plan.match * len(own)) if len(own) else 0
            if score >= plan.least_score:
                want[doc_id, item_id] = score
    assert {(r.doc_id, r.item_id): r.score for r in found} == pytest.approx(want)
    assert len(want) > 20
    texts = dict(docs)
    copy = next(r for r in found if r.doc_id == 201)
    assert " ".join(texts[201].split()[copy.start_word : copy.end_word]) == tests[2][1]


def test_blocks_lead_to_the_same_copies(spark):
    docs, tests = corpus()
    one = {tuple(r) for r in contaminated(frame(spark, docs), items(spark, tests)).collect()}
    many = {tuple(r) for r in contaminated(frame(spark, docs), items(spark, tests), Decontamination(block_words=60)).collect()}
    assert one == many


def test_odd_rows(spark):
    docs = frame(spark, [*odd_rows(), (50, prose(6, 40)), (51, prose(6, 40)), (51, prose(6, 40))])
    found = contaminated(docs, items(spark, [(None, prose(6, 40)), (1, prose(6, 40)[:200]), (2, None)])).collect()
    assert sorted(r.doc_id for r in found) == [6, 6, 50, 51, 51] and {r.item_id for r in found} == {1}
    assert contaminated(frame(spark, []), items(spark, [(1, "a b c d")])).count() == 0
    assert contaminated(docs, items(spark, [])).count() == 0


def test_evidence_of_short_items_and_long_runs(spark):
    long = prose(2000, 59)
    tests = [(1, "what is the capital"), (2, "capital"), (3, "renowned quixotic zephyr"), (4, "alpha beta gamma delta epsilon zeta eta theta iota kappa"), (5, long)]
    docs = [(k, f"{prose(k, 20)} what is the capital here {prose(k + 900, 20)}") for k in range(20)]
    docs += [(50, f"{prose(50, 20)} what is the weather"), (51, f"{prose(51, 9)} renowned quixotic zephyr {prose(52, 9)}"), (52, f"{prose(53, 9)} alpha beta gamma delta epsilon")]
    docs += [(53, f"{prose(54, 30)} {' '.join(long.split()[20:44])} {prose(55, 30)}"), (54, f"{prose(56, 30)} {' '.join(long.split()[20:30])} {prose(57, 30)}")]
    docs += [(55, f"{prose(58, 9)} alpha beta gamma delta epsilon zeta eta theta iota {prose(59, 9)}")]
    found = contaminated(frame(spark, docs), items(spark, tests)).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(51, 3), (53, 5), (55, 4)}


def test_rows_without_copies_stay(spark):
    docs, tests = corpus()
    copied = docs[0][1]
    rows = [*docs, (None, copied), (None, prose(9, 30)), (5, prose(10, 30)), (5, copied), (6, None), (7, "")]
    frame_ = frame(spark, rows)
    hit = {r.doc_id for r in contaminated(frame_, items(spark, tests)).collect()}
    assert hit - {None, 5} and {None, 5} <= hit
    kept = without_copies(frame_, items(spark, tests))
    assert kept.columns == frame_.columns
    want = [(doc_id, text) for doc_id, text in rows if (doc_id not in hit) or text in (rows[-5][1], rows[-4][1])]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(want, key=str)
    assert without_copies(frame_, items(spark, tests).limit(0)).count() == len(rows)
