from __future__ import annotations

import random
import re
from collections import Counter
from math import comb

import pytest

from relist.llm.quality_rules import RULES, RuleRisk, grid, histogram, measured, measured_text, proven_cutoffs, ruled, tail, upper_bound, wanted_steps
from tests.llm.cases import SCHEMA, frame, odd_rows, prose


def base_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    times = Counter(windows)
    inside = {k + j for k, window in enumerate(windows) if times[window] >= 2 for j in range(3)}
    copies = sum(line in lines[:k] for k, line in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), copies, len(inside)


def texts():
    draw = random.Random(1)
    few = ["".join(draw.choice(["a", "b", "c ", "c ", "\n", " ", "é", "日本", "|", "#", "A!", "\x1f", " ", "\x0b"]) for _ in range(draw.randint(0, 90))) for _ in range(150)]
    return [text for _, text in odd_rows()] + few + ["a b c a b c", "x\nx\n x\nx", "one two three " * 30, "\n\n\n"]


def test_counts_equal_a_plain_computation(spark):
    rows = [(k, text) for k, text in enumerate(texts())]
    found = measured(frame(spark, rows), RuleRisk()).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert {row.doc_id: tuple(row[name] for name in names) for row in found} == {k: base_counts(text) for k, text in rows}
    for row in found:
        assert row.base_failed == (row.n_words < 50 or 100 * row.n_repeat_words > 50 * row.n_words)
        assert all(0 <= row[name] <= 1000 for name in RULES)


def test_measures():
    found = measured_text("AB cd ## !?\nAB cd ## !?")
    assert (found["capitals"], found["marks"], found["bare"], found["copies"], found["repeats"], found["symbols"], found["spread"]) == (500, 500, 500, 500, 1000, 250, 200)


@pytest.mark.parametrize(("k", "n", "p"), [(0, 10, 0.1), (3, 10, 0.3), (7, 60, 0.05), (40, 60, 0.5), (9, 10, 0.9), (2, 2000, 0.004), (30, 900, 0.02)])
def test_tail_equals_the_sum(k, n, p):
    exact = sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
    assert tail(k, n, p) == pytest.approx(exact, rel=1e-9, abs=1e-12)


def test_bound_is_exact():
    assert upper_bound(0, 100, 0.05) == pytest.approx(1 - 0.05 ** (1 / 100))
    bound = upper_bound(5, 400, 0.01)
    assert tail(5, 400, bound) == pytest.approx(0.01) and upper_bound(4, 4, 0.05) == 1.0
    assert tail(10**6, 10**9, 0.00101) < 1e-10  # large counts


def labelled(spark, sizes, seed=2):
    """Strata of good prose of which some has a few marks, and bad prose with many; labels of all."""
    draw = random.Random(seed)
    rows, labels, doc_id = [], [], 0
    for stratum, size in sizes.items():
        for _ in range(size):
            doc_id += 1
            words = prose(doc_id % 40, 55).split()
            bad = draw.random() < 0.3
            for place in draw.sample(range(55), draw.randint(15, 40) if bad else draw.choice([0] * 60 + [1, 2])):
                words[place] += "*"
            rows.append((doc_id, " ".join(words), stratum, "src0", 1, 7, "root", "key", 0.5, "part", 3))
            labels.append((doc_id, int(not bad)))
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id bigint, quality int"), dict(labels), {row[0]: row[2] for row in rows}


def test_cutoffs_are_proven_and_reject_bad_documents(spark):
    docs, labels, quality, stratum = labelled(spark, {"en": 2500, "de": 1800, None: 1500, "xx": 60})
    plan = RuleRisk()
    rows = measured(docs, plan)
    bins = histogram(rows, labels, plan)
    wanted = wanted_steps(bins, plan)
    assert RULES.index("symbols") in wanted
    cutoffs = proven_cutoffs(bins, wanted, plan).collect()
    assert {row.stratum for row in cutoffs if row.rule == 0} == {"en", "de", None}  # too few documents prove nothing
    for row in cutoffs:
        assert row.bound <= plan.share / len(wanted)
        assert row.bound == pytest.approx(upper_bound(row.rejected, row.held, plan.error / (4 * len(wanted))))
    kept = {row.doc_id: row.kept for row in ruled(docs, labels, plan).collect()}
    for of in (None, "en", "de"):
        good = [kept[k] for k in quality if stratum[k] == of and quality[k]]
        bad = [kept[k] for k in quality if stratum[k] == of and not quality[k]]
        assert sum(good) >= 0.95 * len(good) and sum(bad) <= 0.05 * len(bad)
    assert all(kept[k] for k in quality if stratum[k] == "xx")


def test_every_cutoff_up_to_the_chosen_one_is_proven(spark):
    """The fixed sequence ends at the first cutoff whose bound is beyond the share, though the other fold wants more."""
    docs, labels, _, _ = labelled(spark, {"en": 1200})
    plan = RuleRisk(share=0.02, price=0)
    bins = histogram(measured(docs, plan), labels, plan)
    wanted = {RULES.index("symbols"): len(grid()) - 1}
    (row,) = proven_cutoffs(bins, wanted, plan).collect()
    held = [r for r in bins.where("not choosing and rule = 0").collect()]
    n = sum(r.good for r in held)
    rejected = [sum(r.good for r in held if r.bin <= step) for step in range(len(grid()))]
    proven = 0
    while upper_bound(rejected[proven + 1], n, 0.05) <= 0.02:
        proven += 1
    assert (row.cutoff, row.rejected, row.held) == (grid()[proven], rejected[proven], n) and 0 < row.cutoff < 1000


def test_odd_input(spark):
    docs = frame(spark, odd_rows())
    labels = spark.createDataFrame([(1, 1), (None, 0), (6, 0), (6, 1), (8, None), (999, 1)], "doc_id bigint, quality int")
    found = ruled(docs, labels).collect()
    assert len(found) == len(odd_rows()) and all(row.kept == (not row.base_failed) for row in found)
    assert ruled(frame(spark, []), labels).count() == 0
    assert all(row.kept == (not row.base_failed) for row in ruled(docs, labels.limit(0)).collect())
