"""Toxicity and quality: held-out accuracy, decoding, odd rows."""

from __future__ import annotations

import random

import numpy as np
import pytest

from relist.llm import quality, toxicity
from relist.llm.toxicity import Toxicity, disguised, letter_model
from tests.llm.cases import frame, odd_rows, prose

BAD = ["gruntig", "moltrash", "vexoner"]


def toxic_rows(disguise=lambda w, k: w):
    draw = random.Random(5)
    made, labels = [], []
    for k in range(400):
        words = prose(k, 40).split()
        bad = k % 3 == 0
        if bad:
            for place in range(0, 30, 10):
                words[place] = disguise(draw.choice(BAD), k) + draw.choice(["", "s", "ed"])
        made.append((k, " ".join(words)))
        labels.append((k, int(bad)))
    return made, labels


def frames(spark, disguise=lambda w, k: w):
    made, labels = toxic_rows(disguise)
    return frame(spark, made), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def accuracy(found, labels):
    truth = dict(labels)
    return np.mean([(r.score >= 0.5) == bool(truth[r.doc_id]) for r in found])


def test_toxicity_on_held_out_and_disguised_words(spark):
    docs, labels = frames(spark)
    model = toxicity.train(docs, labels.where("doc_id % 4 <> 1"))
    truth = [tuple(r) for r in labels.collect()]
    assert accuracy(toxicity.scored(docs.where("doc_id % 4 = 1"), model).collect(), truth) > 0.95
    hidden, _ = frames(spark, lambda w, k: [w.replace("o", "0").replace("i", "1"), w.replace("e", "3").replace("a", "@"), w[0] + w[1] * 4 + w[2:]][k % 3])
    assert accuracy(toxicity.scored(hidden.where("doc_id % 4 = 1"), model).collect(), truth) > 0.9
    kept = toxicity.without_toxic(docs, model)
    assert kept.schema == docs.schema
    assert sum(dict(truth)[r.doc_id] for r in kept.collect()) < 10 and kept.count() > 250


def test_decoding(spark):
    docs = frame(spark, [(1, "the gruntig idiot is a loser and stupid worthless moltrash " * 50)])
    channel = letter_model(docs, Toxicity())
    seen = ["1d10t", "stuuuupid", "w0rthl3$$", "l.o.s.e.r", "gruntig", "m0ltr@sh"]
    assert channel.decode(seen) == ["idiot", "stupid", "worthless", "loser", "gruntig", "moltrash"]


def test_disguised_words_are_found_in_whole_texts():
    text = "plain words here " * 500 + "an 1d10t and a s t u p i d l.o.s.e.r nooooo at the end."
    assert {"1d10t", "loser", "nooooo"} <= set(disguised(text)) and any("stupid" in w for w in disguised(text))
    assert disguised("") == [] and disguised("nothing odd, at all.") == []


@pytest.mark.parametrize("name", ["toxicity", "quality"])
def test_odd_rows_and_missing_labels(spark, name):
    module = {"toxicity": toxicity, "quality": quality}[name]
    column = {"toxicity": "toxic", "quality": "quality"}[name]
    docs = frame(spark, odd_rows())
    for labels in ([], [(1, 1), (None, 1), (2, None), (4, 0), (4, 0), (6, 1), (77, 0)]):
        model = module.train(docs, spark.createDataFrame(labels, f"doc_id bigint, {column} int"))
        found = module.scored(docs, model).collect()
        assert len(found) == len(odd_rows()) and all(0 <= r.score <= 1 for r in found)
        assert module.scored(frame(spark, []), model).count() == 0
    assert module.scored(frame(spark, []), module.train(frame(spark, []), spark.createDataFrame([], f"doc_id bigint, {column} int"))).count() == 0


def test_quality_on_held_out(spark):
    made, labels = [], []
    for k in range(300):
        good = k % 2 == 0
        words = prose(k, 40 + k % 30).split()
        made.append((k, " ".join(words) if good else " ".join([w.upper() + "!!" for w in words] if k % 3 else words[:4] * 10)))
        labels.append((k, int(good)))
    docs, known = frame(spark, made), spark.createDataFrame(labels, "doc_id bigint, quality int")
    net = quality.train(docs, known.where("doc_id % 3 <> 1"))
    found = quality.scored(docs.where("doc_id % 3 = 1"), net).collect()
    assert accuracy(found, labels) > 0.95
