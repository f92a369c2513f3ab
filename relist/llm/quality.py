"""Quality of documents: random-indexing word vectors, pooled, and a two-layer network with calibrated probabilities.

Every word has two names: its hash and its shape (length, case, marks, digits, whether it repeats a
word just before). Both share a table of fixed size, so the vectors are bounded however large the
vocabulary. Each name has a sparse random index vector of a few plus and minus ones, given by a rule.
A name's vector is the sum of the index vectors of its neighbours over all documents: names that
stand in like company get like vectors. Tasks add up their part and send a row per name.

A document is the mean and the spread of the vectors of its names. A network of one hidden layer,
trained in numpy on a bounded sample of labelled documents, gives a logit; a temperature fitted on
documents that it was not trained on turns it into a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relist.llm.hashing import Words, mix
from relist.llm.runtime import bounded, column, cut_lineage, map_rows, shared, split_evenly, texts

SHAPES = 512


@dataclass(frozen=True)
class Quality:
    """names: size of the table; width: of a vector; ones: non-zero places of an index vector; sample: labelled documents used at most; hidden, epochs, step: of the network."""

    names: int = 8192
    width: int = 32
    ones: int = 4
    sample: int = 8_000
    hidden: int = 16
    epochs: int = 400
    step: float = 0.02
    seed: int = 8


_CLASS = np.zeros((256, 4), np.int64)  # upper case, mark, digit, any
_CLASS[65:91, 0] = 1
_CLASS[[c for c in range(33, 127) if not chr(c).isalnum()], 1] = 1
_CLASS[48:58, 2] = 1
_CLASS[:, 3] = 1


def named(text: str, names: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash name and the shape name of every word of a whole text."""
    data = text.encode("utf-8", "surrogatepass")
    words = Words(data.lower())
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sums = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(_CLASS[np.frombuffer(data, np.uint8)], axis=0)])
    upper, mark, digit, size = (sums[words.end] - sums[words.start]).T
    repeats = np.zeros(len(words), np.int64)
    repeats[1:] = words.hash[1:] == words.hash[:-1]
    repeats[2:] |= words.hash[2:] == words.hash[:-2]
    case = np.where(upper == 0, 0, np.where(upper * 2 > size - mark, 2, 1))
    marks = np.where(mark == size, 3, np.minimum(mark, 2))
    lengths = np.searchsorted([2, 4, 8, 14, 24], size)
    shape = (((lengths * 3 + case) * 4 + marks) * 2 + (digit > 0)) * 2 + repeats
    return (words.hash % np.uint64(names - SHAPES)).astype(np.int64) + SHAPES, shape


def index_vectors(plan: Quality) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero entries of every name's index vector."""
    code = mix(np.arange(plan.names * plan.ones, dtype=np.uint64) + np.uint64(plan.seed << 32)).reshape(plan.names, plan.ones)
    return (code % np.uint64(plan.width)).astype(np.int64), np.where(np.arange(plan.ones) % 2, -1.0, 1.0) * np.ones((plan.names, 1))


def word_vectors(docs: DataFrame, plan: Quality) -> np.ndarray:
    """Unit vectors of all names, from all documents; names that never occur are zero."""
    slots = plan.names * plan.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, sign = index_vectors(plan)
        total = np.zeros(slots)

        def add(target: np.ndarray, context: np.ndarray) -> None:
            for k in range(plan.ones):
                total[:] += np.bincount(target * plan.width + place[context, k], sign[context, k], slots)

        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> None:
            target, context = (np.concatenate(x) for x in zip(*held, strict=True))
            add(target, context)
            held.clear()

        waiting = 0
        for batch in batches:
            for text in texts(batch):
                for name in named(text, plan.names):
                    held += [(name[1:], name[:-1]), (name[:-1], name[1:])]
                    waiting += 2 * len(name)
                if waiting > 1_000_000:
                    flush()
                    waiting = 0
        if held:
            flush()
        rows = total.reshape(plan.names, plan.width)
        used = np.flatnonzero(np.abs(rows).sum(1))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(list(rows[used]), pa.list_(pa.float64()))], ["name", "vector"])

    parts = docs.select("text").mapInArrow(run, "name bigint, vector array<double>")
    sums = parts.groupBy("name").agg(F.array(*(F.sum(F.get("vector", F.lit(k))) for k in range(plan.width))).alias("vector"))
    vectors = np.zeros((plan.names, plan.width))
    for row in sums.collect():
        vectors[row["name"]] = row["vector"]
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return (vectors / np.maximum(length, 1e-9)).astype(np.float32)


def pooled(text: str, vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of the vectors of both kinds of names, and the logarithm of the number of words."""
    parts = []
    for name in named(text, len(vectors)):
        if len(name):
            used, times = np.unique(name, return_counts=True)
            weight = (times / len(name))[:, None].astype(np.float32)
            mean = (vectors[used] * weight).sum(0)
            parts += [mean, np.sqrt(np.maximum((vectors[used] ** 2 * weight).sum(0) - mean**2, 0))]
        else:
            parts += [np.zeros(vectors.shape[1], np.float32)] * 2
    return np.concatenate([*parts, [np.log1p(len(name))]])


@dataclass
class Network:
    """Word vectors, input scaling, weights of the two layers and the temperature."""

    vectors: np.ndarray
    shift: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.shift) / self.scale @ self.first + self.first_bias) @ self.second + self.second_bias

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def fitted(x: np.ndarray, y: np.ndarray, vectors: np.ndarray, plan: Quality) -> Network:
    """Adam on all rows at once with weight decay; a fifth of the rows is kept for the temperature."""
    random = np.random.default_rng(plan.seed)
    held = np.arange(len(y)) % 5 == 4
    net = Network(
        vectors, x.mean(0), x.std(0) + 1e-6, random.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], plan.hidden)), np.zeros(plan.hidden), random.normal(0, 0.3, plan.hidden), 0.0
    )
    inputs, labels = (x[~held] - net.shift) / net.scale, y[~held]
    weights = [net.first, net.first_bias, net.second, np.zeros(1)]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    for epoch in range(1, plan.epochs + 1):
        hidden = np.tanh(inputs @ weights[0] + weights[1])
        error = (1 / (1 + np.exp(-np.clip(hidden @ weights[2] + weights[3], -30, 30))) - labels) / len(labels)
        back = np.outer(error, weights[2]) * (1 - hidden**2)
        slopes = [inputs.T @ back + 1e-4 * weights[0], back.sum(0), hidden.T @ error + 1e-4 * weights[2], error.sum(keepdims=True)]
        for w, slope, (mean, square) in zip(weights, slopes, moments, strict=True):
            mean += 0.1 * (slope - mean)
            square += 0.01 * (slope**2 - square)
            w -= plan.step * (mean / (1 - 0.9**epoch)) / (np.sqrt(square / (1 - 0.99**epoch)) + 1e-8)
    net.first, net.first_bias, net.second, net.second_bias = weights[0], weights[1], weights[2], float(weights[3][0])
    if held.any():
        logits, truth = net.logits(x[held]), y[held]
        choices = np.geomspace(0.25, 8, 41)
        loss = [np.mean(np.logaddexp(0, np.where(truth > 0.5, -1, 1) * logits / t)) for t in choices]
        net.temperature = float(choices[int(np.argmin(loss))])
    return net


def train(docs: DataFrame, labels: DataFrame, plan: Quality = Quality()) -> Network | None:
    """Word vectors from all of ``docs``; the network from at most ``plan.sample`` labelled ones, by hash of their id. ``labels``: (doc_id, quality 0 or 1). None without labels."""
    vectors = word_vectors(split_evenly(docs.select("text")), plan)
    known = cut_lineage(labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality")))
    share = min(1.0, plan.sample / max(1, known.count()))
    drawn = cut_lineage(known.where(F.pmod(F.xxhash64("doc_id", F.lit(plan.seed)), F.lit(1_000_000)) < int(share * 1_000_000)))
    sent = shared(docs.sparkSession, vectors)

    def run(batch: pa.RecordBatch) -> dict[str, object]:
        return {"doc_id": column(batch, "doc_id"), "quality": column(batch, "quality"), "pooled": [pooled(text, sent.value) for text in texts(batch)]}

    chosen = docs.select("doc_id", "text").join(bounded(drawn), "doc_id").select("doc_id", F.col("quality").cast("int").alias("quality"), "text")
    rows = map_rows(chosen, "doc_id bigint, quality int, pooled array<double>", run).orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * plan.sample).collect()
    if not rows:
        return None
    return fitted(np.array([r.pooled for r in rows]), np.array([r.quality for r in rows], float), vectors, plan)


def scored(docs: DataFrame, net: Network | None) -> DataFrame:
    """(doc_id, score), a row per row of ``docs``: the calibrated probability of good quality.

    A null text scores as an empty one. Without a network, as without labels, every score is 0.5. More columns are ignored.
    """
    sent = shared(docs.sparkSession, net)

    def run(batch: pa.RecordBatch) -> dict[str, object]:
        own = sent.value
        if own is None or not batch.num_rows:
            return {"doc_id": column(batch, "doc_id"), "score": [0.5] * batch.num_rows}
        return {"doc_id": column(batch, "doc_id"), "score": own.scores(np.array([pooled(text, own.vectors) for text in texts(batch)]))}

    return map_rows(split_evenly(docs.select("doc_id", "text")), "doc_id bigint, score double", run)
