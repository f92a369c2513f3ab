"""Toxicity behind a noisy channel: obfuscated words are decoded, the restored text is scored.

The channel writes a word with look-alike digits and symbols, with repeated letters, or with its
letters spread out. Words that show any of it are found by counts over the bytes of the whole text.
They are decoded by Viterbi search over a lattice: the hidden letters follow a character bigram model
counted over all documents, and each seen character is emitted by the letter itself, by a letter it
stands for, or repeats or interrupts the letter before at a price. All such words of a batch are
decoded together, position by position.

The score uses the words as written and as restored. A word has five features: itself and its
prefixes of 4 to 7 bytes, so that inflected forms share evidence. Features are weighted by their log
odds in labelled documents, shrunk towards none. The strongest weights of a document go through a
logistic curve fitted on labelled documents that did not set the weights.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relist.llm.decontaminate import Lookup
from relist.llm.hashing import Words, signed
from relist.llm.line_dedup import normalised
from relist.llm.runtime import bounded, column, cut_lineage, map_rows, shared, sliced, split_evenly, texts

#: What a digit or symbol may stand for in a disguised word.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "gq",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i",
}
LETTERS = "abcdefghijklmnopqrstuvwxyz"
PREFIXES = (4, 5, 6, 7)

_STATES = len(LETTERS) + 1  # the last stands for any other letter, which emits itself
_CODE = np.full(256, _STATES, np.int64)  # the boundary
_CODE[[ord(c) for c in LETTERS]] = np.arange(len(LETTERS))
_CODE[128:] = _STATES - 1
_LETTER = _CODE < _STATES
_SIGN = np.zeros(256, bool)
_SIGN[[ord(c) for c in LOOKALIKES if ord(c) < 128]] = True
_NEVER = -1e9
#: Cells (positions x words x letters) of the lattices that are decoded together: a long word has few beside it.
LATTICE_CELLS = 4_000_000


@dataclass(frozen=True)
class Toxicity:
    """sample: labelled documents used for fitting at most; least_documents: toxic documents a feature must occur in; most_features: size of the model."""

    sample: int = 12_000
    least_documents: int = 4
    most_features: int = 50_000
    lookalike_cost: float = 2.0
    repeat_cost: float = 1.0
    skip_cost: float = 1.0
    skip_lookalike_cost: float = 7.0


@dataclass
class Channel:
    """Character bigram log probabilities over letters, other letters and the boundary, and the costs of the channel."""

    pairs: np.ndarray
    plan: Toxicity
    emission: dict[str, np.ndarray] = field(default_factory=dict)

    def emitted(self, seen: str) -> np.ndarray:
        if seen not in self.emission:
            row = np.full(_STATES, _NEVER)
            if seen in LETTERS:
                row[LETTERS.index(seen)] = 0.0
            elif seen.isalpha():
                row[-1] = 0.0
            for letter in LOOKALIKES.get(seen, ""):
                row[LETTERS.index(letter)] = -self.plan.lookalike_cost
            self.emission[seen] = row
        return self.emission[seen]

    def stay(self, seen: str) -> float:
        """The price of a character that adds no letter to the one before."""
        if seen.isalpha():
            return self.plan.repeat_cost
        return self.plan.skip_lookalike_cost if seen in LOOKALIKES else self.plan.skip_cost

    def decode(self, words: list[str]) -> list[str]:
        """The likeliest hidden word of each seen word."""
        decoded = [""] * len(words)
        order = sorted(range(len(words)), key=lambda n: -len(words[n]))
        first = 0
        while first < len(order):
            most = max(1, min(512, LATTICE_CELLS // (_STATES * max(1, len(words[order[first]])))))
            chosen = order[first : first + most]
            for n, word in zip(chosen, self._decode([words[n] for n in chosen]), strict=True):
                decoded[n] = word
            first += most
        return decoded

    def _decode(self, words: list[str]) -> list[str]:
        longest = max(map(len, words))
        own, start, end = self.pairs[:_STATES, :_STATES], self.pairs[_STATES, :_STATES], self.pairs[:_STATES, _STATES]
        score = np.full((len(words), _STATES), _NEVER)
        step = np.zeros((longest, len(words), _STATES), np.int8)
        ended = np.zeros((len(words), _STATES))
        for at in range(longest):
            seen = [w[at] if at < len(w) else "" for w in words]
            emit = np.stack([self.emitted(c) for c in seen])
            begun = start + emit
            if at:
                reach = score[:, :, None] + own
                before = reach.argmax(1)
                moved = np.take_along_axis(reach, before[:, None, :], 1)[:, 0] + emit
                stay_cost = np.array([[self.stay(c)] for c in seen])
                same = emit >= -self.plan.lookalike_cost
                symbol = np.array([[not c.isalpha()] for c in seen])
                stayed = np.where(same | symbol, score - stay_cost, _NEVER)
                better = stayed > moved
                score_next = np.where(better, stayed, moved)
                step[at] = np.where(better, -1, before)
            else:
                score_next = np.maximum(begun, _NEVER)
                first_symbol = np.array([[c not in LOOKALIKES and not c.isalpha()] for c in seen])
                score_next = np.where(first_symbol, start - self.plan.skip_cost, score_next)
            live = np.array([[at < len(w)] for w in words])
            score = np.where(live, score_next, score)
            last = np.array([at == len(w) - 1 for w in words])
            ended[last] = score[last] + end
        state = ended.argmax(1)
        letters: list[list[str]] = [[] for _ in words]
        for n, word in enumerate(words):
            now = int(state[n])
            for at in range(len(word) - 1, 0, -1):
                back = int(step[at, n, now])
                if back >= 0:
                    letters[n].append(LETTERS[now] if now < len(LETTERS) else word[at])
                    now = back
            letters[n].append(LETTERS[now] if now < len(LETTERS) else word[0])
        return ["".join(reversed(x)) for x in letters]


def disguised(text: str) -> list[str]:
    """The words of a lower-case text that a channel may have written, spread letters joined."""
    data = text.encode("utf-8", "surrogatepass")
    words = Words(data)
    if not len(words):
        return []
    raw = words.raw
    letter, sign = _LETTER[raw], _SIGN[raw]
    odd = np.zeros(len(raw), bool)
    odd[1:] |= letter[1:] & sign[:-1]
    odd[:-1] |= letter[:-1] & sign[1:]
    odd[2:] |= letter[2:] & (raw[2:] < 128) & (raw[2:] == raw[1:-1]) & (raw[2:] == raw[:-2])
    total = np.concatenate([[0], np.cumsum(odd)])
    marked = np.flatnonzero(total[words.end] > total[words.start])
    found = [data[words.start[n] : words.end[n]].decode("utf-8", "replace").rstrip(".,;:!?\"')") for n in marked]
    single = (words.end - words.start == 1) & (letter | sign)[words.start]
    edges = np.diff(single.astype(np.int8), prepend=0, append=0)
    for first, end in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1), strict=True):
        if end - first >= 3:
            found.append("".join(chr(raw[k]) for k in words.start[first:end]))
    for match in _SPREAD.finditer(text):
        found.append(re.sub(r"[.\-_*]", "", match.group()))
    return [word for word in found if word]


_SPREAD = re.compile(r"(?<![^\W_])[a-z](?:[.\-_*][a-z]){2,}(?![^\W_])")


def features(data: bytes) -> np.ndarray:
    """Distinct hashes of the words of a normalised text and of their prefixes."""
    words = Words(data)
    parts = [words.hash] + [words.prefix(size) + np.uint64(size) for size in PREFIXES]
    return np.unique(np.concatenate(parts))


def batch_features(batch: pa.RecordBatch, channel: Channel) -> Iterator[np.ndarray]:
    """Features of each whole text of a batch, as written and as restored."""
    lowered, per_text = [], []
    for text in texts(batch):
        small = text.lower()
        lowered.append(normalised(text).replace(b"\n", b" "))
        per_text.append(disguised(small))
    unique = sorted({word for words in per_text for word in words})
    restored = dict(zip(unique, channel.decode(unique), strict=True)) if unique else {}
    for data, words in zip(lowered, per_text, strict=True):
        own = features(data)
        if words:
            own = np.union1d(own, features(" ".join(restored[w] for w in words).encode("utf-8", "replace")))
        yield own


def letter_model(docs: DataFrame, plan: Toxicity) -> Channel:
    """Bigram model of the letters of all documents; a task sends a count per pair."""
    size = _STATES + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size * size, np.int64)
        for batch in batches:
            for text in texts(batch):
                code = _CODE[np.frombuffer((" " + text.lower() + " ").encode("utf-8", "surrogatepass"), np.uint8)]
                counts += np.bincount(code[:-1] * size + code[1:], minlength=size * size)
        pairs = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts[pairs])], ["pair", "times"])

    counts = np.full((size, size), 0.5)
    for row in docs.select("text").mapInArrow(run, "pair bigint, times bigint").groupBy("pair").agg(F.sum("times")).collect():
        counts[divmod(row[0], size)] += row[1]
    return Channel(np.log(counts / counts.sum(1, keepdims=True)), plan)


@dataclass
class Model:
    """Weighted features, the logistic curve over [1, strongest, number of strong ones], and the channel."""

    hashes: np.ndarray
    weights: np.ndarray
    curve: np.ndarray
    channel: Channel

    def evidence(self, own: np.ndarray, lookup: Lookup) -> tuple[float, float]:
        slot = lookup.find(own)[1]
        if not len(slot):
            return 0.0, 0.0
        return float(self.weights[slot].max()), float(np.log1p(len(slot)))

    def scores(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(evidence @ self.curve[1:] + self.curve[0], -30, 30)))


def log_odds(toxic: np.ndarray, clean: np.ndarray, toxic_docs: int, clean_docs: int) -> np.ndarray:
    """With half a document added on either side, so that a feature of few documents weighs less than one of many."""
    return np.log((toxic + 0.5) / (toxic_docs + 1)) - np.log((clean + 0.5) / (clean_docs + 1))


def fitted_curve(evidence: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps with a small ridge."""
    x = np.column_stack([np.ones(len(evidence)), evidence])
    curve = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ curve, -30, 30)))
        slope = x.T @ (label - p) - 0.01 * curve
        curvature = (x * (p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(len(curve))
        curve = curve + np.linalg.solve(curvature, slope)
    return curve


def train(docs: DataFrame, labels: DataFrame, plan: Toxicity = Toxicity()) -> Model:
    """Fit on at most ``plan.sample`` labelled documents, chosen by a hash of their id; ``labels`` has doc_id and toxic (0 or 1)."""
    channel = letter_model(docs, plan)
    known = cut_lineage(labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    share = min(1.0, plan.sample / max(1, known.count()))
    drawn = cut_lineage(known.where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1_000_000)) < int(share * 1_000_000)))
    sent = shared(docs.sparkSession, channel)
    chosen = docs.select("doc_id", "text").join(bounded(drawn), "doc_id").withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(2)))

    def counted(batch: pa.RecordBatch) -> dict[str, object] | None:
        toxic, fold = (np.array(column(batch, name)) for name in ("toxic", "fold"))
        own = list(batch_features(batch, sent.value))
        if not own:
            return None
        group = np.repeat(toxic * 2 + fold, [len(x) for x in own])
        hashes, place = np.unique(np.concatenate(own), return_inverse=True)
        counts = np.bincount(place * 4 + group, minlength=4 * len(hashes)).reshape(-1, 4)
        return {"feature": signed(hashes), **{f"n{k}": counts[:, k] for k in range(4)}}

    counts = map_rows(split_evenly(chosen), "feature bigint, n0 bigint, n1 bigint, n2 bigint, n3 bigint", counted)
    counts = counts.groupBy("feature").agg(*(F.sum(f"n{k}").alias(f"n{k}") for k in range(4)))
    strong = counts.where(F.col("n2") + F.col("n3") >= plan.least_documents).where((F.col("n2") + F.col("n3")) * 2 > F.col("n0") + F.col("n1"))
    rows = strong.orderBy((F.col("n2") + F.col("n3") - F.col("n0") - F.col("n1")).desc(), "feature").limit(plan.most_features).collect()
    table = np.array(sorted(([r.feature, r.n0, r.n1, r.n2, r.n3] for r in rows), key=lambda r: r[0] % (1 << 64)), np.int64).reshape(-1, 5)
    sizes = {(r.toxic, r.fold): r["count"] for r in drawn.groupBy("toxic", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(2)).alias("fold")).count().collect()}
    size = [sizes.get(k, 0) for k in ((0, 0), (0, 1), (1, 0), (1, 1))]
    hashes = table[:, 0].view(np.uint64) if len(table) else np.zeros(0, np.uint64)

    def weighted(toxic: np.ndarray, clean: np.ndarray, toxic_docs: int, clean_docs: int) -> Model:
        weights = log_odds(toxic, clean, toxic_docs, clean_docs)
        kept = (weights > 1.5) & (toxic >= plan.least_documents / 2)
        return Model(hashes[kept], weights[kept], np.array([-3.0, 1.0, 1.0]), channel)

    half = weighted(table[:, 3], table[:, 1], size[2], size[0])
    held = evidence_of(chosen.where("fold = 1"), half).select("strongest", "number", "toxic").collect()
    model = weighted(table[:, 3] + table[:, 4], table[:, 1] + table[:, 2], size[2] + size[3], size[0] + size[1])
    if held:
        model.curve = fitted_curve(np.array([[r.strongest, r.number] for r in held]), np.array([r.toxic for r in held], float))
    return model


def evidence_of(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, toxic, strongest, number): the evidence in each document, with its label where ``docs`` has one."""
    sent = shared(docs.sparkSession, model)
    labelled = docs if "toxic" in docs.columns else docs.withColumn("toxic", F.lit(None).cast("int"))

    def run(batch: pa.RecordBatch) -> dict[str, object]:
        own = sent.value
        if not hasattr(own, "lookup"):
            own.lookup = Lookup(own.hashes)
        found = [own.evidence(x, own.lookup) for x in batch_features(batch, own.channel)]
        strongest, number = zip(*found, strict=True) if found else ((), ())
        return {"doc_id": column(batch, "doc_id"), "toxic": column(batch, "toxic"), "strongest": strongest, "number": number}

    chosen = split_evenly(labelled.select("doc_id", F.col("toxic").cast("int").alias("toxic"), "text"))
    return map_rows(chosen, "doc_id bigint, toxic int, strongest double, number double", run)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score), a row per row of ``docs``; a null text scores as an empty one. More columns are ignored."""
    linear = F.lit(float(model.curve[0])) + F.col("strongest") * float(model.curve[1]) + F.col("number") * float(model.curve[2])
    return evidence_of(docs.select("doc_id", "text"), model).select("doc_id", (1 / (1 + F.exp(-linear))).alias("score"))


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, all columns as they are; one pass, no join."""
    sent = shared(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        lookup = Lookup(own.hashes)
        for whole in batches:
            for batch in sliced(whole):
                if batch.num_rows:
                    evidence = np.array([own.evidence(x, lookup) for x in batch_features(batch, own.channel)])
                    yield batch.filter(pa.array(own.scores(evidence) < threshold))

    return split_evenly(docs).mapInArrow(run, docs.schema)
