"""Personal data: proposed spans, boosted trees over their format and context, thresholds calibrated by kind.

Four kinds are certain by their form: e-mail addresses, IP addresses, card numbers and telephone
numbers, found exactly and always kept. Generators with high recall propose further spans that may
overlap, each of a kind of its own: national telephone and social security numbers, bank accounts, access keys, assigned
secrets, dates of birth, street addresses. Boosted regression trees (logistic loss, histograms, numpy) score a
span by its format (length, shares of digits, letters and marks, entropy) and its context (neighbours, line, certain spans nearby).

There are no labels for spans. A judge per kind knows some: check digits that hold, published forms of keys or a
word in front that names the thing make a span positive; check digits that fail, impossible numbers or a word
that names another thing make it negative; all others have no label and take no part in the fit. What the judges
look at is no trait of the trees, and neither are the four certain kinds. So the trees carry over from spans
that are announced to those that are not. The threshold of a kind is calibrated on judged spans held back from the
fit: the lowest score at which the stated precision holds; a kind with few of them has the one of all kinds. A span is
redacted if its judge accepts it or, where the judge cannot tell, if it reaches the threshold; the
best of overlapping ones, unless they touch a certain span.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relist.llm.boosting import Trees, boosted
from relist.llm.runtime import column, map_rows, shared, sliced, split_evenly, texts

# The forms of the four certain kinds.
EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a match starts where its digits do, so that a long run of digits is looked at once
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
KINDS = ("email", "ip", "card", "phone", "ssn", "iban", "key", "secret", "national", "birth", "address")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        if place % 2:
            value = value * 2 - 9 * (value > 4)
        total += value
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[Span]:
    """The leftmost match for each at sign starts with the run of local characters before it."""
    free = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in EMAIL_LOCAL:
            start -= 1
        domain = EMAIL_DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield "email", start, domain.end()
            free = domain.end()
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[Span]:
    """The certain spans, by kind and then by start."""
    found = list(emails(text))
    found += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split("."))]
    for match in CARD.finditer(text):
        digits = digits_of(match.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", match.start(), match.end()))
    found += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= len(digits_of(m.group())) <= 15]
    return found


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


@dataclass(frozen=True)
class Pii:
    """sample: judged proposals used for fitting at most; trees, depth, rate: of the boosting; precision: that a threshold must reach on held-back proposals; kind_least: held-back proposals a kind needs for a threshold of its own."""

    sample: int = 20_000
    trees: int = 40
    depth: int = 3
    rate: float = 0.3
    bins: int = 32
    precision: float = 0.98
    kind_least: int = 50


def word(names: str) -> re.Pattern[str]:
    """One of the names, as a word of its own, shortly before the end."""
    return re.compile(rf"(?<![^\W_])(?:{names})s?(?![^\W_])\W{{0,6}}(?:(?:is|no|nr|number|on|am|le|el)\W{{1,3}})?$", re.IGNORECASE)


SECRET = word(r"pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|key|credential")
CALLED = word(r"tel|phone|telephone|telefon|téléphone|teléfono|fax|mobile|mobil|cell|call")
SOCIAL = word(r"ssn|social security|social insurance")
BORN = word(r"born|birth|birthday|dob|date of birth|geboren|né|née|nacido|nacida")
DATED = word(r"updated|published|version|released|copyright|license|since|until|from|expires|due")
COUNTED = word(r"part|order|item|version|page|isbn|serial|article|model|id")
#: How published access keys begin.
KEY_FORM = re.compile(r"(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abp]-[A-Za-z0-9-]{10,48}|[sr]k_live_[A-Za-z0-9]{16,40}")


def before(text: str, start: int, cue: re.Pattern[str]) -> bool:
    return bool(cue.search(text[max(0, start - 32) : start]))


def judged_ssn(text: str, start: int, end: int) -> int:
    area, group, serial = text[start:end].split("-")
    if area in ("000", "666") or area >= "900" or group == "00" or serial == "0000" or before(text, start, COUNTED):
        return -1
    return int(before(text, start, SOCIAL))


def judged_iban(text: str, start: int, end: int) -> int:
    plain = text[start:end].replace(" ", "")
    turned = plain[4:] + plain[:4]
    return 1 if int("".join(str(int(c, 36)) for c in turned)) % 97 == 1 else -1


def judged_key(text: str, start: int, end: int) -> int:
    span = text[start:end]
    if KEY_FORM.fullmatch(span) or before(text, start, SECRET):
        return 1
    return -1 if span.isalpha() or span.isdigit() or before(text, start, COUNTED) else 0


def judged_secret(text: str, start: int, end: int) -> int:
    if before(text, start, SECRET):
        return 1
    return -1 if text[start:end].isalpha() or before(text, start, DATED) or before(text, start, COUNTED) else 0


def judged_national(text: str, start: int, end: int) -> int:
    return 1 if before(text, start, CALLED) else -1 if before(text, start, COUNTED) else 0


def judged_birth(text: str, start: int, end: int) -> int:
    return 1 if before(text, start, BORN) else -1 if before(text, start, DATED) else 0


def judged_address(text: str, start: int, end: int) -> int:
    return int(bool(STREET.search(text, start, end)))


STREET = re.compile(r"(?:Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Drive|Dr|Boulevard|Blvd|Rue|Calle|Plaza)\b|(?:stra(?:ß|ss)e|weg|platz|gasse)\b")
#: The generators: what may be of a kind, and its judge (1 yes, -1 no, 0 cannot tell). Every part is bounded or cannot go back, so that a text is looked at once.
GENERATORS = {
    "ssn": (re.compile(r"(?<![0-9-])([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])"), judged_ssn),
    "iban": (re.compile(r"(?<![A-Za-z0-9])([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])"), judged_iban),
    "key": (re.compile(r"(?<![A-Za-z0-9+/_-])([A-Za-z0-9+/_-]{20,}+)"), judged_key),
    "secret": (re.compile(r"[=:][ \t]{0,8}\"?([^\s\"]{6,}+)"), judged_secret),
    "national": (re.compile(r"(?<![0-9+.-])(\(?[0-9]{2,5}\)?[ ./-]{1,2}[0-9]{3,4}[ .-][0-9]{3,4})(?![0-9])"), judged_national),
    "birth": (re.compile(r"(?<![0-9.-])((?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}[./][0-9]{1,2}[./](?:19|20)[0-9]{2})(?![0-9-])"), judged_birth),
    "address": (re.compile(r"(?<![0-9A-Za-z.])([0-9]{1,5} (?:[A-Z][a-z]{1,20} ){0,3}[A-Z][a-z]{1,20}|[A-ZÄÖÜ][a-zäöüß]{1,24} [0-9]{1,4}[a-z]?)(?![0-9A-Za-z])"), judged_address),
}
SIDES = ' "=:(+,.'


def proposals(text: str, base: list[Span]) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, judgement) of the spans that may be personal and touch no certain one, by kind and start; they may overlap."""
    taken = sorted((start, end) for _, start, end in base)
    starts, ends = [s for s, _ in taken], list(accumulate((e for _, e in taken), max))
    found = []
    for kind, (form, judge) in GENERATORS.items():
        for match in form.finditer(text):
            start, end = match.span(1)
            near = bisect_left(starts, end)
            if near and ends[near - 1] > start:
                continue
            found.append((kind, start, end, judge(text, start, end)))
    return found


def traits(text: str, start: int, end: int, base: list[Span]) -> list[float]:
    """Format and context of a span; nothing that a judge looks at."""
    span = text[start:end]
    length = len(span)
    digit = sum("0" <= c <= "9" for c in span)
    upper = sum(c.isupper() for c in span)
    letter = sum(c.isalpha() for c in span)
    changes = sum(a.isdigit() != b.isdigit() for a, b in zip(span, span[1:], strict=False))
    counts = Counter(span).values()
    low, high = text.rfind("\n", max(0, start - 200), start), text.find("\n", end, end + 200)
    near = min((max(0, s - end, start - e) for _, s, e in base[:64]), default=10_000)
    return [
        length,
        digit / length,
        letter / length,
        upper / length,
        (length - digit - letter) / length,
        -sum(c / length * log2(c / length) for c in counts),
        changes / length,
        max(counts) / length,
        SIDES.find(text[start - 1 : start]) if start else -2,
        SIDES.find(text[end : end + 1]) if end < len(text) else -2,
        start - low if low >= 0 else 200,
        high - end if high >= 0 else 200,
        log2(1 + near),
        min(len(base), 16),
    ]


@dataclass
class Model:
    """Trees over the traits of a proposal, and by kind the score from which a proposal that its judge cannot tell is redacted."""

    trees: Trees | None
    threshold: dict[str, float]

    def accepted(self, kinds: list[str], judged: list[int], rows: list[list[float]]) -> tuple[np.ndarray, np.ndarray]:
        """Whether each proposal is redacted, and its score."""
        verdict = np.array(judged, np.int64)
        if self.trees is None or not rows:
            return verdict > 0, verdict.astype(float)
        scores = self.trees.scores(np.array(rows, float))
        enough = scores >= np.array([self.threshold.get(kind, self.threshold[""]) for kind in kinds])
        return (verdict > 0) | ((verdict == 0) & enough), scores + verdict


def train(docs: DataFrame, plan: Pii = Pii()) -> Model:
    """Fit on judged proposals of documents drawn by hash of their text, at most ``plan.sample`` of them."""
    share = min(1.0, plan.sample / max(1, docs.count()))
    drawn = docs.select("text").where(F.pmod(F.xxhash64("text", F.lit(11)), F.lit(1_000_000)) < int(share * 1_000_000))

    def run(batch: pa.RecordBatch) -> dict[str, object]:
        rows, kinds, labels = [], [], []
        for text in texts(batch):
            base = base_spans(text)
            for kind, start, end, judged in proposals(text, base):
                if judged:
                    rows.append(traits(text, start, end, base))
                    kinds.append(kind)
                    labels.append(int(judged > 0))
        return {"traits": rows, "kind": kinds, "label": labels}

    found = map_rows(split_evenly(drawn), "traits array<double>, kind string, label int", run)
    rows = found.withColumn("order", F.xxhash64("traits", "kind", "label")).orderBy("order", "kind", "label").limit(plan.sample).collect()
    if len({r.label for r in rows}) < 2:
        return Model(None, {"": 2.0})
    x, y = np.array([r.traits for r in rows], float), np.array([r.label for r in rows], float)
    kinds = np.array([r.kind for r in rows])
    held = np.arange(len(rows)) % 4 == 3
    if not held.any() or len(set(y[~held])) < 2:
        held = np.zeros(len(rows), bool)
    trees = boosted(x[~held], y[~held], plan.trees, plan.depth, plan.rate, plan.bins)
    judged = held if held.any() else ~held
    scores, truth, of = trees.scores(x[judged]), y[judged], kinds[judged]
    threshold = {"": calibrated(scores, truth, plan.precision)}
    for kind in sorted(set(of)):
        if (of == kind).sum() >= plan.kind_least:
            threshold[kind] = calibrated(scores[of == kind], truth[of == kind], plan.precision)
    return Model(trees, threshold)


def calibrated(scores: np.ndarray, truth: np.ndarray, precision: float) -> float:
    """The lowest score of at least a half from which on the precision holds; 2 where none does."""
    order = np.argsort(-scores, kind="stable")
    precise = np.cumsum(truth[order]) / np.arange(1, len(order) + 1) >= precision
    last_of_tie = np.diff(scores[order], append=-1.0) != 0
    good = np.flatnonzero(precise & last_of_tie)
    return max(0.5, float(scores[order][good[-1]])) if len(good) else 2.0


def added_spans(spans: list[tuple[str, int, int]], scores: np.ndarray) -> list[Span]:
    """The best of overlapping proposals (by score, then length), by start."""
    starts: list[int] = []
    kept: dict[int, Span] = {}
    for place in sorted(range(len(spans)), key=lambda k: (-scores[k], spans[k][1] - spans[k][2], spans[k][1], spans[k][0])):
        kind, start, end = spans[place]
        at = bisect_left(starts, start)
        if (at == len(starts) or starts[at] >= end) and (at == 0 or kept[starts[at - 1]][2] <= start):
            starts.insert(at, start)
            kept[start] = (kind, start, end)
    return [kept[start] for start in starts]


FOUND = "array<struct<kind: string, start: int, end: int>>"


def spans_of(batch_texts: Iterator[str], model: Model) -> Iterator[tuple[list[Span], list[Span]]]:
    """Certain and added spans of each text; the proposals of all of them are scored together."""
    base, offered, kinds, judged, rows = [], [], [], [], []
    for text in batch_texts:
        base.append(base_spans(text))
        offered.append(proposals(text, base[-1]))
        for kind, start, end, verdict in offered[-1]:
            kinds.append(kind)
            judged.append(verdict)
            rows.append(traits(text, start, end, base[-1]))
    accepted, scores = model.accepted(kinds, judged, rows)
    low = 0
    for known, spans in zip(base, offered, strict=True):
        chosen = [k for k in range(len(spans)) if accepted[low + k]]
        yield known, added_spans([spans[k][:3] for k in chosen], scores[low : low + len(spans)][chosen])
        low += len(spans)


def personal_data(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, base, added), a row per row of ``docs``: the certain spans by kind and start, and those that judges and trees add.

    Offsets are in code points, the end is exclusive. A null text counts as empty and has no span.
    More columns are ignored; repeated rows give repeated results.
    """
    sent = shared(docs.sparkSession, model)

    def run(batch: pa.RecordBatch) -> dict[str, object]:
        found = list(spans_of(texts(batch), sent.value))
        named = [[[dict(zip(("kind", "start", "end"), s, strict=True)) for s in row[side]] for row in found] for side in (0, 1)]
        return {"doc_id": column(batch, "doc_id"), "base": named[0], "added": named[1]}

    return map_rows(split_evenly(docs.select("doc_id", "text")), f"doc_id bigint, base {FOUND}, added {FOUND}", run)


def redacted(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with every found span of ``text`` replaced by its kind in brackets; all other columns as they are.

    Null and empty texts stay as they are; so do rows without doc_id and repeated rows but for their own text. Where
    certain spans overlap, the one that starts first and then the longest names the place.
    """
    sent = shared(docs.sparkSession, model)
    place = docs.columns.index("text")

    def clean(text: str, spans: list[Span]) -> str:
        parts, reached = [], 0
        for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
            if start >= reached:
                parts += [text[reached:start], f"[{kind}]"]
            reached = max(reached, end)
        return "".join([*parts, text[reached:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in sliced(whole):
                found = spans_of(texts(batch), sent.value)
                cleaned = [value.as_py() and clean(value.as_py(), base + added) for value, (base, added) in zip(batch.column(place), found, strict=True)]
                yield batch.set_column(place, batch.schema.field(place), pa.array(cleaned, batch.schema.field(place).type))

    return split_evenly(docs).mapInArrow(run, docs.schema)
