"""Quality rules with controlled risk: cutoffs that labelled holdouts prove to reject few good documents in every stratum.

A rule rejects a document whose measure is above the rule's cutoff. One fold of the labelled documents
chooses how far each rule should go: the cutoff that rejects most bad documents, less a price for good ones.
The other fold has the last word, stratum by stratum. From the laxest cutoff on, the exact binomial
(Clopper-Pearson) upper bound of the rule's share of rejected good documents must stay within the rule's
part of the allowed share; the first cutoff that fails ends the rule there. Such a fixed sequence needs no
correction over cutoffs; over rules and strata the error is divided (Bonferroni). So with confidence
1 - ``error`` the rules of no stratum reject more than ``share`` of its good documents. A stratum with
too few labelled documents to prove anything keeps all of them.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from math import exp, lgamma, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from relist.llm.hashing import Words, mix
from relist.llm.runtime import bounded, column, cut_lineage, map_rows, split_evenly, stored, texts

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Measures in thousandths, 1,000 at most; a higher one is worse. ``spread`` is a hundredth of a code point a word.
RULES = ("symbols", "capitals", "marks", "bare", "repeats", "copies", "spread")
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[ord(c) for c in SPACE]] = True
_KIND = {
    "symbols": np.isin(np.arange(256), [ord(c) for c in SYMBOLS]),
    "upper": np.isin(np.arange(256), np.arange(ord("A"), ord("Z") + 1)),
    "lower": np.isin(np.arange(256), np.arange(ord("a"), ord("z") + 1)),
    "marks": np.isin(np.arange(256), [ord("!"), ord("?")]),
    "point": (np.arange(256) & 0xC0) != 0x80,
}
#: What makes a word more than marks: a letter, a digit, or anything beyond ASCII.
_SOLID = np.array([chr(c).isalnum() or c > 127 for c in range(256)])


@dataclass(frozen=True)
class RuleRisk:
    """share: of good documents, how many the rules of a stratum may reject at most; error: chance that this fails in any stratum; price: bad documents that one good one is worth when cutoffs are chosen; stratum: column whose values are the strata; fold: one of so many labelled documents chooses, the others prove."""

    share: float = 0.05
    error: float = 0.05
    price: int = 4
    stratum: str = "lang"
    fold: int = 4


def grid() -> list[int]:
    """The cutoffs in thousandths that are tried, from the laxest on: steps of a tenth, then zero."""
    found = [1000]
    while found[-1] > 1:
        found.append(min(found[-1] - 1, found[-1] * 9 // 10))
    return [*found, 0]


def measured_text(text: str) -> dict[str, int]:
    """The base counts of a text and the measures of the rules."""
    words = Words(text.encode("utf-8", "surrogatepass"))
    raw, n = words.raw, len(words)
    count = {kind: int(wanted[raw].sum()) for kind, wanted in _KIND.items()}
    inner = int((_KIND["point"][raw] & ~_IS_SPACE[raw]).sum())
    lines = Counter(line for line in text.split("\n") if line.strip(SPACE)) if n else Counter()
    solid = np.concatenate([[0], np.cumsum(_SOLID[raw])])
    bare = int((solid[words.end] == solid[words.start]).sum())
    covered = 0
    if n >= 3:
        h = words.hash
        _, name, times = np.unique(mix(mix(h[:-2]) + mix(h[1:-1] + np.uint64(1)) * np.uint64(3) + mix(h[2:] + np.uint64(2)) * np.uint64(5)), return_inverse=True, return_counts=True)
        again = times[name] >= 2
        inside = np.zeros(n, bool)
        for k in range(3):
            inside[k : n - 2 + k] |= again
        covered = int(inside.sum())
    many, copies = sum(lines.values()), sum(lines.values()) - len(lines)
    letters = count["upper"] + count["lower"]

    def per_mille(part: int, whole: int) -> int:
        return min(1000, 1000 * part // max(whole, 1))

    rules = (
        per_mille(count["symbols"], inner),
        per_mille(count["upper"], letters),
        per_mille(count["marks"], n),
        per_mille(bare, n),
        per_mille(covered, n),
        per_mille(copies, many),
        min(1000, 100 * inner // max(n, 1)),
    )
    return dict(zip((*BASE, *RULES), (n, inner, count["symbols"], copies, covered, *rules), strict=True))


def measured(docs: DataFrame, plan: RuleRisk) -> DataFrame:
    """(doc_id, stratum, base counts, measures, base_failed), a row per row of ``docs``; a null text is an empty one."""

    def run(batch: pa.RecordBatch) -> dict[str, object]:
        found = [measured_text(text) for text in texts(batch)]
        return {"doc_id": column(batch, "doc_id"), "stratum": column(batch, "stratum")} | {name: [row[name] for row in found] for name in (*BASE, *RULES)}

    columns = docs.select("doc_id", F.col(plan.stratum).cast("string").alias("stratum"), "text")
    schema = "doc_id bigint, stratum string, " + ", ".join(f"{name} bigint" for name in BASE) + ", " + ", ".join(f"{name} int" for name in RULES)
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    return map_rows(split_evenly(columns), schema, run).withColumn("base_failed", failed)


def tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p), by the continued fraction of the incomplete beta function."""
    if k >= n or p <= 0:
        return 1.0
    if p >= 1:
        return 0.0
    a, b, x = n - k, k + 1, 1 - p
    front = lgamma(a + b) - lgamma(a) - lgamma(b) + a * log(x) + b * log1p(-x)
    if x < (a + 1) / (a + b + 2):
        return exp(front) * _fraction(a, b, x) / a
    return 1 - exp(front) * _fraction(b, a, 1 - x) / b


def _fraction(a: float, b: float, x: float) -> float:
    least = 1e-300
    c, d = 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > least else least)
    value = d
    for m in range(1, 100_000):
        for term in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + term * d
            d = 1 / (d if abs(d) > least else least)
            c = 1 + term / c
            c = c if abs(c) > least else least
            value *= d * c
        if abs(d * c - 1) < 1e-14:
            break
    return value


def upper_bound(k: int, n: int, error: float) -> float:
    """The Clopper-Pearson bound: the largest share for which k or fewer of n are not less likely than ``error``."""
    if k >= n:
        return 1.0
    low, high = k / n, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if tail(k, n, middle) > error else (low, middle)
    return high


def histogram(rows: DataFrame, labels: DataFrame, plan: RuleRisk) -> DataFrame:
    """(stratum, choosing, rule, bin, good, bad): labelled documents by the first cutoff of the grid that rejects them.

    A document labelled both ways counts as good. Documents that fail the base rules take no part.
    """
    judged = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg((F.max("quality") > 0).alias("good"))
    rows = rows.where("not base_failed").join(judged, "doc_id")
    cutoffs = F.array(*(F.lit(c) for c in grid()))
    values = F.array(*(F.struct(F.lit(k).alias("rule"), F.col(name).alias("value")) for k, name in enumerate(RULES)))
    spread = rows.select("stratum", choosing(plan).alias("choosing"), "good", F.explode(values).alias("v"))
    first = F.size(F.filter(cutoffs, lambda c: c >= F.col("v.value")))
    spread = spread.select("stratum", "choosing", F.col("v.rule").alias("rule"), first.alias("bin"), "good")
    return spread.groupBy("stratum", "choosing", "rule", "bin").agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))


def choosing(plan: RuleRisk) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % plan.fold == 0


def wanted_steps(bins: DataFrame, plan: RuleRisk) -> dict[int, int]:
    """For each rule that is worth it, how many cutoffs of the grid it should go: most bad documents less the price of good ones, the laxest if equal."""
    rows = bins.where("choosing").groupBy("rule", "bin").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).collect()
    found = {}
    for rule in range(len(RULES)):
        gain = np.zeros(len(grid()) + 1, np.int64)
        for row in rows:
            if row.rule == rule:
                gain[row.bin] += row.bad - plan.price * row.good
        total = np.cumsum(gain[:-1])
        if total.max() > 0:
            found[rule] = int(total.argmax())
    return found


def proven_cutoffs(bins: DataFrame, wanted: dict[int, int], plan: RuleRisk) -> DataFrame:
    """(stratum, rule, cutoff, rejected, held, bound): the strictest proven cutoff of each rule in each stratum, with its bound."""
    proving = bins.where("not choosing")
    strata = proving.select("stratum").distinct().count()
    share, error = plan.share / max(1, len(wanted)), plan.error / max(1, len(wanted) * strata)
    target = StructType.fromDDL("stratum string, rule int, cutoff int, rejected bigint, held bigint, bound double")
    arrow = to_arrow_schema(target)

    def run(table: pa.Table) -> pa.Table:
        counts = {rule: np.zeros(len(grid()) + 1, np.int64) for rule in range(len(RULES))}
        for row in table.to_pylist():
            counts[row["rule"]][row["bin"]] += row["good"]
        found = []
        for rule, last in sorted(wanted.items()):
            held, rejected = int(counts[rule].sum()), np.cumsum(counts[rule][:-1])
            proven = None
            for step in range(last + 1):
                bound = upper_bound(int(rejected[step]), held, error) if held else 1.0
                if bound > share:
                    break
                proven = (step, int(rejected[step]), bound)
            if proven is not None:
                found.append({"stratum": table["stratum"][0].as_py(), "rule": rule, "cutoff": grid()[proven[0]], "rejected": proven[1], "held": held, "bound": proven[2]})
        return pa.Table.from_pylist(found, schema=arrow)

    return proving.groupBy("stratum").applyInArrow(run, target)


def ruled(docs: DataFrame, labels: DataFrame, plan: RuleRisk = RuleRisk()) -> DataFrame:
    """(doc_id, base counts, base_failed, kept, rules), a row per row of ``docs`` (doc_id, text and the stratum column; more are ignored).

    ``rules`` names the rules that reject the document. A null or empty text fails the base rules. A null
    stratum is a stratum of its own; a null doc_id is never labelled; rows that repeat a doc_id are judged
    each by its own text, and each counts if labelled. ``labels`` has doc_id and quality, null where unknown.
    """
    rows = stored(measured(docs, plan), "rule-measures")
    bins = cut_lineage(histogram(rows, labels, plan))
    cutoffs = proven_cutoffs(bins, wanted_steps(bins, plan), plan)
    by_stratum = cutoffs.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs"))
    by_stratum = bounded(cut_lineage(by_stratum).withColumnRenamed("stratum", "of"))
    joined = rows.join(by_stratum, F.col("stratum").eqNullSafe(F.col("of")), "left")
    broken = [F.when(F.col(name) > F.col("cutoffs")[F.lit(k)], F.lit(name)) for k, name in enumerate(RULES)]
    rules = F.array_compact(F.array(*broken))
    return joined.select("doc_id", *BASE, "base_failed", (~F.col("base_failed") & (F.size(rules) == 0)).alias("kept"), rules.alias("rules"))
