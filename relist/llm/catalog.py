"""Registered queries of the operators, one per operator, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relist.llm.decontaminate import Decontamination, contaminated
from relist.llm.fingerprint import Fingerprints, fingerprints
from relist.llm.dialogue import damaged as damaged_conversations, repaired_conversations
from relist.llm.fixity import Fixity, audit
from relist.llm.line_dedup import without_repeats
from relist.llm.mixing import Mixing, mixed
from relist.llm.near_dedup import NearDedup, near_duplicates
from relist.llm import pii, quality, toxicity
from relist.llm.oracles import DIALOGUE_SQL, FIXITY_SQL, MIXING_SQL, NEAR_DEDUP_SQL, RULES_SQL, SPELLING_SQL, TOKENS_SQL
from relist.llm.quality_rules import ruled
from relist.llm.spelling import spelling_variants
from relist.llm.token_scan import TokenScan, token_counts

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its repeated lines, and the numbers of the lines that went."""
    return without_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "dropped", "text")


@query
def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document: 3-word shingles, similarity 0.85."""
    return near_duplicates(table(spark, sf_dir, "documents"), NearDedup(words=3, percent=85, bands=24, band_rows=4))


ORACLES["op2_near_dedup"] = NEAR_DEDUP_SQL


@query
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document that holds a copy of a test item, the item, the score and where the copy is."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Decontamination())


def held_out(modulus: int, remainder: int) -> Column:
    """Whether a document is kept from fitting; a row without doc_id is not."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % modulus == remainder, F.lit(False))


@query
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts and digest of the certain spans, and all spans."""
    docs = table(spark, sf_dir, "documents")
    found = pii.personal_data(docs, pii.train(docs))
    counts = [F.expr(f"size(filter(base, s -> s.kind = '{kind}'))").cast("bigint").alias(f"n_{kind}") for kind in pii.KINDS[:4]]
    joined = [F.concat_ws(",", F.transform(name, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))) for name in ("base", "spans")]
    found = found.withColumn("spans", F.concat("base", "added"))
    return found.select("doc_id", *counts, F.sha2(joined[0], 256).alias("base_sha256"), joined[1].alias("spans"))


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; labels of four fifths of the documents may be learned from."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(~held_out(5, 0)))
    return toxicity.scored(docs, model).select("doc_id", held_out(5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; labels of two thirds of the documents may be learned from."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    net = quality.train(docs, labels.where(~held_out(3, 1)))
    return quality.scored(docs, net).select("doc_id", held_out(3, 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def damaged(pages: DataFrame) -> DataFrame:
    """A replica of ``pages``: of some pages a byte is changed, some are a byte longer, two of each thousand are lost, and one is there again with other content."""
    sign = F.substring(F.md5(F.col("page_id").cast("string")), 1, 2)
    hurt = F.when((sign < "05") & (F.substring("html", 1, 1) == "<"), F.concat(F.lit("#"), F.substring("html", 2, 1 << 30)))
    longer = F.when((sign >= "05") & (sign < "08"), F.concat("html", F.lit("!")))
    kept = pages.where("page_id % 1000 not in (500, 999)").withColumn("html", F.coalesce(hurt, longer, "html"))
    inserted = pages.where("page_id % 1000 = 250").withColumns({"url": F.lit("inserted"), "html": F.lit("more")})
    return kept.unionByName(inserted)


@query
def op6_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records in which a damaged replica of the pages departs from them."""
    pages = table(spark, sf_dir, "pages")
    return audit(pages, damaged(pages), Fixity())


ORACLES["op6_fixity"] = FIXITY_SQL


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, counted in flat token files."""
    return token_counts(table(spark, sf_dir, "documents"), TokenScan())


ORACLES["op7_token_counts"] = TOKENS_SQL


@query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken from every document; weights 1, 2, 3 and at most three epochs."""
    return mixed(table(spark, sf_dir, "documents"), Mixing()).drop("source")


ORACLES["op9_mixing"] = MIXING_SQL


@query
def op10_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited copy, and how alike they are."""
    return fingerprints(table(spark, sf_dir, "documents"), Fingerprints())


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents, its near words, and the common form that it varies."""
    return spelling_variants(table(spark, sf_dir, "documents"))


ORACLES["op11_spelling_variants"] = SPELLING_SQL


@query
def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document, and whether the base rules and the proven rules keep it."""
    return ruled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("rules")


ORACLES["op12_quality_rules"] = RULES_SQL


@query
def op13_dialogue_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of every damaged conversation, its cheapest edits and the digest of what they leave."""
    turns = table(spark, sf_dir, "conversations")
    return repaired_conversations(damaged_conversations(turns), turns.select("conv_id"))


ORACLES["op13_dialogue_repair"] = DIALOGUE_SQL
