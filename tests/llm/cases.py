"""Hand-made documents with every odd case, and frames built from them."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size int, root string, key string, row double, part string, base int"


def frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """(doc_id, text) or (doc_id, text, source) rows as documents with further columns whose names operators use inside."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1] or ""), 7, "root", "key", 0.5, "part", 3) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def prose(seed: int, words: int) -> str:
    """Invented prose; equal seeds give equal texts."""
    draw = random.Random(seed)
    return " ".join("".join(draw.choice(["ba", "lo", "ti", "ren", "sha", "mu", "ek", "dor"]) for _ in range(draw.randint(2, 4))) for _ in range(words))


def edited(text: str, seed: int, changes: int) -> str:
    draw = random.Random(seed)
    words = text.split()
    for place in draw.sample(range(len(words)), changes):
        words[place] = f"zz{draw.randint(0, 10**6)}"
    return " ".join(words)


def odd_rows() -> list[tuple]:
    """Nulls, empty and blank texts, repeated rows, a null id and a very long text."""
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (5, "one two"), (None, "no name here at all to see"), (None, None),
        (6, prose(6, 40)), (6, prose(6, 40)), (7, "x" * 50_000), (8, prose(8, 9_000)), (9, "Ümläut É ß 日本語 \U0001f600 ok"),
    ]
