"""The pipeline over given tables, and every query against its SQL."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from relist.llm.catalog import ORACLES, QUERIES
from tests.llm.cases import frame, odd_rows
from tests.test_oracles import SF_DIR, TABLES, ordered


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    found = QUERIES[name](spark, SF_DIR)
    result = connection.execute(ORACLES[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(found.columns)
    assert ordered(found.select(*names).collect()) == ordered(result.fetchall())


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    first = docs
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_DIR).cache()
        counts.append(out.count())
        if name != "mixing":
            assert out.columns == first.columns
        docs = out
    assert counts == sorted(counts, reverse=True) and counts[0] > counts[4] == counts[5]
    ran = corpus_pipeline.run(spark, SF_DIR)
    assert ordered(ran.collect()) == ordered(docs.collect())


def test_stages_on_odd_rows(spark):
    for rows in (odd_rows(), []):
        docs = frame(spark, rows)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF_DIR)
            docs.collect()


def test_registered(spark):
    assert {f"op{n}_" for n in range(1, 14)} == {name.split("_")[0] + "_" for name in QUERIES}
    assert {*QUERIES, "pipeline"} <= set(contract.queries())
