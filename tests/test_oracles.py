"""Every registered query against its SQL, on the smallest tables (or those named by TEST_SF_DIR)."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from relist.catalog import load

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark",
    "labels", "conversations",
)
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def comparable(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def ordered(rows):
    plain = [tuple(comparable(v) for v in row) for row in rows]
    return sorted(plain, key=lambda row: [(v is None, str(v)) for v in row])


@pytest.mark.parametrize("name", sorted(load().queries))
def test_query(spark, duck, name):
    frame = contract.queries()[name](spark, SF_DIR)
    names = sorted(frame.columns)
    result = duck.execute(contract.oracle_sql()[name])
    types = {c[0]: str(c[1]) for c in result.description}
    order = [[c[0] for c in result.description].index(n) for n in names] if set(types) == set(names) else None
    assert order is not None, (sorted(types), names)
    assert {f.name: TYPES[f.dataType.simpleString()] for f in frame.schema} == types
    want = [tuple(row[i] for i in order) for row in result.fetchall()]
    assert ordered(frame.select(*names).collect()) == ordered(want)


def test_contract(spark):
    assert set(load().oracles) == set(load().queries)
    assert set(load().queries) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() > 0
