"""Rows for tests."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from relist.operators.candidates import BLOCK_TEXT_FIELDS

LISTING_DDL = (
    "doc_id string, original_id string, url string, "
    + ", ".join(f"{name} string" for name in BLOCK_TEXT_FIELDS)
    + ", build_year bigint, engine_power double, engine_volume_liters double, count_owner bigint, is_new boolean, "
    "last_checked timestamp_ntz, parsed_at timestamp_ntz, offer_start timestamp_ntz, offer_end timestamp_ntz, "
    "initial_price double, latest_price double, mileage bigint, predecessor_id string, successor_id string"
)
LISTING_NAMES = [part.strip().split(" ")[0] for part in LISTING_DDL.split(",")]


def listings(spark: SparkSession, rows: list[dict]) -> DataFrame:
    unknown = {key for row in rows for key in row} - set(LISTING_NAMES)
    assert not unknown, unknown
    return spark.createDataFrame([tuple(row.get(name) for name in LISTING_NAMES) for row in rows], LISTING_DDL)


def listing(doc_id: str, start: datetime | None, end: datetime | None = None, **fields) -> dict:
    row = {
        "doc_id": doc_id,
        "site_name": "site",
        "seller_type": "company",
        "name": "name",
        "brand": "brand",
        "model": "model",
        "is_new": False,
        "offer_start": start,
        "offer_end": end,
        "initial_price": 8_000.0,
        "latest_price": 8_000.0,
        "mileage": 40_000,
    }
    return row | fields


def hours(count: float) -> timedelta:
    return timedelta(hours=count)


def rows_of(df: DataFrame, *names: str) -> set[tuple]:
    return {tuple(row[name] for name in names) for row in df.select(*names).collect()}
