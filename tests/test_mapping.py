from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from relist.catalog.adapters import raw_ads
from relist.operators import mapping
from relist.runtime import spread_evenly
from relist.schemas import LISTING_SCHEMA

INGESTED = datetime(2025, 6, 30, 23, 59, 1)


def full_ad(**changes):
    """An ad in which every key that a column reads has a value of its own, made from the name of the key."""
    texts = {key: f"  some {key} " for key in (*mapping.TEXT_FIELDS.values(), *mapping.TEXT_OR_EMPTY_FIELDS.values())}
    whole = {key: f" {200 + n} " for n, key in enumerate(mapping.INTEGER_FIELDS.values())}
    halves = {key: 40.5 + n for n, key in enumerate(mapping.NUMBER_FIELDS.values())}
    rest = {
        "unique_id": 77_001, "company": True, "is_new": "1", "actual": "0", "phone_protection": 0, "run_type": "miles", "price": "15",
        "checked": "2025-05-04 03:02:01", "added": "2025-05-01", "parsed": "2025-05-02 00:00:09", "city_latitude": "-3.5", "city_longitude": 170,
        "params": [{"name": f" {key.upper()} ", "value": f"a {key} "} for key in mapping.PARAM_FIELDS.values()],
        "advert_info": [
            {"price": 18, "views": 3, "datetime": "2025-05-03 00:00:00", "type": "raised"},
            {"price": "16.5", "views": None, "datetime": "2025-05-01 06:00:00", "type": " "},
        ],
        "advert_image": [{"image": "//pictures.example.org/front"}, {"image": " "}, {"image": "http://pictures.example.org/back"}],
    }
    return texts | whole | halves | rest | changes


def raw(spark, *pairs):
    rows = [(source, INGESTED, body if isinstance(body, str) else json.dumps(body)) for source, body in pairs]
    return mapping.parse_payload(spark.createDataFrame(rows, "source string, ingested_at timestamp_ntz, payload string"))


def one(spark, source, body):
    return mapping.map_listings(raw(spark, (source, body))).first()


def test_every_column_has_its_key(spark):
    row = one(spark, "Garage-List", full_ad())
    for name, key in (mapping.TEXT_FIELDS | mapping.TEXT_OR_EMPTY_FIELDS).items():
        assert row[name] == f"some {key}", name
    assert [row[name] for name in mapping.INTEGER_FIELDS] == [200 + n for n in range(len(mapping.INTEGER_FIELDS))]
    assert [row[name] for name in mapping.NUMBER_FIELDS] == [40.5 + n for n in range(len(mapping.NUMBER_FIELDS))]
    assert {name: row[name] for name in mapping.PARAM_FIELDS} == {name: f"a {key}" for name, key in mapping.PARAM_FIELDS.items()}
    assert (row["doc_id"], row["site_name"], row["parapi_unique_id"]) == ("[garage-list]77001", "garage-list", 77_001)
    assert (row["last_checked"], row["offer_start"], row["offer_end"]) == (datetime(2025, 5, 4, 3, 2, 1), datetime(2025, 5, 1), datetime(2025, 5, 4, 3, 2, 1))
    assert (row["initial_price"], row["latest_price"]) == (16.5, 18.0)
    assert [tuple(item) for item in row["trans_history"]] == [
        (datetime(2025, 5, 1, 6), 16.5, None, None), (datetime(2025, 5, 3), 18.0, 3, "raised"),
    ]
    assert (row["seller_type"], row["is_new"], row["phone_protection"], row["mileage_units"]) == ("company", True, False, "miles")
    assert tuple(row["location"]) == (-3.5, 170.0)
    assert row["images"] == ["https://pictures.example.org/front", "http://pictures.example.org/back"]


def test_flags(spark):
    flags = [("1", "1", "1", "1"), (False, 0, "0", False), (None, None, None, None)]
    names = ("company", "is_new", "phone_protection", "actual")
    rows = mapping.map_listings(raw(spark, *(("s", full_ad(unique_id=n, **dict(zip(names, flag, strict=True)))) for n, flag in enumerate(flags)))).collect()
    found = {r["parapi_unique_id"]: (r["seller_type"], r["is_new"], r["phone_protection"], r["offer_end"] is not None) for r in rows}
    assert found == {0: ("company", True, True, False), 1: ("private", False, False, True), 2: ("unknown", False, None, False)}


def test_missing_parts(spark):
    row = one(spark, " ", {"params": None, "advert_image": "none", "city_latitude": "north"})
    assert (row["site_name"], row["mileage_units"], row["url"], row["location"], row["images"], row["fuel"]) == ("unknown", "km", "", None, [], None)


def test_schema_is_the_contract(spark):
    mapped = mapping.map_listings(raw(spark, ("drom", full_ad())))
    assert [(f.name, f.dataType) for f in mapped.schema.fields[1:]] == [(f.name, f.dataType) for f in LISTING_SCHEMA.fields]


def test_prices_without_history(spark):
    row = one(spark, "drom", {"unique_id": 1, "price": "432100.25", "advert_info": []})
    assert (row["initial_price"], row["latest_price"], row["trans_history"]) == (432100.25, 432100.25, [])
    assert one(spark, "drom", {"price": "x"})["initial_price"] == 0.0


def test_times_fall_back(spark):
    row = one(spark, "drom", {"parsed": "2026-01-01 10:00:00", "actual": "0", "advert_info": [{"price": 5}, "junk", {"price": None}]})
    assert (row["last_checked"], row["offer_end"]) == (INGESTED, INGESTED)
    assert row["offer_start"] == datetime(2026, 1, 1, 10)
    assert [(h["datetime"], h["price"]) for h in row["trans_history"]] == [(datetime(2026, 1, 1, 10), 5.0)]


def test_history_order_is_stable(spark):
    items = [{"price": p, "datetime": t} for p, t in (("3", "2026-01-03"), ("1", "2026-01-01"), ("2", "2026-01-01"))]
    row = one(spark, "drom", {"advert_info": items})
    assert [h["price"] for h in row["trans_history"]] == [1.0, 2.0, 3.0]
    assert (row["initial_price"], row["latest_price"]) == (1.0, 3.0)


def test_last_param_wins_even_when_null(spark):
    params = [{"name": " ПРИВОД ", "value": "a"}, 5, None, ["x"], {"name": "привод", "value": " "}, {"value": "z"}]
    assert one(spark, "drom", {"params": params})["gear_type"] is None
    assert one(spark, "drom", {"params": "text"})["gear_type"] is None


def test_missing_unique_id_collapses_to_zero(spark):
    assert one(spark, "drom", {})["doc_id"] == "[drom]0"


def test_invalid_rows_are_set_aside_or_fail(spark):
    bad = {
        "[1]": ["payload is not an object"],
        "not json": ["payload is not an object"],
        json.dumps({"id": {"a": 1}, "name": True}): ["id must be text, not object", "name must be text, not boolean"],
        json.dumps({"id": 5.5}): ["id must be text, not decimal"],
        json.dumps({"vin": 7, "params": [{"name": "Цвет", "value": "a"}, {"name": " цвет ", "value": [1]}]}): ["vin must be text, not bigint", "params: цвет must be text, not array"],
        json.dumps({"advert_info": [{"price": "5", "type": {"x": 1}}, {"price": 6, "type": 1}]}): ["advert_info: type must be text, not object", "advert_info: type must be text, not bigint"],
        json.dumps({"advert_image": [{"image": "http:// bad"}]}): ["invalid image url"],
    }
    good = [full_ad(), full_ad(id=12), {"id": None, "vin": " "}, {"params": [{"name": "цвет", "value": 5}, {"name": "ЦВЕТ", "value": None}, {"name": "other", "value": 5}, 7], "advert_info": [{"type": 5}]}]
    rows = raw(spark, *((str(n), body) for n, body in enumerate([*bad, *good])))
    valid, invalid = mapping.split_invalid(rows)
    assert {r["source"]: r["invalid_reasons"] for r in invalid.collect()} == {str(n): reasons for n, reasons in enumerate(bad.values())}
    assert valid.count() == len(good) and valid.columns == rows.columns
    with pytest.raises(Exception, match="USER_RAISED_EXCEPTION"):
        mapping.split_invalid(rows, strict=True)[0].count()


def test_candidate_defaults(spark):
    from tests.builders import listings

    now = datetime(2026, 5, 1)
    rows = listings(
        spark,
        [
            {"doc_id": "a", "original_id": "", "latest_price": 5.0, "offer_end": datetime(2026, 1, 1)},
            {"doc_id": "b", "original_id": "7", "last_checked": datetime(2026, 2, 1)},
        ],
    )
    out = {r["doc_id"]: r for r in mapping.candidate_defaults(rows, F.lit(now).cast("timestamp_ntz")).collect()}
    a, b = out["a"], out["b"]
    assert (a["original_id"], a["site_name"], a["name"], a["offer_start"], a["initial_price"], a["is_new"]) == ("a", "unknown", "", datetime(2026, 1, 1), 5.0, False)
    assert (b["original_id"], b["offer_start"], b["initial_price"], b["latest_price"]) == ("7", datetime(2026, 2, 1), 0.0, 0.0)


def test_reasons_are_not_computed_below_the_deal_of_the_rows(spark):
    body = json.dumps(full_ad())
    rows = spark.createDataFrame([("a", INGESTED, body), ("b", INGESTED, "[]")], "source string, ingested_at timestamp_ntz, payload string")
    for part, source in zip(mapping.split_invalid(mapping.parse_payload(rows.repartition(5))), ("a", "b"), strict=True):
        assert [r["source"] for r in part.collect()] == [source]
        plan = part._jdf.queryExecution().optimizedPlan().toString()
        assert "Repartition" in plan and "variant" not in plan[plan.index("Repartition") :]


def test_payloads_are_dealt_over_tasks_by_rows_and_not_by_row_groups(spark, tmp_path):
    rows = spark.range(60_000).selectExpr(
        "id AS event_id", "TIMESTAMP_NTZ '2025-02-01 10:00:00' AS ts", "id % 7 AS user_id", "'view' AS event_type", "CAST(id AS DOUBLE) AS value", "'{}' AS props"
    )
    rows.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        ads = raw_ads(spark, str(tmp_path))
        sizes = ads.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sum(r["count"] for r in sizes) == 60_000 and max(r["count"] for r in sizes) < 15_000


def test_large_tables_have_more_tasks(spark):
    assert spread_evenly(spark.range(1_000), 10).rdd.getNumPartitions() == 100
    assert spread_evenly(spark.range(0), 10).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
