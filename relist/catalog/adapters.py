"""Benchmark tables seen as listings, raw ads and states.

The expressions here are plain SQL that both engines understand, so a query and its oracle start
from the same input. Everything after that is written twice: as operators, and as oracle SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relist.catalog.registry import table
from relist.runtime import spread, spread_evenly

NOW = "2024-02-15 12:00:00"
NOW_SQL = f"TIMESTAMP '{NOW}'"


def ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


SPARK_FORMATS = {
    "datetime": "date_format({}, 'yyyy-MM-dd HH:mm:ss')",
    "date": "date_format({}, 'yyyy-MM-dd')",
    "iso": "date_format({}, \"yyyy-MM-dd'T'HH:mm:ss\")",
}
DUCK_FORMATS = {
    "datetime": "strftime({}, '%Y-%m-%d %H:%M:%S')",
    "date": "strftime({}, '%Y-%m-%d')",
    "iso": "strftime({}, '%Y-%m-%dT%H:%M:%S')",
}


def select_list(columns: dict[str, str], formats: dict[str, str]) -> list[str]:
    """Expressions with ``<datetime:x>`` and the like replaced by the engine's formatting call."""
    out = []
    for name, expression in columns.items():
        for kind, call in formats.items():
            while f"<{kind}:" in expression:
                head, rest = expression.split(f"<{kind}:", 1)
                inner, tail = rest.split(">", 1)
                expression = head + call.format(inner) + tail
        out.append(f"{expression} AS {name}")
    return out


def spark_view(spark: SparkSession, sf_dir: str, source: str, columns: dict[str, str]) -> DataFrame:
    return spread(table(spark, sf_dir, source)).selectExpr(*select_list(columns, SPARK_FORMATS))


def duck_view(source: str, columns: dict[str, str]) -> str:
    return f"SELECT {', '.join(select_list(columns, DUCK_FORMATS))} FROM {source}"


# --- listings from events -------------------------------------------------------------------


def listing_columns(block: str) -> dict[str, str]:
    """All listing columns; listings with equal ``block`` and event type share their 24 exact fields."""
    u = f"({block})"
    return {
        "doc_id": "'[' || event_type || ']' || CAST(event_id AS STRING)",
        "original_id": "CASE WHEN event_id % 10 = 0 THEN '' ELSE CAST(event_id AS STRING) END",
        "parapi_unique_id": "event_id",
        "url": "CASE WHEN event_id % 9 = 0 THEN NULL ELSE 'https://ads.example.com/' || CAST(event_id AS STRING) END",
        "site_name": "event_type",
        "seller_type": f"CASE WHEN {u} % 2 = 0 THEN 'private' ELSE 'company' END",
        "name": f"'listing ' || CAST({u} AS STRING)",
        "last_checked": "CASE WHEN event_id % 8 = 0 THEN NULL ELSE ts + (1 + event_id % 72) * INTERVAL '1' HOUR END",
        "parsed_at": "ts",
        "offer_start": "ts",
        "offer_end": "CASE WHEN event_id % 7 = 0 THEN NULL ELSE ts + (event_id % 72) * INTERVAL '1' HOUR END",
        "initial_price": "value",
        "latest_price": "value",
        "is_new": f"({u} % 2 = 0)",
        "brand": f"'brand ' || CAST({u} % 7 AS STRING)",
        "model": f"'model ' || CAST({u} % 3 AS STRING)",
        "generation": f"CASE WHEN {u} % 4 = 0 THEN NULL ELSE 'gen ' || CAST({u} % 4 AS STRING) END",
        "modification": f"CASE WHEN {u} % 3 = 0 THEN NULL ELSE 'mod ' || CAST({u} % 5 AS STRING) END",
        "complectation": "CAST(NULL AS STRING)",
        "build_year": f"2000 + {u} % 20",
        "vin": f"CASE WHEN {u} % 3 = 0 THEN NULL ELSE 'VIN' || CAST({u} AS STRING) END",
        "engine_power": f"CAST(90 AS DOUBLE) + {u} % 50",
        "engine_volume_liters": f"CAST({u} % 4 AS DOUBLE) / 2",
        "fuel": f"CASE WHEN {u} % 2 = 0 THEN 'petrol' ELSE 'diesel' END",
        "gear_type": f"CASE WHEN {u} % 5 = 0 THEN NULL ELSE 'awd' END",
        "gear_box": f"CASE WHEN {u} % 3 = 0 THEN 'manual' ELSE 'automatic' END",
        "steering_position": "'left'",
        "body_type": f"'body ' || CAST({u} % 6 AS STRING)",
        "body_color": f"CASE WHEN {u} % 4 = 1 THEN NULL ELSE 'color ' || CAST({u} % 9 AS STRING) END",
        "doors_num": f"CAST(2 + {u} % 4 AS STRING)",
        "count_owner": f"CASE WHEN {u} % 6 = 0 THEN NULL ELSE {u} % 4 END",
        "condition": f"CASE WHEN {u} % 7 = 0 THEN NULL ELSE 'used' END",
        "mileage": "CASE WHEN event_id % 11 = 0 THEN NULL ELSE 100000 + event_id % 5000 END",
        "place": f"'city ' || CAST({u} % 6 AS STRING)",
        "region": f"CASE WHEN {u} % 5 = 0 THEN NULL ELSE 'region ' || CAST({u} % 5 AS STRING) END",
        "predecessor_id": "CAST(NULL AS STRING)",
        "successor_id": "CAST(NULL AS STRING)",
    }


CONTENDED = listing_columns("user_id % 15")
SPARSE = listing_columns("user_id")


def _dirty(columns: dict[str, str]) -> dict[str, str]:
    """Padded, blank and missing text, some claimed rows and some missing prices and starts."""
    return columns | {
        "name": f"CASE event_id % 10 WHEN 0 THEN ' ' || {columns['name']} || ' ' WHEN 1 THEN '' ELSE {columns['name']} END",
        "brand": f"CASE event_id % 12 WHEN 0 THEN NULL WHEN 1 THEN '  ' ELSE {columns['brand']} END",
        "initial_price": "CASE event_id % 9 WHEN 0 THEN NULL WHEN 1 THEN -value ELSE value END",
        "latest_price": "CASE WHEN event_id % 13 = 0 THEN NULL ELSE value END",
        "is_new": f"CASE WHEN event_id % 14 = 0 THEN NULL ELSE {columns['is_new']} END",
        "offer_start": "CASE WHEN event_id % 15 = 0 THEN NULL ELSE ts END",
        "site_name": "CASE WHEN event_id % 16 = 0 THEN NULL ELSE event_type END",
        "seller_type": f"CASE WHEN event_id % 18 = 0 THEN NULL ELSE {columns['seller_type']} END",
        "model": f"CASE WHEN event_id % 20 = 0 THEN NULL ELSE {columns['model']} END",
        "predecessor_id": "CASE WHEN event_id % 5 = 0 THEN 'p' || CAST(event_id AS STRING) END",
        "successor_id": "CASE WHEN event_id % 6 = 0 THEN 's' || CAST(event_id AS STRING) END",
    }


DIRTY = _dirty(CONTENDED)

LISTING_SETS = {"contended": CONTENDED, "sparse": SPARSE, "dirty": DIRTY}


def listings(spark: SparkSession, sf_dir: str, kind: str = "contended") -> DataFrame:
    return spark_view(spark, sf_dir, "events", LISTING_SETS[kind])


def listings_cte(kind: str = "contended", name: str = "listings") -> str:
    return f"{name} AS ({duck_view('events', LISTING_SETS[kind])})"


# --- dirty scalars from events --------------------------------------------------------------

SCALARS = {
    "event_id": "event_id",
    "ts": "ts",
    "value": "value",
    "event_type": "event_type",
    "txt": (
        "CASE event_id % 6 WHEN 0 THEN '' WHEN 1 THEN ' ' || chr(9) || chr(10) WHEN 2 THEN chr(9) || event_type || ' ' "
        "WHEN 3 THEN NULL ELSE event_type END"
    ),
    "number": (
        "CASE event_id % 10 WHEN 0 THEN '' WHEN 1 THEN ' ' || CAST(value AS STRING) || chr(9) WHEN 2 THEN 'abc' "
        "WHEN 3 THEN NULL WHEN 4 THEN CAST(event_id AS STRING) WHEN 5 THEN '-' || CAST(value AS STRING) "
        "WHEN 6 THEN '1e3' WHEN 7 THEN '1.5d' WHEN 8 THEN '0x1p3' ELSE CAST(value AS STRING) END"
    ),
    "flag": (
        "CASE event_id % 8 WHEN 0 THEN '1' WHEN 1 THEN 'TRUE' WHEN 2 THEN ' yes ' WHEN 3 THEN '0' WHEN 4 THEN 'False' "
        "WHEN 5 THEN 'no' WHEN 6 THEN 'maybe' ELSE NULL END"
    ),
    "time": (
        "CASE event_id % 7 WHEN 0 THEN <datetime:ts> WHEN 1 THEN <date:ts> WHEN 2 THEN 'bad' WHEN 3 THEN '' "
        "WHEN 4 THEN NULL WHEN 5 THEN ' ' || <datetime:ts> || ' ' ELSE CAST(ts AS STRING) END"
    ),
    "iso": (
        "CASE event_id % 8 WHEN 0 THEN <iso:ts> WHEN 1 THEN <iso:ts> || 'Z' WHEN 2 THEN <iso:ts> || '+03:00' "
        "WHEN 3 THEN <iso:ts> || '-0130' WHEN 4 THEN <date:ts> WHEN 5 THEN 'x' WHEN 6 THEN <iso:ts> || '.250Z' "
        "ELSE <datetime:ts> END"
    ),
    "image": (
        "CASE event_id % 5 WHEN 0 THEN '//img.example.com/' || CAST(event_id AS STRING) "
        "WHEN 1 THEN 'https://img.example.com/a' WHEN 2 THEN 'ftp://x' WHEN 3 THEN '' "
        "ELSE ' http://img.example.com/b ' END"
    ),
}


def scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_view(spark, sf_dir, "events", SCALARS)


SCALARS_CTE = f"scalars AS ({duck_view('events', SCALARS)})"

# Whitespace as a DuckDB character set.
DUCK_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def duck_strip(expression: str) -> str:
    return f"trim({expression}, {DUCK_SPACES})"


def duck_blank(expression: str) -> str:
    return f"nullif({duck_strip(expression)}, '')"


# --- raw ads from events --------------------------------------------------------------------

RAW_SCALARS = {
    "id": "CASE WHEN event_id % 19 = 0 THEN ' ' ELSE ' ' || CAST(event_id AS STRING) END",
    "unique_id": "CASE WHEN event_id % 17 = 0 THEN 'x' ELSE CAST(event_id AS STRING) || '.0' END",
    "site_id": "CASE event_id % 6 WHEN 0 THEN '2' WHEN 1 THEN '3' WHEN 2 THEN '4' WHEN 3 THEN '9' ELSE NULL END",
    "checked": "CASE WHEN event_id % 13 = 0 THEN '' ELSE <datetime:ts + INTERVAL '2' HOUR> END",
    "parsed": "CASE WHEN event_id % 5 = 0 THEN NULL ELSE <datetime:ts + INTERVAL '1' HOUR> END",
    "added": "CASE event_id % 4 WHEN 0 THEN <date:ts> WHEN 1 THEN 'bad' ELSE <datetime:ts> END",
    "price": SCALARS["number"],
    "actual": SCALARS["flag"],
    "company": "CASE event_id % 3 WHEN 0 THEN '1' WHEN 1 THEN '0' ELSE '' END",
    "is_new": "CASE event_id % 4 WHEN 0 THEN 'yes' WHEN 1 THEN '0' ELSE NULL END",
    "url": "CASE WHEN event_id % 11 = 0 THEN ' ' ELSE 'https://ads.example.com/' || CAST(event_id AS STRING) END",
    "name": SCALARS["txt"],
    "user_ident": "CASE WHEN event_id % 2 = 0 THEN 'u' || CAST(user_id AS STRING) END",
    "mark": "'Brand ' || CAST(user_id % 7 AS STRING) || ' '",
    "model": "CASE WHEN event_id % 7 = 0 THEN '' ELSE 'Model ' || CAST(user_id % 3 AS STRING) END",
    "model_id": "CAST(user_id % 3 AS STRING)",
    "generation": "CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'G' || CAST(user_id % 4 AS STRING) END",
    "generation_id": "CASE WHEN event_id % 3 = 0 THEN '' ELSE CAST(user_id % 4 AS STRING) END",
    "modification": "'m' || CAST(user_id % 5 AS STRING)",
    "modification_id": "CASE WHEN event_id % 8 = 0 THEN 'none' ELSE CAST(user_id AS STRING) END",
    "complectation": "CAST(NULL AS STRING)",
    "complectation_id": "' '",
    "year": "CAST(2000 + user_id % 20 AS STRING)",
    "vin": "CASE WHEN event_id % 4 = 0 THEN NULL ELSE 'VIN' || CAST(user_id AS STRING) END",
    "hourse": "CAST(90 + user_id % 50 AS STRING) || '.5'",
    "engine_vol": "CASE WHEN event_id % 9 = 0 THEN 'big' ELSE '1.6' END",
    "owners_num": "CASE WHEN event_id % 6 = 0 THEN NULL ELSE CAST(user_id % 4 AS STRING) END",
    "run": "CASE WHEN event_id % 11 = 0 THEN '' ELSE CAST(100000 + event_id % 5000 AS STRING) END",
    "run_type": "CASE WHEN event_id % 10 = 0 THEN 'mi' WHEN event_id % 10 = 1 THEN ' ' END",
    "actual_views": "CAST(event_id % 100 AS STRING) || '.9'",
    "phone": "CASE WHEN event_id % 5 = 1 THEN ' 555 ' END",
    "phone_protection": SCALARS["flag"],
    "city": "'city ' || CAST(user_id % 6 AS STRING)",
    "region": "CASE WHEN event_id % 5 = 0 THEN chr(9) ELSE 'region' END",
    "city_latitude": "CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(user_id % 90 AS STRING) || '.25' END",
    "city_longitude": "CASE WHEN event_id % 6 = 0 THEN NULL ELSE CAST(user_id % 180 AS STRING) END",
}
# name/value pairs; the last pair of a name wins
RAW_PARAMS = [
    ("' Тип Двигателя '", "'бензин'"),
    ("'Привод'", "CASE WHEN event_id % 2 = 0 THEN 'полный' ELSE ' ' END"),
    ("CASE WHEN event_id % 3 = 0 THEN ' ' ELSE 'руль' END", "'левый'"),
    ("CASE WHEN event_id % 4 = 0 THEN 'привод' ELSE 'цвет' END", "CASE WHEN event_id % 8 = 0 THEN NULL ELSE 'синий' END"),
    ("'число дверей'", "CAST(2 + user_id % 4 AS STRING)"),
]
# price, datetime, views, type
RAW_HISTORY = [
    ("CASE WHEN event_id % 3 = 0 THEN 'x' ELSE CAST(value AS STRING) END", "<datetime:ts + INTERVAL '3' DAY>", "'7'", "'up'"),
    ("CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST(value + 1 AS STRING) END", "<datetime:ts - INTERVAL '3' DAY>", "'x'", "' '"),
    ("CASE WHEN event_id % 5 = 0 THEN '' ELSE CAST(value + 2 AS STRING) END", "'?'", "NULL", "'down'"),
]
RAW_IMAGES = [SCALARS["image"], "'//img.example.com/last'", "CASE WHEN event_id % 2 = 0 THEN 'none' ELSE 'http://img.example.com/c' END"]

RAW_COLUMNS: dict[str, str] = {
    "event_id": "event_id",
    "source": (
        "CASE event_id % 7 WHEN 0 THEN ' Avito ' WHEN 1 THEN 'auto.drom' WHEN 2 THEN 'autoru' WHEN 3 THEN event_type "
        "WHEN 4 THEN ' ' ELSE upper(event_type) END"
    ),
    "ingested_at": "ts + INTERVAL '3' HOUR",
} | {f"r_{name}": expression for name, expression in RAW_SCALARS.items()}
for _i, (_name, _value) in enumerate(RAW_PARAMS):
    RAW_COLUMNS |= {f"p{_i}_name": _name, f"p{_i}_value": _value}
for _i, _item in enumerate(RAW_HISTORY):
    RAW_COLUMNS |= {f"h{_i}_{part}": e for part, e in zip(("price", "datetime", "views", "type"), _item, strict=True)}
for _i, _url in enumerate(RAW_IMAGES):
    RAW_COLUMNS |= {f"i{_i}": _url}

RAW_CTE = f"raw AS ({duck_view('events', RAW_COLUMNS)})"


def raw_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(event_id, source, ingested_at, payload STRING)`` with junk between the array items."""
    flat = spread_evenly(table(spark, sf_dir, "events")).selectExpr(*select_list(RAW_COLUMNS, SPARK_FORMATS))
    text = F.struct(*[F.col(f"r_{name}").cast("string").alias(name) for name in RAW_SCALARS])

    def item(parts: dict[str, str]):
        return F.to_json(F.struct(*[F.col(c).cast("string").alias(alias) for alias, c in parts.items()]))

    def array(items: list) -> list:
        out = [F.lit("["), items[0]]
        for one in items[1:]:
            out += [F.lit(',"junk",5,'), one]
        return [*out, F.lit("]")]

    params = array([item({"name": f"p{i}_name", "value": f"p{i}_value"}) for i in range(len(RAW_PARAMS))])
    history = array(
        [
            item({part: f"h{i}_{part}" for part in ("price", "datetime", "views", "type")})
            for i in range(len(RAW_HISTORY))
        ]
    )
    images = array([item({"image": f"i{i}"}) for i in range(len(RAW_IMAGES))])
    body = F.to_json(text)
    payload = F.concat(
        F.left(body, F.length(body) - 1),
        F.lit(',"params":'), *params, F.lit(',"advert_info":'), *history, F.lit(',"advert_image":'), *images, F.lit("}"),
    )
    return flat.select("event_id", "source", "ingested_at", payload.alias("payload"))


# --- raw archive rows from orders -----------------------------------------------------------

ORDERS_RAW = {
    "raw_id": "CAST(o_orderkey AS STRING)",
    "source": "o_orderstatus",
    "ingested_at": "o_orderdate",
    "payload": "'{\"price\":' || CAST(o_totalprice AS STRING) || '}'",
}


def orders_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_view(spark, sf_dir, "orders", ORDERS_RAW)


ORDERS_RAW_CTE = f"raw AS ({duck_view('orders', ORDERS_RAW)})"


# --- link tables from events ----------------------------------------------------------------

# Forty consecutive events form a chain, every tenth chain a closed cycle; some links elsewhere are
# missing, dangling, blank or shared.
_ID = "'d' || CAST({} AS STRING)"
CHAIN_COLUMNS = {
    "doc_id": _ID.format("event_id"),
    "predecessor_id": (
        f"CASE WHEN event_id % 400 < 40 AND event_id % 40 = 0 THEN {_ID.format('(event_id + 39)')} "
        f"WHEN event_id % 400 < 40 THEN {_ID.format('(event_id - 1)')} "
        "WHEN event_id % 29 = 0 OR event_id % 40 = 0 THEN NULL WHEN event_id % 31 = 0 THEN 'gone' || CAST(event_id AS STRING) "
        f"WHEN event_id % 37 = 0 THEN ' ' WHEN event_id % 47 = 0 THEN {_ID.format('(event_id - event_id % 40)')} "
        f"ELSE {_ID.format('(event_id - 1)')} END"
    ),
    "successor_id": (
        f"CASE WHEN event_id % 400 < 40 AND event_id % 40 = 39 THEN {_ID.format('(event_id - 39)')} "
        f"WHEN event_id % 400 < 40 THEN {_ID.format('(event_id + 1)')} "
        "WHEN event_id % 23 = 0 OR event_id % 40 = 39 THEN NULL WHEN event_id % 41 = 0 THEN 'lost' || CAST(event_id AS STRING) "
        f"WHEN event_id % 43 = 0 THEN '' ELSE {_ID.format('(event_id + 1)')} END"
    ),
    "offer_start": "ts",
    "site_name": "event_type",
}


def chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_view(spark, sf_dir, "events", CHAIN_COLUMNS)


CHAINS_CTE = f"chains AS ({duck_view('events', CHAIN_COLUMNS)})"
