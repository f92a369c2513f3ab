"""Queries for the value normalisation and mapping operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relist.catalog import adapters as A
from relist.catalog.registry import query, table
from relist.functions import payload as P
from relist.functions import text as T
from relist.functions import times as D
from relist.operators import mapping
from relist.operators.candidates import BLOCK_FIELDS, clean_keys

SCALARS = A.SCALARS_CTE


def _scalar(expression: str, name: str, extra: str = "") -> str:
    return f"WITH {SCALARS} SELECT event_id, {expression} AS {name}{extra} FROM scalars"


@query("norm_blank", _scalar(A.duck_blank("txt"), "v"))
def norm_blank(spark: SparkSession, sf: str) -> DataFrame:
    return A.scalars(spark, sf).select("event_id", T.blank_to_null(F.col("txt")).alias("v"))


DUCK_NUMBER = f"TRY_CAST({A.duck_strip('number')} AS DOUBLE)"


@query("norm_float", _scalar(DUCK_NUMBER, "v"))
def norm_float(spark: SparkSession, sf: str) -> DataFrame:
    return A.scalars(spark, sf).select("event_id", T.to_double(F.col("number")).alias("v"))


@query("norm_int", _scalar(f"CAST(trunc({DUCK_NUMBER}) AS BIGINT)", "v"))
def norm_int(spark: SparkSession, sf: str) -> DataFrame:
    return A.scalars(spark, sf).select("event_id", T.to_bigint(F.col("number")).alias("v"))


def duck_bool(expression: str) -> str:
    word = f"lower({A.duck_strip(expression)})"
    return f"(CASE WHEN {word} IN ('1', 'true', 'yes') THEN true WHEN {word} IN ('0', 'false', 'no') THEN false END)"


@query("norm_bool", _scalar(duck_bool("flag"), "v"))
def norm_bool(spark: SparkSession, sf: str) -> DataFrame:
    return A.scalars(spark, sf).select("event_id", T.to_bool(F.col("flag")).alias("v"))


def duck_datetime(expression: str, time_needed: bool = False) -> str:
    text = A.duck_strip(expression)
    tail = r" \d{1,2}:\d{1,2}:\d{1,2}"
    pattern = rf"\d{{4}}-\d{{1,2}}-\d{{1,2}}{tail if time_needed else f'({tail})?'}"
    return f"(CASE WHEN regexp_full_match({text}, '{pattern}') THEN TRY_CAST({text} AS TIMESTAMP) END)"


@query("norm_datetime", _scalar(duck_datetime("time"), "v"))
def norm_datetime(spark: SparkSession, sf: str) -> DataFrame:
    return A.scalars(spark, sf).select("event_id", D.payload_datetime(F.col("time")).alias("v"))


@query("parse_checked", _scalar(duck_datetime("time", True), "v"))
def parse_checked(spark: SparkSession, sf: str) -> DataFrame:
    return A.scalars(spark, sf).select("event_id", D.checked_datetime(F.col("time")).alias("v"))


# By construction of the column: what the spelled offset means in UTC.
DUCK_ISO = (
    "(CASE event_id % 8 WHEN 2 THEN date_trunc('second', ts) - INTERVAL 3 HOUR "
    "WHEN 3 THEN date_trunc('second', ts) + INTERVAL 90 MINUTE WHEN 4 THEN CAST(date_trunc('day', ts) AS TIMESTAMP) "
    "WHEN 5 THEN NULL WHEN 6 THEN date_trunc('second', ts) + INTERVAL 250 MILLISECOND ELSE date_trunc('second', ts) END)"
)


@query("parse_iso", _scalar(DUCK_ISO, "v"))
def parse_iso(spark: SparkSession, sf: str) -> DataFrame:
    return A.scalars(spark, sf).select("event_id", D.iso_datetime(F.col("iso")).alias("v"))


@query(
    "parse_ingested_at",
    f"WITH {A.SCALARS_CTE} SELECT event_id, {DUCK_ISO} AS v, CASE WHEN event_id % 8 = 5 THEN 'Invalid ingested_at value: ' || coalesce(iso, 'null') END AS error FROM scalars",
)
def parse_ingested_at(spark: SparkSession, sf: str) -> DataFrame:
    """Every value, or the error with which the strict form fails the job."""
    value = F.col("iso")
    return A.scalars(spark, sf).select("event_id", D.ingested_at(value).alias("v"), D.ingested_at_error(value).alias("error"))


def duck_image(expression: str) -> str:
    url = A.duck_strip(expression)
    return (
        f"(CASE WHEN {url} LIKE '//%' THEN 'https:' || {url} "
        f"WHEN {url} LIKE 'http://%' OR {url} LIKE 'https://%' THEN {url} END)"
    )


@query("norm_url", f"SELECT page_id, {duck_image('u')} AS v FROM (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN url ELSE substr(url, strpos(url, '//')) END AS u FROM pages) p")
def norm_url(spark: SparkSession, sf: str) -> DataFrame:
    url = F.when(F.col("page_id") % 2 == 0, F.col("url")).otherwise(F.expr("substr(url, instr(url, '//'))"))
    return table(spark, sf, "pages").select("page_id", T.image_url(url).alias("v"))


def parsed_raw(spark: SparkSession, sf: str) -> DataFrame:
    return mapping.parse_payload(A.raw_ads(spark, sf))


def duck_param(name: str) -> str:
    """Last non-blank name equal to ``name``."""
    branches = "".join(
        f" WHEN lower({A.duck_strip(f'p{i}_name')}) = '{name}' THEN {A.duck_blank(f'p{i}_value')}"
        for i in reversed(range(len(A.RAW_PARAMS)))
    )
    return f"(CASE{branches} END)"


@query(
    "params_map",
    f"WITH {A.RAW_CTE} SELECT event_id, "
    + ", ".join(f"{duck_param(key)} AS {name}" for name, key in mapping.PARAM_FIELDS.items())
    + " FROM raw",
)
def params_map(spark: SparkSession, sf: str) -> DataFrame:
    named = parsed_raw(spark, sf).select("event_id", P.named_params(F.col("payload")).alias("params"))
    return named.select(
        "event_id", *[P.param_value(F.col("params"), key).alias(name) for name, key in mapping.PARAM_FIELDS.items()]
    )


DUCK_IMAGES = "concat_ws(' ', " + ", ".join(duck_image(f"i{i}") for i in range(len(A.RAW_IMAGES))) + ")"


@query("image_list", f"WITH {A.RAW_CTE} SELECT event_id, {DUCK_IMAGES} AS images FROM raw")
def image_list(spark: SparkSession, sf: str) -> DataFrame:
    images = P.image_list(F.col("payload"))
    return parsed_raw(spark, sf).select("event_id", F.array_join(images, " ").alias("images"))


DUCK_CHECKED = f"coalesce({duck_datetime('r_checked')}, ingested_at)"
DUCK_PARSED = f"coalesce({duck_datetime('r_parsed')}, {DUCK_CHECKED})"
DUCK_ADDED = f"coalesce({duck_datetime('r_added')}, {DUCK_PARSED})"


def duck_double(expression: str) -> str:
    return f"TRY_CAST({A.duck_strip(expression)} AS DOUBLE)"


def duck_int(expression: str) -> str:
    return f"CAST(trunc({duck_double(expression)}) AS BIGINT)"


HISTORY_CTE = "history AS (" + " UNION ALL ".join(
    f"SELECT event_id, {i} AS position, coalesce({duck_datetime(f'h{i}_datetime')}, {DUCK_PARSED}) AS moment, "
    f"{duck_double(f'h{i}_price')} AS price, {duck_int(f'h{i}_views')} AS views, {A.duck_blank(f'h{i}_type')} AS kind "
    f"FROM raw WHERE {duck_double(f'h{i}_price')} IS NOT NULL"
    for i in range(len(A.RAW_HISTORY))
) + ")"
BOUNDS_CTE = (
    "bounds AS (SELECT event_id, string_agg(epoch_us(moment) || ':' || CAST(round(price * 100) AS BIGINT) || ':' || coalesce(CAST(views AS VARCHAR), '-') || ':' || coalesce(kind, '-'), ';' "
    "ORDER BY moment, position) AS items, arg_min(price, (moment, position)) AS first_price, "
    "arg_max(price, (moment, position)) AS last_price FROM history GROUP BY event_id)"
)


@query(
    "price_history",
    f"WITH {A.RAW_CTE}, {HISTORY_CTE} SELECT event_id, "
    "CAST(row_number() OVER (PARTITION BY event_id ORDER BY moment, position) - 1 AS BIGINT) AS place, "
    "moment, price, views, kind FROM history",
)
def price_history(spark: SparkSession, sf: str) -> DataFrame:
    payload = F.col("payload")
    _, parsed, _ = P.time_chain(P.text(payload, "checked"), P.text(payload, "parsed"), P.text(payload, "added"), F.col("ingested_at"))
    items = parsed_raw(spark, sf).select("event_id", F.posexplode(P.price_history(payload, parsed)).alias("place", "item"))
    return items.select(
        "event_id",
        F.col("place").cast("bigint").alias("place"),
        F.col("item.datetime").alias("moment"),
        F.col("item.price").alias("price"),
        F.col("item.views").alias("views"),
        F.col("item.event_type").alias("kind"),
    )


DUCK_INITIAL = f"coalesce(first_price, {duck_double('r_price')}, 0.0)"


@query(
    "price_bounds",
    f"WITH {A.RAW_CTE}, {HISTORY_CTE}, {BOUNDS_CTE} SELECT raw.event_id, {DUCK_INITIAL} AS initial_price, "
    f"coalesce(last_price, {DUCK_INITIAL}) AS latest_price FROM raw LEFT JOIN bounds ON raw.event_id = bounds.event_id",
)
def price_bounds(spark: SparkSession, sf: str) -> DataFrame:
    payload = F.col("payload")
    _, parsed, _ = P.time_chain(P.text(payload, "checked"), P.text(payload, "parsed"), P.text(payload, "added"), F.col("ingested_at"))
    staged = parsed_raw(spark, sf).select(
        "event_id", P.price_history(payload, parsed).alias("history"), T.to_double(P.text(payload, "price")).alias("price")
    )
    first = P.initial_price(F.col("history"), F.col("price"))
    return staged.select("event_id", first.alias("initial_price"), P.latest_price(F.col("history"), first).alias("latest_price"))


@query(
    "location_struct",
    f"WITH {A.RAW_CTE}, c AS (SELECT event_id, {duck_double('r_city_latitude')} AS lat, {duck_double('r_city_longitude')} AS lon FROM raw) "
    "SELECT event_id, lat IS NOT NULL OR lon IS NOT NULL AS located, lat, lon FROM c",
)
def location_struct(spark: SparkSession, sf: str) -> DataFrame:
    payload = F.col("payload")
    placed = parsed_raw(spark, sf).select("event_id", P.location(P.text(payload, "city_latitude"), P.text(payload, "city_longitude")).alias("location"))
    return placed.select(
        "event_id",
        F.col("location").isNotNull().alias("located"),
        F.col("location.lat").alias("lat"),
        F.col("location.lon").alias("lon"),
    )


_SOURCE = f"lower({A.duck_strip('source')})"
DUCK_SITE = (
    f"(CASE WHEN {_SOURCE} = 'avito' THEN 'avito' WHEN {_SOURCE} IN ('drom', 'auto.drom', 'auto_drom') THEN 'drom' "
    f"WHEN {_SOURCE} IN ('auto', 'auto.ru', 'auto_ru', 'autoru') THEN 'auto' WHEN r_site_id = '2' THEN 'avito' "
    f"WHEN r_site_id = '3' THEN 'auto' WHEN r_site_id = '4' THEN 'drom' WHEN {_SOURCE} = '' THEN 'unknown' ELSE {_SOURCE} END)"
)


@query("site_name", f"WITH {A.RAW_CTE} SELECT event_id, {DUCK_SITE} AS site FROM raw")
def site_name(spark: SparkSession, sf: str) -> DataFrame:
    return parsed_raw(spark, sf).select(
        "event_id", P.site_name(F.col("source"), P.text(F.col("payload"), "site_id")).alias("site")
    )


DUCK_SELLER = "(CASE r_company WHEN '1' THEN 'company' WHEN '0' THEN 'private' ELSE 'unknown' END)"


@query("seller_type", f"WITH {A.RAW_CTE} SELECT event_id, {DUCK_SELLER} AS seller FROM raw")
def seller_type(spark: SparkSession, sf: str) -> DataFrame:
    return parsed_raw(spark, sf).select("event_id", P.seller_type(P.text(F.col("payload"), "company")).alias("seller"))


@query(
    "time_chain",
    f"WITH {A.RAW_CTE} SELECT event_id, {DUCK_CHECKED} AS last_checked, {DUCK_PARSED} AS parsed_time, {DUCK_ADDED} AS offer_start FROM raw",
)
def time_chain(spark: SparkSession, sf: str) -> DataFrame:
    payload = F.col("payload")
    checked, parsed, start = P.time_chain(
        P.text(payload, "checked"), P.text(payload, "parsed"), P.text(payload, "added"), F.col("ingested_at")
    )
    return parsed_raw(spark, sf).select(
        "event_id", checked.alias("last_checked"), parsed.alias("parsed_time"), start.alias("offer_start")
    )


DUCK_END = f"(CASE WHEN NOT {duck_bool('r_actual')} THEN {DUCK_CHECKED} END)"


@query("offer_end", f"WITH {A.RAW_CTE} SELECT event_id, {DUCK_END} AS offer_end FROM raw")
def offer_end(spark: SparkSession, sf: str) -> DataFrame:
    payload = F.col("payload")
    checked, _, _ = P.time_chain(P.text(payload, "checked"), F.lit(None).cast("string"), F.lit(None).cast("string"), F.col("ingested_at"))
    return parsed_raw(spark, sf).select("event_id", P.offer_end(P.text(payload, "actual"), checked).alias("offer_end"))


DUCK_UNIQUE = f"coalesce({duck_int('r_unique_id')}, 0)"
DUCK_LISTING: dict[str, str] = (
    {
        "doc_id": f"'[' || {DUCK_SITE} || ']' || CAST({DUCK_UNIQUE} AS VARCHAR)",
        "parapi_unique_id": DUCK_UNIQUE,
        "site_name": DUCK_SITE,
        "seller_type": DUCK_SELLER,
        "last_checked": DUCK_CHECKED,
        "parsed_at": A.NOW_SQL,
        "offer_start": DUCK_ADDED,
        "history": "coalesce(items, '')",
        "initial_price": DUCK_INITIAL,
        "latest_price": f"coalesce(last_price, {DUCK_INITIAL})",
        "is_new": f"coalesce({duck_bool('r_is_new')}, false)",
        "mileage_units": f"coalesce({A.duck_blank('r_run_type')}, 'km')",
        "phone_protection": duck_bool("r_phone_protection"),
        "lat": duck_double("r_city_latitude"),
        "lon": duck_double("r_city_longitude"),
        "offer_end": DUCK_END,
        "images": DUCK_IMAGES,
        "parapi_brand_id": "CAST(NULL AS VARCHAR)",
        "predecessor_id": "CAST(NULL AS VARCHAR)",
        "successor_id": "CAST(NULL AS VARCHAR)",
    }
    | {name: A.duck_blank(f"r_{key}") for name, key in mapping.TEXT_FIELDS.items()}
    | {name: f"coalesce({A.duck_blank(f'r_{key}')}, '')" for name, key in mapping.TEXT_OR_EMPTY_FIELDS.items()}
    | {name: duck_int(f"r_{key}") for name, key in mapping.INTEGER_FIELDS.items()}
    | {name: duck_double(f"r_{key}") for name, key in mapping.NUMBER_FIELDS.items()}
    | {name: duck_param(key) for name, key in mapping.PARAM_FIELDS.items()}
)
DUCK_LISTINGS = (
    f"WITH {A.RAW_CTE}, {HISTORY_CTE}, {BOUNDS_CTE} SELECT "
    + ", ".join(f"{expression} AS {name}" for name, expression in DUCK_LISTING.items())
    + " FROM raw LEFT JOIN bounds ON raw.event_id = bounds.event_id"
)


def mapped(spark: SparkSession, sf: str) -> DataFrame:
    return mapping.map_listings(parsed_raw(spark, sf), A.ntz(A.NOW))


@query("map_listing", DUCK_LISTINGS)
def map_listing(spark: SparkSession, sf: str) -> DataFrame:
    def written(item: Column) -> Column:
        views, kind = (F.coalesce(item[name].cast("string"), F.lit("-")) for name in ("views", "event_type"))
        return F.concat_ws(":", D.epoch_micros(item["datetime"]).cast("string"), F.round(item["price"] * 100).cast("bigint").cast("string"), views, kind)

    shaped = {
        "history": F.array_join(F.transform("trans_history", written), ";"),
        "lat": F.col("location.lat"),
        "lon": F.col("location.lon"),
        "images": F.array_join("images", " "),
    }
    return mapped(spark, sf).select(*[shaped.get(name, F.col(name)).alias(name) for name in DUCK_LISTING])


@query("doc_id", f"WITH {A.RAW_CTE} SELECT event_id, '[' || {DUCK_SITE} || ']' || CAST({DUCK_UNIQUE} AS VARCHAR) AS doc_id FROM raw")
def doc_id(spark: SparkSession, sf: str) -> DataFrame:
    payload = F.col("payload")
    site = P.site_name(F.col("source"), P.text(payload, "site_id"))
    key = mapping.doc_id(site, F.coalesce(T.to_bigint(P.text(payload, "unique_id")), F.lit(0)))
    return parsed_raw(spark, sf).select("event_id", key.alias("doc_id"))


@query(
    "candidate_defaults",
    f"WITH {A.listings_cte('dirty')} SELECT doc_id, coalesce(nullif(original_id, ''), doc_id) AS original_id, coalesce(url, '') AS url, "
    "coalesce(site_name, 'unknown') AS site_name, coalesce(seller_type, 'unknown') AS seller_type, name, coalesce(brand, '') AS brand, "
    f"coalesce(model, '') AS model, coalesce(last_checked, {A.NOW_SQL}) AS last_checked, "
    f"coalesce(offer_start, offer_end, last_checked, {A.NOW_SQL}) AS offer_start, "
    "coalesce(initial_price, latest_price, 0.0) AS initial_price, "
    "coalesce(latest_price, initial_price, 0.0) AS latest_price, coalesce(is_new, false) AS is_new FROM listings",
)
def candidate_defaults(spark: SparkSession, sf: str) -> DataFrame:
    return mapping.candidate_defaults(A.listings(spark, sf, "dirty"), A.ntz(A.NOW)).select(
        "doc_id", "original_id", "url", "site_name", "seller_type", "name", "brand", "model", "last_checked",
        "offer_start", "initial_price", "latest_price", "is_new",
    )


@query(
    "clean_keys",
    f"WITH {A.listings_cte('dirty')} SELECT doc_id, "
    + ", ".join(
        f"{A.duck_blank(name) if name not in ('build_year', 'engine_power', 'engine_volume_liters', 'count_owner', 'is_new') else name} AS {name}"
        for name in BLOCK_FIELDS
    )
    + " FROM listings",
)
def clean_match_keys(spark: SparkSession, sf: str) -> DataFrame:
    return clean_keys(A.listings(spark, sf, "dirty")).select("doc_id", *BLOCK_FIELDS)


@query(
    "listing_summary",
    f"WITH {A.listings_cte('dirty')} SELECT doc_id AS id, site_name, name, brand, model, offer_start, offer_end, latest_price, mileage, "
    "predecessor_id, successor_id, build_year AS year FROM listings",
)
def listing_summary(spark: SparkSession, sf: str) -> DataFrame:
    rows = A.listings(spark, sf, "dirty")
    short = mapping.short_view(rows).select(F.col("doc_id").alias("id"), "year")
    return mapping.listing_summary(rows).join(short, "id")


@query(
    "month_bounds",
    "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS this_month, "
    "CAST(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH AS TIMESTAMP) AS next_month FROM orders",
)
def month_bounds(spark: SparkSession, sf: str) -> DataFrame:
    day = F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey", D.month_start(day).alias("this_month"), D.next_month_start(day).alias("next_month")
    )


# Of ten ads one each is not an object, has a nested text field, a broken image, a number in a text field, a nested
# parameter, a history type that is no text, and all three of the last.
VIN, PARAM, TYPE = "vin must be text, not bigint", "params: состояние must be text, not object", "advert_info: type must be text, not boolean"


@query(
    "invalid_split",
    "SELECT event_id, CASE event_id % 10 WHEN 1 THEN 'payload is not an object' WHEN 2 THEN 'city must be text, not object' "
    f"WHEN 3 THEN 'invalid image url' WHEN 4 THEN '{VIN}' WHEN 5 THEN '{PARAM}' WHEN 6 THEN '{TYPE}' WHEN 7 THEN '{VIN}; {PARAM}; {TYPE}' END AS reasons FROM events",
)
def invalid_split(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_id") % 10
    payload = F.col("payload")

    def field(value: str) -> Column:
        """The payload with one more field in front, and the field of that name out of the way."""
        name = value.split('"')[1]
        renamed = F.replace(payload, F.lit(f'"{name}":'), F.lit(f'"{name}_old":'))
        return F.concat(F.lit("{" + value + ","), F.substring(renamed, 2, 1 << 30))

    vin, city = '"vin":5', '"city":{"a":1}'
    param, typed = '"params":[{"name":"Состояние","value":{"a":1}}]', '"advert_info":[{"price":1,"type":true},{"type":1}]'
    broken = (
        F.when(kind == 1, F.concat(F.lit("["), payload, F.lit("]")))
        .when(kind == 2, field(city))
        .when(kind == 3, F.replace(payload, F.lit("//img.example.com/last"), F.lit("//img example/last")))
        .when(kind == 4, field(vin))
        .when(kind == 5, field(param))
        .when(kind == 6, field(typed))
        .otherwise(payload)
    )
    raw = A.raw_ads(spark, sf).withColumn("payload", broken)
    for value in (vin, param, typed):
        raw = raw.withColumn("payload", F.when(kind == 7, field(value)).otherwise(payload))
    valid, invalid = mapping.split_invalid(mapping.parse_payload(raw))
    return valid.select("event_id", F.lit(None).cast("string").alias("reasons")).unionByName(
        invalid.select("event_id", F.array_join("invalid_reasons", "; ").alias("reasons"))
    )
