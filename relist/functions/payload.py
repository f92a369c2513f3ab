"""Typed views on a VARIANT payload."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from relist.functions.text import blank_to_null, image_url, strip, to_bigint, to_bool, to_double
from relist.functions.times import payload_datetime

# Source aliases and numeric site ids.
SITE_ALIASES = {
    "avito": "avito",
    "drom": "drom",
    "auto.drom": "drom",
    "auto_drom": "drom",
    "auto": "auto",
    "auto.ru": "auto",
    "auto_ru": "auto",
    "autoru": "auto",
}
SITE_IDS = {"2": "avito", "3": "auto", "4": "drom"}


def text(payload: Column, key: str) -> Column:
    return F.try_variant_get(payload, f"$.{key}", "string")


def texts(payload: Column, keys: Iterable[str]) -> Column:
    """Several scalar fields as text in one struct, read in one pass; null unless an object."""
    return F.try_variant_get(payload, "$", f"struct<{','.join(f'{key}:string' for key in dict.fromkeys(keys))}>")


def is_object(item: Column) -> Column:
    # only an object can be read as a struct; the field need not exist
    return texts(item, ["id"]).isNotNull()


def object_items(payload: Column, key: str, fields: Iterable[str]) -> Column:
    """Object elements of an array field, each as a struct of texts; absent, null or no array is empty."""
    items = F.try_variant_get(payload, f"$.{key}", "array<variant>")
    read = F.filter(F.transform(items, lambda item: texts(item, fields)), lambda item: item.isNotNull())
    return F.coalesce(read, F.filter(F.array(texts(payload, fields)), lambda item: F.lit(False)))


def named_params(payload: Column) -> Column:
    """``params`` as an array of (name, value) with names lower-cased and nameless items dropped."""
    pairs = F.transform(
        object_items(payload, "params", ("name", "value")),
        lambda p: F.struct(F.lower(blank_to_null(p["name"])).alias("name"), blank_to_null(p["value"]).alias("value")),
    )
    return F.filter(pairs, lambda p: p["name"].isNotNull())


def param_value(params: Column, name: str) -> Column:
    """Value of the last entry with this name, null values included."""
    hits = F.filter(params, lambda p: p["name"] == F.lit(name))
    return F.try_element_at(hits, F.lit(-1))["value"]


def image_list(payload: Column) -> Column:
    urls = F.transform(object_items(payload, "advert_image", ("image",)), lambda i: image_url(i["image"]))
    return F.filter(urls, lambda u: u.isNotNull())


def price_history(payload: Column, default_time: Column) -> Column:
    """Priced items ordered by time; equal times keep their order in the payload."""
    numbered = F.transform(
        object_items(payload, "advert_info", ("price", "datetime", "views", "type")),
        lambda item, position: F.struct(
            F.coalesce(payload_datetime(item["datetime"]), default_time).alias("datetime"),
            position.alias("position"),
            to_double(item["price"]).alias("price"),
            to_bigint(item["views"]).alias("views"),
            blank_to_null(item["type"]).alias("event_type"),
        ),
    )
    priced = F.filter(numbered, lambda item: item["price"].isNotNull())
    return F.transform(
        F.array_sort(priced),
        lambda item: F.struct(
            item["datetime"].alias("datetime"),
            item["price"].alias("price"),
            item["views"].alias("views"),
            item["event_type"].alias("event_type"),
        ),
    )


def initial_price(history: Column, price: Column) -> Column:
    return F.coalesce(F.try_element_at(history, F.lit(1))["price"], price, F.lit(0.0))


def latest_price(history: Column, first_price: Column) -> Column:
    return F.coalesce(F.try_element_at(history, F.lit(-1))["price"], first_price)


def location(latitude: Column, longitude: Column) -> Column:
    latitude, longitude = to_double(latitude), to_double(longitude)
    return F.when(
        latitude.isNotNull() | longitude.isNotNull(), F.struct(latitude.alias("lat"), longitude.alias("lon"))
    )


def lookup(table: dict[str, str], key: Column) -> Column:
    entries = [F.lit(part) for pair in table.items() for part in pair]
    return F.try_element_at(F.create_map(*entries), key)


def site_name(source: Column, site_id: Column) -> Column:
    folded = F.lower(strip(source))
    return F.coalesce(
        lookup(SITE_ALIASES, folded), lookup(SITE_IDS, site_id), F.nullif(folded, F.lit("")), F.lit("unknown")
    )


def seller_type(company: Column) -> Column:
    flag = to_bool(company)
    return F.when(flag, F.lit("company")).when(~flag, F.lit("private")).otherwise(F.lit("unknown"))


def time_chain(checked: Column, parsed: Column, added: Column, ingested_at: Column) -> tuple[Column, Column, Column]:
    """(last_checked, parsed time, offer_start): each falls back to the one before it."""
    last_checked = F.coalesce(payload_datetime(checked), ingested_at)
    parsed_at = F.coalesce(payload_datetime(parsed), last_checked)
    return last_checked, parsed_at, F.coalesce(payload_datetime(added), parsed_at)


def offer_end(actual: Column, last_checked: Column) -> Column:
    return F.when(~to_bool(actual), last_checked)
