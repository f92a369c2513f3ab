"""Raw payloads to typed listings, and views of a listing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relist.functions import payload as P
from relist.functions.text import blank_to_null, to_bigint, to_bool, to_double
from relist.schemas import LISTING_SCHEMA

# Payload keys behind the plain text, integer, number and parameter fields.
TEXT_FIELDS = {
    "original_id": "id",
    "parapi_user_ident": "user_ident",
    "parapi_model_id": "model_id",
    "generation": "generation",
    "parapi_generation_id": "generation_id",
    "modification": "modification",
    "complectation": "complectation",
    "parapi_complectation_id": "complectation_id",
    "vin": "vin",
    "phone": "phone",
    "place": "city",
    "region": "region",
}
TEXT_OR_EMPTY_FIELDS = {"url": "url", "name": "name", "brand": "mark", "model": "model"}
INTEGER_FIELDS = {
    "parapi_modification_id": "modification_id",
    "build_year": "year",
    "count_owner": "owners_num",
    "mileage": "run",
    "views_total": "actual_views",
}
NUMBER_FIELDS = {"engine_power": "hourse", "engine_volume_liters": "engine_vol"}
PARAM_FIELDS = {
    "fuel": "тип двигателя",
    "gear_type": "привод",
    "gear_box": "коробка передач",
    "steering_position": "руль",
    "body_type": "тип кузова",
    "body_color": "цвет",
    "doors_num": "число дверей",
    "condition": "состояние",
}
OTHER_FIELDS = (
    "checked",
    "parsed",
    "added",
    "price",
    "unique_id",
    "site_id",
    "company",
    "is_new",
    "run_type",
    "phone_protection",
    "actual",
    "city_latitude",
    "city_longitude",
)
SCALAR_KEYS = (
    *TEXT_FIELDS.values(),
    *TEXT_OR_EMPTY_FIELDS.values(),
    *INTEGER_FIELDS.values(),
    *NUMBER_FIELDS.values(),
    *OTHER_FIELDS,
)
# Fields of the two report views.
SUMMARY_FIELDS = (
    "site_name",
    "name",
    "brand",
    "model",
    "offer_start",
    "offer_end",
    "latest_price",
    "mileage",
    "predecessor_id",
    "successor_id",
)
SHORT_FIELDS = {
    "brand": "brand",
    "model": "model",
    "build_year": "year",
    "latest_price": "price",
    "mileage": "mileage",
    "name": "name",
}


def parse_payload(raw: DataFrame) -> DataFrame:
    """Read the JSON text once; malformed text becomes a null payload."""
    return raw.withColumn("payload", F.try_parse_json("payload"))


def map_listings(raw: DataFrame, parsed_at: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Map ``raw(source, ingested_at, payload VARIANT)`` to the listing schema.

    ``doc_id`` is added in front, and the ``keep`` columns of ``raw`` at the end.
    """
    payload = F.col("payload")
    parsed_at = F.localtimestamp() if parsed_at is None else parsed_at
    value = F.col("value")
    last_checked, parsed_time, offer_start = P.time_chain(
        value["checked"], value["parsed"], value["added"], F.col("ingested_at")
    )
    read = raw.select("source", "ingested_at", "payload", P.texts(payload, SCALAR_KEYS).alias("value"), *keep)
    staged = read.select(
        "source",
        "payload",
        "value",
        last_checked.alias("last_checked"),
        parsed_time.alias("parsed_time"),
        offer_start.alias("offer_start"),
        P.named_params(payload).alias("params"),
        *keep,
    ).withColumn("trans_history", P.price_history(payload, F.col("parsed_time")))
    staged = staged.withColumn("initial_price", P.initial_price(F.col("trans_history"), to_double(value["price"])))

    fields: dict[str, Column] = {
        "parapi_unique_id": F.coalesce(to_bigint(value["unique_id"]), F.lit(0)),
        "site_name": P.site_name(F.col("source"), value["site_id"]),
        "seller_type": P.seller_type(value["company"]),
        "last_checked": F.col("last_checked"),
        "parsed_at": parsed_at,
        "offer_start": F.col("offer_start"),
        "trans_history": F.col("trans_history"),
        "initial_price": F.col("initial_price"),
        "latest_price": P.latest_price(F.col("trans_history"), F.col("initial_price")),
        "is_new": F.coalesce(to_bool(value["is_new"]), F.lit(False)),
        "mileage_units": F.coalesce(blank_to_null(value["run_type"]), F.lit("km")),
        "phone_protection": to_bool(value["phone_protection"]),
        "location": P.location(value["city_latitude"], value["city_longitude"]),
        "offer_end": P.offer_end(value["actual"], F.col("last_checked")),
        "images": P.image_list(payload),
    }
    for name, key in TEXT_FIELDS.items():
        fields[name] = blank_to_null(value[key])
    for name, key in TEXT_OR_EMPTY_FIELDS.items():
        fields[name] = F.coalesce(blank_to_null(value[key]), F.lit(""))
    for name, key in INTEGER_FIELDS.items():
        fields[name] = to_bigint(value[key])
    for name, key in NUMBER_FIELDS.items():
        fields[name] = to_double(value[key])
    for name, key in PARAM_FIELDS.items():
        fields[name] = P.param_value(F.col("params"), key)

    mapped = staged.select(
        *[
            fields.get(field.name, F.lit(None)).cast(field.dataType).alias(field.name)
            for field in LISTING_SCHEMA.fields
        ],
        *keep,
    )
    return mapped.select(doc_id(F.col("site_name"), F.col("parapi_unique_id")).alias("doc_id"), "*")


def doc_id(site: Column, unique_id: Column) -> Column:
    return F.concat(F.lit("["), site, F.lit("]"), unique_id.cast("string"))


def candidate_defaults(listings: DataFrame, now: Column | None = None) -> DataFrame:
    """Fill what a stored listing may lack before it can look for a predecessor."""
    now = F.localtimestamp() if now is None else now
    col = F.col
    initial = F.coalesce(col("initial_price"), col("latest_price"), F.lit(0.0))
    return listings.withColumns(
        {
            "original_id": F.coalesce(F.nullif(col("original_id"), F.lit("")), col("doc_id")),
            "url": F.coalesce(col("url"), F.lit("")),
            "site_name": F.coalesce(col("site_name"), F.lit("unknown")),
            "seller_type": F.coalesce(col("seller_type"), F.lit("unknown")),
            "name": F.coalesce(col("name"), F.lit("")),
            "brand": F.coalesce(col("brand"), F.lit("")),
            "model": F.coalesce(col("model"), F.lit("")),
            "last_checked": F.coalesce(col("last_checked"), now),
            "parsed_at": F.coalesce(col("parsed_at"), now),
            "offer_start": F.coalesce(col("offer_start"), col("offer_end"), col("last_checked"), now),
            "initial_price": initial,
            "latest_price": F.coalesce(col("latest_price"), initial),
            "is_new": F.coalesce(col("is_new"), F.lit(False)),
        }
    )


def listing_summary(listings: DataFrame) -> DataFrame:
    return listings.select(F.col("doc_id").alias("id"), *SUMMARY_FIELDS)


def short_view(listings: DataFrame) -> DataFrame:
    return listings.select("doc_id", *[F.col(name).alias(alias) for name, alias in SHORT_FIELDS.items()])


# Scheme, host and optional port, path, query and fragment of an accepted image URL.
URL_PATTERN = r"^https?://[^\s/?#:@\\]+(:[0-9]{1,5})?([/?#]\S*)?$"
URL_LENGTH = 2083


def _kind(value: Column) -> Column:
    """The type of a variant value in small letters, without its inner types; null for a missing value."""
    return F.lower(F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0))


def _not_text(name: Column, value: Column, whole_numbers: Column | None = None) -> Column:
    """Why a value cannot fill a text column; null when it is a text, null or missing (or a whole number, where these are fine)."""
    schema = F.schema_of_variant(value)
    fine = schema.isin("STRING", "VOID")
    if whole_numbers is not None:
        fine = fine | (whole_numbers & (schema == "BIGINT"))
    return F.when(~fine, F.concat(name, F.lit(" must be text, not "), _kind(value)))


def invalid_reasons(payload: Column) -> Column:
    """Why a payload cannot become a listing, all reasons in order; empty when it can.

    Every value that a text column is read from must be a text: plain fields, the last value of each named
    parameter, and the type of each history item. The listing's own id may be a whole number.
    """
    keys = (*TEXT_FIELDS.values(), *TEXT_OR_EMPTY_FIELDS.values())
    plain = F.transform(
        F.array(*[F.struct(F.lit(key).alias("key"), F.try_variant_get(payload, f"$.{key}", "variant").alias("value")) for key in keys]),
        lambda field: _not_text(field["key"], field["value"], field["key"] == F.lit("id")),
    )
    params = F.filter(
        F.transform(
            F.try_variant_get(payload, "$.params", "array<variant>"),
            lambda item: F.struct(
                F.lower(blank_to_null(P.text(item, "name"))).alias("name"), F.try_variant_get(item, "$.value", "variant").alias("value")
            ),
        ),
        lambda item: item["name"].isin(list(PARAM_FIELDS.values())),
    )

    def last_of_each(items: Column) -> Column:
        last = F.filter(items, lambda item, place: ~F.exists(F.slice(items, place + 2, F.size(items)), lambda other: other["name"] == item["name"]))
        return F.transform(last, lambda item: _not_text(F.concat(F.lit("params: "), item["name"]), item["value"]))

    named = F.get(F.transform(F.array(params), last_of_each), F.lit(0))  # bound by a lambda, so that the parameters are read once
    history = F.transform(
        F.filter(F.try_variant_get(payload, "$.advert_info", "array<variant>"), lambda item: to_double(P.text(item, "price")).isNotNull()),
        lambda item: _not_text(F.lit("advert_info: type"), F.try_variant_get(item, "$.type", "variant")),
    )
    images = F.transform(P.image_list(payload), lambda u: F.when(~u.rlike(URL_PATTERN) | (F.length(u) > F.lit(URL_LENGTH)), F.lit("invalid image url")))
    none = F.array().cast("array<string>")
    found = F.array_distinct(F.array_compact(F.concat(plain, F.coalesce(named, none), F.coalesce(history, none), F.coalesce(images, none))))
    return F.when(payload.isNull() | ~P.is_object(payload), F.array(F.lit("payload is not an object"))).otherwise(found)


def with_reasons(raw: DataFrame) -> DataFrame:
    """``raw`` with its ``invalid_reasons``.

    They are exploded, not projected: a filter on them is not pushed below the step that made them, where
    it would be computed again, and by the few tasks that a scan of a small file has.
    """
    return raw.select("*", F.explode(F.transform(F.array("payload"), invalid_reasons)).alias("invalid_reasons"))


def split_invalid(raw: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with all their reasons). ``strict`` fails the job instead."""
    marked = with_reasons(raw)
    sound = F.size("invalid_reasons") == 0
    if strict:
        fail = F.raise_error(F.array_join("invalid_reasons", "; ")).cast("array<string>")
        marked = marked.withColumn("invalid_reasons", F.when(sound, F.col("invalid_reasons")).otherwise(fail))
    return marked.where(sound).drop("invalid_reasons"), marked.where(~sound)
