"""Column contracts of the tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Listing field names and types of the stored table.
LISTING_SCHEMA = T.StructType(
    [
        T.StructField("original_id", T.StringType()),
        T.StructField("parapi_unique_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("site_name", T.StringType()),
        T.StructField("seller_type", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("parapi_user_ident", T.StringType()),
        T.StructField("last_checked", T.TimestampNTZType()),
        T.StructField("parsed_at", T.TimestampNTZType()),
        T.StructField("offer_start", T.TimestampNTZType()),
        T.StructField(
            "trans_history",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("datetime", T.TimestampNTZType()),
                        T.StructField("price", T.DoubleType()),
                        T.StructField("views", T.LongType()),
                        T.StructField("event_type", T.StringType()),
                    ]
                )
            ),
        ),
        T.StructField("initial_price", T.DoubleType()),
        T.StructField("latest_price", T.DoubleType()),
        T.StructField("is_new", T.BooleanType()),
        T.StructField("brand", T.StringType()),
        T.StructField("parapi_brand_id", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("parapi_model_id", T.StringType()),
        T.StructField("generation", T.StringType()),
        T.StructField("parapi_generation_id", T.StringType()),
        T.StructField("modification", T.StringType()),
        T.StructField("parapi_modification_id", T.LongType()),
        T.StructField("complectation", T.StringType()),
        T.StructField("parapi_complectation_id", T.StringType()),
        T.StructField("build_year", T.LongType()),
        T.StructField("vin", T.StringType()),
        T.StructField("engine_power", T.DoubleType()),
        T.StructField("engine_volume_liters", T.DoubleType()),
        T.StructField("fuel", T.StringType()),
        T.StructField("gear_type", T.StringType()),
        T.StructField("gear_box", T.StringType()),
        T.StructField("steering_position", T.StringType()),
        T.StructField("body_type", T.StringType()),
        T.StructField("body_color", T.StringType()),
        T.StructField("doors_num", T.StringType()),
        T.StructField("count_owner", T.LongType()),
        T.StructField("condition", T.StringType()),
        T.StructField("mileage", T.LongType()),
        T.StructField("mileage_units", T.StringType()),
        T.StructField("views_total", T.LongType()),
        T.StructField("phone", T.StringType()),
        T.StructField("phone_protection", T.BooleanType()),
        T.StructField("place", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField(
            "location",
            T.StructType([T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())]),
        ),
        T.StructField("predecessor_id", T.StringType()),
        T.StructField("successor_id", T.StringType()),
        T.StructField("offer_end", T.TimestampNTZType()),
        T.StructField("images", T.ArrayType(T.StringType())),
    ]
)

LINK_COLUMNS = ("predecessor_id", "successor_id")

#: A listing as the append log holds it: with its key and the time of its write, its links in a table of their own.
STORED_LISTING = T.StructType(
    [
        T.StructField("doc_id", T.StringType()),
        *(f for f in LISTING_SCHEMA.fields if f.name not in LINK_COLUMNS),
        T.StructField("updated_at", T.TimestampNTZType()),
    ]
)

CURSOR_SCHEMA = T.StructType(
    [T.StructField("site", T.StringType()), T.StructField("ts", T.TimestampNTZType())]
)

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("from_ingested_at", T.TimestampNTZType()),
        T.StructField("to_ingested_at", T.TimestampNTZType()),
        T.StructField("archived_at", T.TimestampNTZType()),
        T.StructField("s3_path", T.StringType()),
        T.StructField("documents_count", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("seq", T.IntegerType()),
    ]
)

RAW_SCHEMA = T.StructType(
    [
        T.StructField("raw_id", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("ingested_at", T.TimestampNTZType()),
        T.StructField("request_params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("payload", T.StringType()),
        T.StructField("position", T.IntegerType()),
    ]
)

#: What a micro-batch did for a site: pages and ads it brought, faults among them, and the cursor before and after.
SITE_RUN_SCHEMA = T.StructType(
    [
        T.StructField("site", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("pages", T.LongType()),
        T.StructField("ads", T.LongType()),
        T.StructField("faults", T.LongType()),
        T.StructField("error", T.StringType()),
        T.StructField("max_checked", T.TimestampNTZType()),
        T.StructField("cursor_before", T.TimestampNTZType()),
        T.StructField("cursor_after", T.TimestampNTZType()),
    ]
)

PAGE_SCHEMA = T.StructType(
    [
        T.StructField("site", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("file", T.StringType()),
        T.StructField("file_time", T.TimestampType()),
        T.StructField("page_id", T.StringType()),
    ]
)

FAULT_SCHEMA = T.StructType(
    [
        T.StructField("site", T.StringType()),
        T.StructField("file", T.StringType()),
        T.StructField("page_id", T.StringType()),
        T.StructField("position", T.IntegerType()),
        T.StructField("reason", T.StringType()),
        T.StructField("content", T.StringType()),
    ]
)
