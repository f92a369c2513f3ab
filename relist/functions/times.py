"""Naive-UTC time parsing and calendar expressions.

Everything stays TIMESTAMP_NTZ, so no result depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from relist.functions.text import strip

# Accepted spellings.
PAYLOAD_PATTERN = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}( [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2})?$"
CHECKED_PATTERN = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}$"
ISO_PATTERN = (
    r"^([0-9]{4}-[0-9]{2}-[0-9]{2})"
    r"([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?(Z|[+-][0-9]{2}(:?[0-9]{2})?)?)?$"
)
OFFSET_PATTERN = r":[0-9]{2}[0-9:.]*(Z|[+-][0-9]{2}:?(?:[0-9]{2})?)$"


def payload_datetime(value: Column) -> Column:
    """Date and time, or a bare date; any other spelling is null."""
    text = strip(value)
    return F.when(text.rlike(PAYLOAD_PATTERN), text.try_cast("timestamp_ntz"))


def checked_datetime(value: Column) -> Column:
    """Date and time only; any other spelling is null."""
    text = strip(value)
    return F.when(text.rlike(CHECKED_PATTERN), text.try_cast("timestamp_ntz"))


def iso_datetime(value: Column) -> Column:
    """ISO date or date-time; an offset is folded into naive UTC."""
    offset = F.regexp_extract(value, OFFSET_PATTERN, 1)
    digits = F.regexp_replace(offset, "[^0-9]", "")
    hours = F.substring(digits, 1, 2).try_cast("int")
    minutes = F.coalesce(F.substring(digits, 3, 2).try_cast("int"), F.lit(0))
    shift = F.make_dt_interval(F.lit(0), hours, minutes, F.lit(0).cast("decimal(18,6)"))
    local = F.left(value, F.length(value) - F.length(offset)).try_cast("timestamp_ntz")
    return F.when(
        value.rlike(ISO_PATTERN),
        F.when(F.length(digits) == 0, local)
        .when(offset.startswith("-"), local + shift)
        .otherwise(local - shift),
    )


def ingested_at(value: Column) -> Column:
    """Like :func:`iso_datetime` on stripped text."""
    return iso_datetime(strip(value))


def ingested_at_error(value: Column) -> Column:
    """Why a value is no ingestion time; null when it is one."""
    reason = F.concat(F.lit("Invalid ingested_at value: "), F.coalesce(value, F.lit("null")))
    return F.when(ingested_at(value).isNull(), reason)


def required_ingested_at(value: Column) -> Column:
    """The ingestion time; an unreadable value fails the job."""
    return F.coalesce(ingested_at(value), F.raise_error(ingested_at_error(value)).cast("timestamp_ntz"))


def month_start(value: Column) -> Column:
    return F.trunc(value.cast("date"), "MM").cast("timestamp_ntz")


def next_month_start(value: Column) -> Column:
    return F.add_months(F.trunc(value.cast("date"), "MM"), 1).cast("timestamp_ntz")


def micros_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end)


def epoch_micros(value: Column) -> Column:
    return micros_between(F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), value)


def epoch_day(value: Column) -> Column:
    return F.unix_date(value.cast("date"))


def plus_days(value: Column, days: int) -> Column:
    return value + F.make_dt_interval(F.lit(int(days)))
