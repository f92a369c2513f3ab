"""Text and scalar coercions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as surrounding whitespace.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Spellings of the two boolean states.
TRUE_WORDS = ("1", "true", "yes")
FALSE_WORDS = ("0", "false", "no")

# Accepted number spellings (digit groups may be joined by one underscore).
NUMBER_PATTERN = r"^[+-]?([0-9](_?[0-9])*\.?([0-9](_?[0-9])*)?|\.[0-9](_?[0-9])*)([eE][+-]?[0-9](_?[0-9])*)?$"
NAN_PATTERN = r"(?i)^[+-]?nan$"
INFINITY_PATTERN = r"(?i)^[+-]?inf(inity)?$"


def strip(value: Column) -> Column:
    return F.btrim(value, F.lit(WHITESPACE))


def blank_to_null(value: Column) -> Column:
    return F.nullif(strip(value), F.lit(""))


def to_double(value: Column) -> Column:
    text = strip(value)
    return (
        F.when(text.rlike(NUMBER_PATTERN), F.replace(text, F.lit("_"), F.lit("")).try_cast("double"))
        .when(text.rlike(NAN_PATTERN), F.lit(float("nan")))
        .when(text.rlike(INFINITY_PATTERN), F.when(text.startswith("-"), float("-inf")).otherwise(float("inf")))
    )


def to_bigint(value: Column) -> Column:
    """Integer part of the number; NaN, infinities and out-of-range values become null."""
    return to_double(value).try_cast("bigint")


def to_bool(value: Column) -> Column:
    word = F.lower(strip(value))
    return F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(word.isin(*FALSE_WORDS), F.lit(False))


def image_url(value: Column) -> Column:
    url = strip(value)
    return F.when(url.startswith("//"), F.concat(F.lit("https:"), url)).when(
        url.startswith("http://") | url.startswith("https://"), url
    )
