from __future__ import annotations

import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from relist.functions import payload as P
from relist.functions import text as T
from relist.functions import times as D


def apply(spark, expression, values):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [row["out"] for row in frame.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()]


def python_float(value):
    if value is None or not value.strip():
        return None
    try:
        return float(value.strip())
    except ValueError:
        return None


NUMBERS = ["1", " 1.5\t", "-.5", "5.", "1e3", "1_000", "1__0", "_1", "1.5d", "0x1p3", "", "  ", None, "nan", "-inf", "Infinity", "abc", "1,5", "+7", " 8 ", "."]


def test_numbers_follow_python(spark):
    expected = [python_float(v) for v in NUMBERS]
    got = apply(spark, T.to_double, NUMBERS)
    for value, want, have in zip(NUMBERS, expected, got, strict=True):
        assert (want is None) == (have is None), value
        if want is not None:
            assert want == have or (math.isnan(want) and math.isnan(have)), value


def test_integers_truncate_and_drop_what_has_no_integer(spark):
    values = ["1.9", "-1.9", "1e3", "nan", "inf", "1e30", "x", None]
    assert apply(spark, T.to_bigint, values) == [1, -1, 1000, None, None, None, None, None]


def test_blank_and_bool(spark):
    values = ["　  \x1f", " a b ", " x", "", None]
    assert apply(spark, T.blank_to_null, values) == [None, "a b", "x", None, None]
    words = ["1", "TRUE", " yes ", "0", "False", "NO", "2", "", None]
    assert apply(spark, T.to_bool, words) == [True, True, True, False, False, False, None, None, None]


def test_payload_times(spark):
    values = ["2026-1-2 3:4:5", "2026-01-02", "2026-13-01", "2026-01-02 03:04:05.5", "2026-01-02T03:04:05", " 2026-01-02 ", "2026", None]
    first, day = datetime(2026, 1, 2, 3, 4, 5), datetime(2026, 1, 2)
    assert apply(spark, D.payload_datetime, values) == [first, day, None, None, None, day, None, None]
    assert apply(spark, D.checked_datetime, values) == [first, None, None, None, None, None, None, None]


def test_iso_times_fold_offsets(spark):
    values = ["2026-01-02T03:04:05Z", "2026-01-02 03:04:05.25+03:30", "2026-01-02T03:04-0100", "2026-01-02", "20260102", "2026-1-2", None]
    assert apply(spark, D.iso_datetime, values) == [
        datetime(2026, 1, 2, 3, 4, 5),
        datetime(2026, 1, 1, 23, 34, 5, 250000),
        datetime(2026, 1, 2, 4, 4),
        datetime(2026, 1, 2),
        None,
        None,
        None,
    ]


def test_times_ignore_the_session_zone(spark):
    # 02:30 on that day does not exist in New York
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        want = [datetime(2026, 3, 8, 2, 30)]
        assert apply(spark, D.payload_datetime, ["2026-03-08 02:30:00"]) == want
        assert apply(spark, D.iso_datetime, ["2026-03-08T02:30:00Z"]) == want
        assert apply(spark, D.iso_datetime, ["2026-03-07T21:30:00-05:00"]) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_unreadable_ingestion_time_fails(spark):
    assert apply(spark, D.required_ingested_at, [" 2026-01-02T00:00:00Z "]) == [datetime(2026, 1, 2)]
    with pytest.raises(Exception, match="Invalid ingested_at"):
        apply(spark, D.required_ingested_at, ["soon"])


def test_month_bounds(spark):
    frame = spark.createDataFrame([(datetime(2025, 12, 31, 23),)], "t timestamp_ntz")
    row = frame.select(D.month_start(F.col("t")).alias("a"), D.next_month_start(F.col("t")).alias("b")).first()
    assert (row["a"], row["b"]) == (datetime(2025, 12, 1), datetime(2026, 1, 1))


@pytest.mark.parametrize(
    ("source", "site_id", "site"),
    [("Avito", "4", "avito"), ("auto.drom", None, "drom"), ("auto_ru", None, "auto"), ("other", "2", "avito"), ("Other ", "9", "other"), (" ", None, "unknown")],
)
def test_site_name(spark, source, site_id, site):
    frame = spark.createDataFrame([(source, site_id)], "source string, site_id string")
    assert frame.select(P.site_name(F.col("source"), F.col("site_id"))).first()[0] == site
