import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from feedloom import functions as fn

D = dt.date


def value(spark, text, expression):
    return spark.createDataFrame([(text,)], "x string").select(expression(F.col("x"))).first()[0]


@pytest.mark.parametrize("text, day", [
    ("20260228", D(2026, 2, 28)), ("20260230", None), ("00000000", None), ("", None), ("2026-02-28", None),
    ("00000101", None), ("20260228\n", None), (None, None), ("20240229", D(2024, 2, 29)), ("20250229", None),
])
def test_compact_dates(spark, text, day):
    assert value(spark, text, fn.date_compact) == day


@pytest.mark.parametrize("text, day", [
    ("20260101.0", D(2026, 1, 1)), ("20260101", D(2026, 1, 1)), (".0", None), ("20260199.0", None),
])
def test_float_tails(spark, text, day):
    assert value(spark, text, lambda c: fn.date_compact(fn.drop_float_tail(c))) == day


@pytest.mark.parametrize("text", ["2026-07-04", "20260704", "7/4/2026", "07/04/2026", "7-4-2026", "07-4-2026"])
def test_four_formats(spark, text):
    assert value(spark, text, fn.date_any) == D(2026, 7, 4)


@pytest.mark.parametrize("text", ["13/4/2026", "2/29/2026", "2026-02-30", "0000-01-01", "7/4/26", "2026-7-4", "7/4-2026"])
def test_four_formats_reject(spark, text):
    assert value(spark, text, fn.date_any) is None


def test_strict_slash(spark):
    assert value(spark, "07/04/2026", fn.date_slash) == D(2026, 7, 4)
    assert value(spark, "7/4/2026", fn.date_slash) is None


@pytest.mark.parametrize("text, minus_only, signed", [
    ("123.45", "123.45", "123.45"), ("-1", "-1", "-1"), ("+1", None, "1"), ("1,000", None, None),
    (".5", None, None), ("1.", None, None), ("1e5", None, None), ("9" * 30, None, None),
])
def test_numbers(spark, text, minus_only, signed):
    as_decimal = lambda t: None if t is None else Decimal(t)
    assert value(spark, text, fn.safe_number) == as_decimal(minus_only)
    assert value(spark, text, lambda c: fn.safe_number(c, plus_allowed=True)) == as_decimal(signed)


def test_integers(spark):
    assert value(spark, "99999", fn.safe_smallint) is None
    assert value(spark, "99999", fn.safe_int) == 99999
    assert value(spark, "-4", fn.safe_int) is None


def test_blanks(spark):
    assert value(spark, "   ", fn.blank_to_null) is None
    assert value(spark, "   ", fn.empty_to_null) == "   "
    assert value(spark, "\t", fn.blank_to_null) == "\t"


@pytest.mark.parametrize("number, text, expected", [
    ("1234", None, "01234"), ("1234", "", "01234"), ("1", "1234", "1234"), ("1", "12345-6789", "12345-6789"),
    ("123456", None, "12345"), (None, None, None),
])
def test_zip(spark, number, text, expected):
    df = spark.createDataFrame([(number, text)], "a string, b string")
    assert df.select(fn.zip_code("a", "b")).first()[0] == expected


def test_upline_parts(spark):
    assert value(spark, "Jane Doe - 12345", fn.trailing_code) == "12345"
    assert value(spark, "Jane Doe - 12345", fn.name_without_code) == "Jane Doe"
    assert value(spark, "- 12345", fn.name_without_code) is None
    assert value(spark, "Jane Doe", fn.trailing_code) is None


def test_load_id_day(spark):
    assert value(spark, "1783955745.5023258", fn.epoch_date) == D(2026, 7, 13)
    assert value(spark, "manual", fn.epoch_date) is None


def test_hash_tells_null_from_blank(spark):
    df = spark.createDataFrame([(None,), ("",), ("",)], "x string")
    hashes = [r[0] for r in df.select(fn.content_hash(["x"])).collect()]
    assert hashes[1] == hashes[2] != hashes[0]


def test_utc_day_in_any_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        day = spark.sql("SELECT timestamp_seconds(1783990000) AS t").select(fn.utc_date(F.col("t"))).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert day == dt.datetime.fromtimestamp(1783990000, dt.timezone.utc).date()
