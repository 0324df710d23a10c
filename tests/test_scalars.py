from datetime import datetime

import pytest
from pyspark.sql import functions as F

from dimload import functions as scalars
from dimload.functions import (
    area_code,
    batch_number,
    blank_to_zero,
    constant,
    indicator,
    parse_compact,
    plus_days,
    text_to_long,
    text_to_timestamp,
    timestamp_literal,
    to_second,
    unknown_key,
    void_flag,
    zip4,
    zip5,
)


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first()["x"]


def text(value):
    return F.lit(value).cast("string")


@pytest.mark.parametrize(
    "value,five,rest",
    [("123456789", "12345", "6789"), ("12345-6789", "12345", "-6789"), ("123", "123", ""), (None, None, None)],
)
def test_zip(spark, value, five, rest):
    assert one(spark, zip5(text(value))) == five
    assert one(spark, zip4(text(value))) == rest


@pytest.mark.parametrize("value,expected", [("", 0), ("1", 1), (None, None)])
def test_blank_to_zero(spark, value, expected):
    assert one(spark, blank_to_zero(text(value))) == expected


def test_parse_compact_and_batch_number(spark):
    assert one(spark, parse_compact(text("20191105120203"))) == datetime(2019, 11, 5, 12, 2, 3)
    assert one(spark, parse_compact(text("bad"), strict=False)) is None
    assert one(spark, batch_number(timestamp_literal("2019-11-05 12:02:03.9"))) == 20191105120203
    assert one(spark, to_second(timestamp_literal("2019-11-05 12:02:03.9"))) == datetime(2019, 11, 5, 12, 2, 3)
    assert one(spark, batch_number(timestamp_literal(datetime(2019, 11, 5, 12, 2, 3, 900000)))) == 20191105120203


@pytest.mark.parametrize("bad", ["", "0x1A", "abc"])
def test_bad_number_fails_or_is_null(spark, bad):
    with pytest.raises(Exception, match="not a number"):
        one(spark, text_to_long(text(bad)))
    assert one(spark, text_to_long(text(bad), strict=False)) is None


@pytest.mark.parametrize(
    "value,expected", [("0x1A", 26), ("-0x1a", -26), ("12", 12), (" 12 ", 12), (None, None)]
)
def test_hex_text(spark, value, expected):
    assert one(spark, text_to_long(text(value), allow_hex=True)) == expected


@pytest.mark.parametrize("value,yes,no", [("Y", 1, 0), ("N", 0, 1), ("", 0, 0), (None, 0, 0)])
def test_indicator(spark, value, yes, no):
    assert one(spark, indicator(text(value))) == yes
    assert one(spark, indicator(text(value), true_value="N")) == no


def test_rest(spark):
    assert one(spark, area_code(text("7275551234"))) == 727
    assert one(spark, text_to_timestamp(text("2019-11-05 01:02:03"))) == datetime(2019, 11, 5, 1, 2, 3)
    assert one(spark, text_to_timestamp(text("x"), strict=False)) is None
    assert one(spark, plus_days(timestamp_literal("2019-02-28 10:00:00"))) == datetime(2019, 3, 1, 10)
    assert one(spark, unknown_key()) == 999999999999
    assert one(spark, constant(None, "int")) is None
    early, late = timestamp_literal("2019-01-01"), timestamp_literal("2019-01-02")
    assert one(spark, void_flag(late, early)) == 1
    assert one(spark, void_flag(early, late)) == 0
    assert one(spark, void_flag(early, early)) == 0
    assert one(spark, void_flag(early, F.lit(None).cast("timestamp"))) == 0


@pytest.mark.parametrize(
    "value", ["text_to_long", "text_to_timestamp", "parse_compact", "blank_to_zero", "area_code"]
)
def test_strict_without_ansi(spark, value):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="not a (number|timestamp): "):
            one(spark, getattr(scalars, value)(text("abcdef")))
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
