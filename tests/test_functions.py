"""Column helpers: the rules that differ from Spark's defaults."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from caseloom import functions as fn

from .conftest import rows


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def date(text):
    return F.lit(text).cast("date")


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


def test_integer_average_truncates_toward_zero(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    assert df.agg(fn.int_avg(F.col("x")).alias("a")).first().a == 1
    assert df.agg(fn.int_avg(-F.col("x")).alias("a")).first().a == -1
    assert df.agg(fn.mean(F.col("x")).alias("a")).first().a == 1.5


@pytest.mark.parametrize("start,end,minutes", [
    ("2020-01-01 18:05:59", "2020-01-01 18:06:01", 1),
    ("2020-01-01 18:05:00", "2020-01-01 18:05:59", 0),
    ("2020-01-01 23:59:30", "2020-01-02 00:00:10", 1),
    ("2020-01-01 18:06:01", "2020-01-01 18:05:59", -1),
    ("2020-02-28 12:00:00", "2020-03-01 12:00:00", 2 * 1440),
])
def test_minute_boundaries(spark, start, end, minutes):
    assert one(spark, fn.minute_boundaries(ts(start), ts(end))) == minutes


@pytest.mark.parametrize("day,week", [
    ("2021-01-01", 1), ("2021-01-02", 1), ("2021-01-03", 2), ("2021-01-11", 3), ("2021-01-18", 4), ("2017-01-01", 1), ("2017-01-08", 2),
])
def test_sunday_week(spark, day, week):
    assert one(spark, fn.sunday_week(date(day))) == week


@pytest.mark.parametrize("day,week", [("2020-01-01", 1), ("2020-01-07", 1), ("2020-01-08", 2), ("2020-12-31", 53), ("2020-06-15", 24)])
def test_calendar_week(spark, day, week):
    assert one(spark, fn.calendar_week(date(day))) == week


def test_anchored_week_is_negative_before_the_start(spark):
    start = date("2021-01-01")
    assert [one(spark, fn.anchored_week(date(d), start)) for d in ("2021-01-01", "2021-01-07", "2021-01-08", "2020-12-31")] == [0, 0, 1, -1]


@pytest.mark.parametrize("text,kept", [("null", None), ("NULL", None), (" null ", None), ("", None), (None, None), ("x", "x")])
def test_blank_to_null(spark, text, kept):
    assert one(spark, fn.blank_to_null(F.lit(text).cast("string"))) == kept


def test_blank_to_null_can_keep_empty_text(spark):
    assert one(spark, fn.blank_to_null(F.lit(""), keep_empty=True)) == ""


@pytest.mark.parametrize("text,number", [("32 minutes", "32"), ("20 mins", "20"), ("15 minute", "15"), ("25mins", "25"), ("10minutes", "10"), ("40", "40")])
def test_strip_units(spark, text, number):
    assert one(spark, fn.strip_units(F.lit(text), ["mins", "minute", "minutes"])) == number


@pytest.mark.parametrize("text,tokens", [("1, 2,3", ["1", "2", "3"]), ("", []), (None, []), ("7", ["7"])])
def test_split_list(spark, text, tokens):
    assert one(spark, fn.split_list(F.lit(text).cast("string"))) == tokens


def test_text_tests(spark):
    assert one(spark, fn.trimmed_length(F.lit("ab  "))) == 2
    assert one(spark, fn.has_text(F.lit("  "))) is False
    assert one(spark, fn.has_text(F.lit(None).cast("string"))) is None
    assert one(spark, fn.ci_equals(F.lit("Add To Cart"), "add to cart")) is True


def test_fractions(spark):
    assert one(spark, fn.without_fraction(F.lit("2020-02-04 19:16:09.182546"))) == "2020-02-04 19:16:09"
    assert one(spark, fn.fraction_part(F.lit("2020-02-04 19:16:09.182546"))) == "182546"
    assert one(spark, fn.without_fraction(F.lit("2020-02-04 19:16:09"))) == "2020-02-04 19:16:09"
    assert one(spark, fn.fraction_part(F.lit("2020-02-04 19:16:09"))) is None


def test_month_start_from_text(spark):
    assert one(spark, fn.month_start_from_text(F.lit("07-2018"))) == dt.date(2018, 7, 1)
    assert one(spark, fn.month_start_from_text(F.lit("NULL"))) is None
    assert one(spark, fn.month_of(date("2020-02-29"))) == dt.date(2020, 2, 1)
    assert one(spark, fn.weekday_name(date("2020-06-15"))) == "Monday"


def test_ratios(spark):
    assert one(spark, fn.percent(F.lit(1), F.lit(8))) == 12.5
    assert one(spark, fn.percent(F.lit(1), F.lit(800))) == 0.13
    assert one(spark, fn.percent(F.lit(-1), F.lit(800))) == -0.13
    assert one(spark, fn.percent(F.lit(1), F.lit(0))) is None
    assert one(spark, fn.safe_ratio(F.lit(1), F.lit(0))) is None
    # 891949.59 / 6 is 148658.265 exactly; a double quotient lies below it.
    assert one(spark, fn.rounded_ratio(F.lit(Decimal("891949.59")), F.lit(6))) == Decimal("148658.27")
    assert one(spark, fn.money_text(F.lit(138))) == "$138"
    assert one(spark, fn.money_text(F.lit(None).cast("int"))) == "$"


def test_nulls_sort_first(spark):
    df = spark.createDataFrame([(2,), (None,), (1,)], "x int")
    assert [r.x for r in df.orderBy("x").collect()] == [None, 1, 2]
    assert rows(df.filter("x != 1")) == [(2,)]
