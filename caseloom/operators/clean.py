"""Cleaning: every function returns a new DataFrame, the input is never changed in place."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import (
    blank_to_null,
    calendar_week,
    fraction_part,
    month_start_from_text,
    rounded_ratio,
    strip_units,
    without_fraction,
)

# The unit words and missing-value words of the delivery tables, the segment code table of weekly sales.
DISTANCE_UNITS = ("km",)
DURATION_UNITS = ("minutes", "mins", "minute")
AGE_BANDS = {"1": "Young Adults", "2": "Middle Aged", "3": "Retirees", "4": "Retirees"}
DEMOGRAPHICS = {"C": "Couples", "F": "Families"}
UNKNOWN = "unknown"


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """One copy of each row that is equal in all columns (CLN1). Equal rows can be real quantities: use it knowingly."""
    return df.dropDuplicates()


def sentinels_to_null(df: DataFrame, columns: Sequence[str], words: Sequence[str] = ("null",),
                      keep_empty: bool = True) -> DataFrame:
    """Text such as ``null`` becomes NULL in the given columns (CLN2)."""
    return df.withColumns({c: blank_to_null(F.col(c), words, keep_empty) for c in columns})


def retype(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Casts columns; a value that does not fit becomes NULL (CLN4). ``reject_counts`` tells how many did not."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def reject_counts(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Per column, how many present values ``retype`` would turn into NULL."""
    return df.agg(*[(F.count(c) - F.count(F.col(c).try_cast(t))).alias(c) for c, t in types.items()])


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their row counts; empty when ``keys`` is the grain of the table (JN15)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def clean_orders(orders: DataFrame) -> DataFrame:
    """Item orders with the word ``null`` removed from both topping lists (CLN2)."""
    return sentinels_to_null(orders, ["exclusions", "extras"])


def clean_runs(runs: DataFrame) -> DataFrame:
    """Delivery runs with units stripped and typed time, distance and duration (CLN2-CLN4)."""
    no_units = runs.withColumns({
        "distance": strip_units(F.col("distance"), DISTANCE_UNITS),
        "duration": strip_units(F.col("duration"), DURATION_UNITS),
    })
    missing = sentinels_to_null(no_units, ["pickup_time", "distance", "duration", "cancellation"], keep_empty=False)
    return retype(missing, {"pickup_time": "timestamp_ntz", "distance": "decimal(5,1)", "duration": "int"})


def clean_metrics(metrics: DataFrame) -> DataFrame:
    """Monthly metrics with typed ids and a month-start date (CLN2, CLN4, CLN7)."""
    no_words = sentinels_to_null(metrics, ["_month", "_year", "month_year", "interest_id"], keep_empty=False)
    typed = retype(no_words, {"_month": "int", "_year": "int", "interest_id": "bigint"})
    return typed.withColumn("month_year", month_start_from_text(F.col("month_year")))


def split_fraction(df: DataFrame, column: str) -> DataFrame:
    """Splits timestamp text at the decimal point and adds the whole-second timestamp (CLN5, SF3-SF6)."""
    return df.withColumns({
        "datetime_without_fraction": without_fraction(F.col(column)),
        "fraction": fraction_part(F.col(column)),
    }).withColumn("event_second", F.col("datetime_without_fraction").try_cast("timestamp_ntz"))


def clean_weekly(weekly: DataFrame, date_format: str = "d/M/yy") -> DataFrame:
    """Weekly sales with calendar columns, age band, demographic and the average transaction (CLN8-CLN11)."""
    segment = blank_to_null(F.col("segment"))
    digit, letter = F.regexp_extract(segment, r"(\d)", 1), F.substring(segment, 1, 1)
    band, group = F.lit(UNKNOWN), F.lit(UNKNOWN)
    for code, label in AGE_BANDS.items():
        band = F.when(digit == code, label).otherwise(band)
    for code, label in DEMOGRAPHICS.items():
        group = F.when(letter == code, label).otherwise(group)
    dated = weekly.withColumn("week_date", F.try_to_date("week_date", date_format))
    return dated.select(
        "week_date",
        calendar_week(F.col("week_date")).alias("week_number"),
        F.month("week_date").alias("month_number"),
        F.year("week_date").alias("calendar_year"),
        "region",
        "platform",
        F.coalesce(segment, F.lit(UNKNOWN)).alias("segment"),
        band.alias("age_band"),
        group.alias("demographic"),
        "customer_type",
        "transactions",
        "sales",
        rounded_ratio(F.col("sales"), F.col("transactions")).alias("avg_transaction"),
    )
