"""Calendar arithmetic whose rules differ from Spark's own date functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def minute_boundaries(start: Column, end: Column) -> Column:
    """Number of clock-minute boundaries between two timestamps (SF11).

    18:05:59 to 18:06:01 counts 1, although only two seconds passed.
    """
    days = F.datediff(end.cast("date"), start.cast("date"))
    return days * 1440 + (F.hour(end) * 60 + F.minute(end)) - (F.hour(start) * 60 + F.minute(start))


def sunday_week(d: Column) -> Column:
    """Week of the year where week 1 holds January 1 and weeks start on Sunday (SF13)."""
    lead_days = F.dayofweek(F.trunc(d, "YEAR")) - 1
    return (F.floor((F.dayofyear(d) - 1 + lead_days) / 7) + 1).cast("int")


def calendar_week(d: Column) -> Column:
    """Week of the year in blocks of seven days: January 1-7 is week 1, 8-14 is week 2 (CLN10)."""
    return (F.floor((F.dayofyear(d) - 1) / 7) + 1).cast("int")


def anchored_week(d: Column, start: Column) -> Column:
    """Weeks since ``start``: 0 for the first seven days, negative before it."""
    return F.floor(F.datediff(d, start) / 7).cast("int")


def month_of(d: Column) -> Column:
    """First day of the month of ``d`` (SF15)."""
    return F.trunc(d, "MM")


def weekday_name(d: Column) -> Column:
    """English weekday name (SF14)."""
    return F.date_format(d, "EEEE")
