"""Averages, ratios and money formatting with the integer and rounding rules the questions rely on."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def int_avg(x: Column) -> Column:
    """Average of integers that truncates toward zero (AG4)."""
    return F.call_function("div", F.sum(x), F.count(x))


def mean(x: Column) -> Column:
    """Exact average as a double: the sum stays decimal or integer, so row order cannot change it (AG5)."""
    return F.sum(x).cast("double") / F.count(x)


def safe_ratio(a: Column, b: Column) -> Column:
    """``a / b`` as a double, NULL when ``b`` is zero."""
    return a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))


def rounded_ratio(a: Column, b: Column, digits: int = 2) -> Column:
    """``a / b`` for money: divided in decimals and rounded half away from zero, NULL when ``b`` is zero (CLN11)."""
    exact = a.cast("decimal(28,6)") / F.nullif(b.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return F.round(exact, digits).cast(f"decimal(28,{digits})")


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``100 * part / whole`` rounded half away from zero, NULL when ``whole`` is zero (AG13)."""
    return F.round(F.lit(100.0) * part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)), digits)


def money_text(x: Column, sign: str = "$") -> Column:
    """``$`` followed by the amount; a NULL amount gives the bare sign, as concatenation that skips NULL does (AG21)."""
    return F.concat(F.lit(sign), F.coalesce(x.cast("string"), F.lit("")))
