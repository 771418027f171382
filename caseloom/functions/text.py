"""Text clean-up: missing-value words, unit suffixes, delimited lists, month strings."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def blank_to_null(c: Column, words: Sequence[str] = ("null",), keep_empty: bool = False) -> Column:
    """Words that stand for "missing", in any case, become NULL; so does empty text unless ``keep_empty`` (CLN2)."""
    gone = [w.lower() for w in words] + ([] if keep_empty else [""])
    return F.when(~F.lower(F.trim(c)).isin(gone), c)


def strip_units(c: Column, units: Sequence[str]) -> Column:
    """Drops one trailing unit word and the blanks around it (CLN3)."""
    longest_first = "|".join(re.escape(u) for u in sorted(units, key=len, reverse=True))
    # Names the column once: a filter on the result is pushed below it, and each mention would be computed again there.
    return F.trim(F.regexp_replace(c, rf"\s*(?:{longest_first})\s*$", ""))


def split_list(c: Column, sep: str = ",") -> Column:
    """A delimited list as an array of trimmed tokens; missing or empty text gives an empty array (CLN6, SF8)."""
    tokens = F.transform(F.split(c, re.escape(sep)), lambda x: F.trim(x))
    return F.coalesce(F.filter(tokens, lambda x: F.length(x) > 0), F.array().cast("array<string>"))


def trimmed_length(c: Column) -> Column:
    """Length without trailing blanks (SF5)."""
    return F.length(F.rtrim(c))


def has_text(c: Column) -> Column:
    """True when text is present after dropping trailing blanks; NULL for NULL, so a filter drops it (FLT9)."""
    return trimmed_length(c) > 0


def ci_equals(c: Column, value: str) -> Column:
    """Equality that ignores case (FLT11)."""
    return F.lower(c) == F.lit(value.lower())


def without_fraction(c: Column) -> Column:
    """Timestamp text up to the decimal point; text without a point is returned whole (CLN5, SF4)."""
    return F.substring_index(c, ".", 1)


def fraction_part(c: Column) -> Column:
    """Timestamp text after the decimal point, NULL without one (CLN5)."""
    return F.when(F.instr(c, ".") > 0, F.substring_index(c, ".", -1))


def month_start_from_text(c: Column) -> Column:
    """``MM-yyyy`` text to the first day of that month; text that is not a month gives NULL (CLN7)."""
    return F.try_to_date(F.concat(F.lit("01-"), c), "dd-MM-yyyy")
