"""Weekly sales: totals, shares, missing weeks and before/after comparison around a date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import anchored_week, percent, rounded_ratio, weekday_name

DIMENSIONS = ("region", "platform", "age_band", "demographic", "customer_type")


def weekdays_used(weekly: DataFrame) -> DataFrame:
    """Weekday names of the week dates (SF14)."""
    return weekly.groupBy(weekday_name(F.col("week_date")).alias("weekday")).agg(F.count(F.lit(1)).alias("records"))


def missing_weeks(weekly: DataFrame, last_week: int = 53) -> DataFrame:
    """Week numbers without data per year (JN17)."""
    present = weekly.select("calendar_year", "week_number").distinct()
    weeks = F.explode(F.sequence(F.lit(1), F.lit(last_week))).alias("week_number")
    return present.select("calendar_year").distinct().select("calendar_year", weeks).join(
        present, ["calendar_year", "week_number"], "left_anti"
    )


def totals(weekly: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    """Transactions and sales by any columns (AG33)."""
    return weekly.groupBy(*by).agg(F.sum("transactions").alias("transactions"), F.sum("sales").alias("sales"))


def share_of_parent(df: DataFrame, parent: Sequence[str], child: Sequence[str], value: str, digits: int = 2) -> DataFrame:
    """Each child's total and its percentage of the parent's total (AG25).

    Parent totals are summed from the child totals and joined back, so a parent with many children is not windowed.
    An empty ``parent`` gives shares of the whole.
    """
    per_child = df.groupBy(*parent, *child).agg(F.sum(value).alias(value))
    if not parent:
        whole = per_child.agg(F.sum(value)).scalar()
        return per_child.withColumn("share", percent(F.col(value), whole, digits))
    per_parent = per_child.groupBy(*[F.col(p).alias(f"_p{i}") for i, p in enumerate(parent)]).agg(F.sum(value).alias("_total"))
    on = [F.col(p).eqNullSafe(F.col(f"_p{i}")) for i, p in enumerate(parent)]
    return per_child.join(per_parent, on).select(
        *parent, *child, value, percent(F.col(value), F.col("_total"), digits).alias("share")
    )


def top_contributors(weekly: DataFrame, by: Sequence[str], platform: str, n: int = 1) -> DataFrame:
    """Column values that contribute most to one platform's sales (LM1)."""
    shares = share_of_parent(weekly.filter(F.col("platform") == platform), [], by, "sales")
    return shares.orderBy(F.desc("sales"), *by).limit(n)


def weighted_average(weekly: DataFrame, by: Sequence[str] = ("calendar_year", "platform")) -> DataFrame:
    """Average transaction from the totals, next to the mean of the per-row averages it must not be confused with (AG32)."""
    return weekly.groupBy(*by).agg(
        rounded_ratio(F.sum("sales"), F.sum("transactions")).alias("avg_transaction"),
        rounded_ratio(F.sum("avg_transaction"), F.count("avg_transaction")).alias("mean_of_averages"),
    )


def _compared(before: Column, after: Column) -> list[Column]:
    change = after - before
    return [
        before.alias("sales_before"), after.alias("sales_after"), change.alias("change"),
        percent(change, before).alias("percent_change"),
    ]


def _in_window(week: Column, first: int, last: int) -> Column:
    return F.coalesce(F.sum(F.when(week.between(first, last), F.col("sales"))), F.lit(0))


def before_after(weekly: DataFrame, base: str, weeks: int) -> DataFrame:
    """Sales of the ``weeks`` weeks before and from the base week on (DO27).

    The dates are filtered by a plain range first, so a table that stores the date is read for those weeks only.
    """
    start = F.lit(base).cast("date")
    near = weekly.filter(
        (F.col("week_date") >= F.date_sub(start, 7 * weeks)) & (F.col("week_date") < F.date_add(start, 7 * weeks))
    )
    week = anchored_week(F.col("week_date"), start)
    sums = near.agg(_in_window(week, -weeks, -1).alias("b"), _in_window(week, 0, weeks - 1).alias("a"))
    return sums.select(*_compared(F.col("b"), F.col("a")))


def before_after_years(weekly: DataFrame, base_week: int, weeks: int) -> DataFrame:
    """The weeks before and after the same week number in every year of the data (DO27).

    Weeks are counted from the base week's first day (week 1 starts on 1 January), so a window may reach into the year before
    or after; it counts for the base week's year. Years that the data has no rows of get no window.
    """
    dated = weekly.select("sales", "week_date", F.year("week_date").alias("_y"))
    if not 0 < base_week - weeks <= base_week + weeks - 1 <= 52:
        # A row can lie in the window of its own year and in that of a neighbour.
        dated = dated.withColumn("_y", F.explode(F.array(F.col("_y") - 1, F.col("_y"), F.col("_y") + 1)))
    start = F.date_add(F.make_date("_y", F.lit(1), F.lit(1)), 7 * (base_week - 1))
    week = F.floor(F.datediff("week_date", start) / 7)
    near = dated.withColumn("_w", week).filter(F.col("_w").between(-weeks, weeks - 1))
    sums = near.groupBy(F.col("_y").alias("calendar_year")).agg(
        _in_window(F.col("_w"), -weeks, -1).alias("b"), _in_window(F.col("_w"), 0, weeks - 1).alias("a"),
    )
    sums = sums.join(weekly.select("calendar_year").distinct(), "calendar_year", "left_semi")
    return sums.select("calendar_year", *_compared(F.col("b"), F.col("a")))


def impact_by_dimension(weekly: DataFrame, base: str, weeks: int, dimensions: Sequence[str] = DIMENSIONS) -> DataFrame:
    """Before/after change for every value of every dimension in one pass over the data (AG27).

    The rows shrink to one per combination of dimension values before the grouping sets multiply them.
    """
    start = F.lit(base).cast("date")
    near = weekly.filter(
        (F.col("week_date") >= F.date_sub(start, 7 * weeks)) & (F.col("week_date") < F.date_add(start, 7 * weeks))
    )
    week = anchored_week(F.col("week_date"), start)
    combined = near.groupBy(*dimensions).agg(_in_window(week, -weeks, -1).alias("b"), _in_window(week, 0, weeks - 1).alias("a"))
    columns = [F.col(d) for d in dimensions]
    grouped = combined.groupingSets([[c] for c in columns], *columns).agg(
        F.sum("b").alias("b"), F.sum("a").alias("a"), *[F.grouping(d).alias(f"_g_{d}") for d in dimensions]
    )
    name, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for d in dimensions:
        name = F.when(F.col(f"_g_{d}") == 0, d).otherwise(name)
        value = F.when(F.col(f"_g_{d}") == 0, F.col(d)).otherwise(value)
    return grouped.select(name.alias("dimension"), value.alias("value"), *_compared(F.col("b"), F.col("a")))
