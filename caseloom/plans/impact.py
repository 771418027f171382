"""Weekly sales questions: orders summed by week, region, platform, segment and customer type."""

from __future__ import annotations

from ..operators import impact as op
from .sqlviews import with_views

# A Monday; its week is the first one after the change.
BASE = "1998-06-15"
BASE_WEEK = 24
MONTH = ["calendar_year", "month_number"]


def compare_sql(weeks: int, by: str = "") -> str:
    return f"""
        SELECT {by} CAST(b AS DOUBLE) AS sales_before, CAST(a AS DOUBLE) AS sales_after, CAST(a - b AS DOUBLE) AS change,
          round(100.0 * CAST(a - b AS DOUBLE) / nullif(CAST(b AS DOUBLE), 0), 2) AS percent_change"""


def window_sql(weeks: int) -> str:
    return f"""
          coalesce(sum(sales) FILTER (week_date < DATE '{BASE}'), 0) AS b, coalesce(sum(sales) FILTER (week_date >= DATE '{BASE}'), 0) AS a
          FROM weekly WHERE week_date >= DATE '{BASE}' - {7 * weeks} AND week_date < DATE '{BASE}' + {7 * weeks}"""


def years_sql(weeks: int) -> str:
    return with_views("weekly", f"""{compare_sql(weeks, "calendar_year,")} FROM (SELECT calendar_year,
          coalesce(sum(sales) FILTER (week_number < {BASE_WEEK}), 0) AS b, coalesce(sum(sales) FILTER (week_number >= {BASE_WEEK}), 0) AS a
          FROM weekly WHERE week_number >= {BASE_WEEK - weeks} AND week_number < {BASE_WEEK + weeks} GROUP BY 1)""")


def totals_sql(by: str) -> str:
    return with_views("weekly", f"""
        SELECT {by}, CAST(sum(transactions) AS BIGINT) AS transactions, CAST(sum(sales) AS DOUBLE) AS sales FROM weekly GROUP BY ALL""")


def share_sql(parent: str, child: str) -> str:
    return with_views("weekly", f"""
        SELECT {parent}, {child}, CAST(sum(sales) AS DOUBLE) AS sales,
          round(100.0 * CAST(sum(sales) AS DOUBLE) / CAST(sum(sum(sales)) OVER (PARTITION BY {parent}) AS DOUBLE), 2) AS share
        FROM weekly GROUP BY {parent}, {child}""")


def dimension_sql(weeks: int) -> str:
    parts = " UNION ALL ".join(f"""{compare_sql(weeks, f"'{d}' AS dimension, value,")} FROM (SELECT {d} AS value, {window_sql(weeks)} GROUP BY 1)"""
                               for d in op.DIMENSIONS)
    return with_views("weekly", parts)


QUERIES = {
    "clean_weekly": (lambda v: v.weekly, with_views("weekly", """
        SELECT week_date, week_number, month_number, calendar_year, region, platform, segment, age_band, demographic, customer_type,
          transactions, CAST(sales AS DOUBLE) AS sales, avg_transaction FROM weekly""")),
    "weekdays_used": (lambda v: op.weekdays_used(v.weekly), with_views("weekly", """
        SELECT dayname(week_date) AS weekday, count(*) AS records FROM weekly GROUP BY 1""")),
    "missing_weeks": (lambda v: op.missing_weeks(v.weekly), with_views("weekly", """
        SELECT y AS calendar_year, w AS week_number FROM (SELECT DISTINCT calendar_year AS y FROM weekly), range(1, 54) AS r(w)
        WHERE NOT EXISTS (SELECT 1 FROM weekly WHERE calendar_year = y AND week_number = w)""")),
    "yearly_totals": (lambda v: op.totals(v.weekly, ["calendar_year"]), totals_sql("calendar_year")),
    "monthly_totals": (lambda v: op.totals(v.weekly, [*MONTH, "region"]), totals_sql("calendar_year, month_number, region")),
    "platform_totals": (lambda v: op.totals(v.weekly, ["platform"]), totals_sql("platform")),
    "platform_share": (lambda v: op.share_of_parent(v.weekly, MONTH, ["platform"], "sales"), share_sql("calendar_year, month_number", "platform")),
    "demographic_share": (lambda v: op.share_of_parent(v.weekly, ["calendar_year"], ["demographic"], "sales"), share_sql("calendar_year", "demographic")),
    "top_contributors": (lambda v: op.top_contributors(v.weekly, ["age_band", "demographic"], "Retail"), with_views("weekly", """
        SELECT age_band, demographic, CAST(sum(sales) AS DOUBLE) AS sales,
          round(100.0 * CAST(sum(sales) AS DOUBLE) / CAST(sum(sum(sales)) OVER () AS DOUBLE), 2) AS share
        FROM weekly WHERE platform = 'Retail' GROUP BY 1, 2 ORDER BY 3 DESC LIMIT 1""")),
    "weighted_avg": (lambda v: op.weighted_average(v.weekly), with_views("weekly", """
        SELECT calendar_year, platform, round(CAST(sum(sales) AS DOUBLE) / CAST(sum(transactions) AS DOUBLE), 2) AS avg_transaction,
          round(CAST(sum(CAST(avg_transaction AS DECIMAL(18,2))) AS DOUBLE) / count(*), 2) AS mean_of_averages
        FROM weekly GROUP BY 1, 2""")),
    "before_after": (lambda v: op.before_after(v.weekly, BASE, 4), with_views("weekly", f"{compare_sql(4)} FROM (SELECT {window_sql(4)})")),
    "before_after_12": (lambda v: op.before_after(v.weekly, BASE, 12), with_views("weekly", f"{compare_sql(12)} FROM (SELECT {window_sql(12)})")),
    "before_after_years": (lambda v: op.before_after_years(v.weekly, BASE_WEEK, 4), years_sql(4)),
    "before_after_years_12": (lambda v: op.before_after_years(v.weekly, BASE_WEEK, 12), years_sql(12)),
    "impact_by_dimension": (lambda v: op.impact_by_dimension(v.weekly, BASE, 12), dimension_sql(12)),
}
