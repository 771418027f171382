"""Monthly metric questions: orders as metrics of customers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import tenure as op
from ..sources.views import Views
from .sqlviews import with_views

MIN_MONTHS = 8


def kept(v: Views):
    return op.without_short_lived(v.metrics, MIN_MONTHS)


def joined_interest(v: Views):
    """All metric columns with the registry's columns but its id (JN1)."""
    return v.metrics.join(v.registry, F.col("interest_id") == F.col("id")).drop("id", "_month", "_year")


def yearly(v: Views):
    return v.metrics.withColumn("year", F.year("month_year"))


KEPT = f"kept AS (SELECT * FROM metrics WHERE interest_id IN (SELECT interest_id FROM tenure WHERE total_periods >= {MIN_MONTHS}))"

QUERIES = {
    "count_with_total": (lambda v: op.counts_with_total(v.metrics), with_views("metrics", """
        SELECT month_year, count(*) AS records, CAST(sum(count(*)) OVER () AS BIGINT) AS total_records
        FROM metrics GROUP BY 1 ORDER BY 1 NULLS FIRST""")),
    "key_audit": (lambda v: op.key_audit(v.t.events, "user_id", v.registry, "id"), with_views("registry", """
        SELECT (SELECT count(DISTINCT user_id) FROM events) AS left_keys, (SELECT count(DISTINCT id) FROM registry) AS right_keys,
          (SELECT count(DISTINCT user_id) FROM events WHERE user_id NOT IN (SELECT id FROM registry)) AS left_only_keys,
          (SELECT count(*) FROM registry WHERE id NOT IN (SELECT user_id FROM events)) AS right_only_keys,
          (SELECT count(*) FROM events WHERE user_id NOT IN (SELECT id FROM registry)) AS left_only_rows,
          (SELECT count(*) FROM registry WHERE id NOT IN (SELECT user_id FROM events)) AS right_only_rows""")),
    "registry_ids": (lambda v: v.registry.agg(F.count("id").alias("total_ids")), with_views("registry", """
        SELECT count(id) AS total_ids FROM registry""")),
    "joined_interest": (joined_interest, with_views("metrics registry", """
        SELECT month_year, interest_id, CAST(composition AS DOUBLE) AS composition, ranking, percentile_ranking, created_at
        FROM metrics JOIN registry ON id = interest_id""")),
    "before_created": (lambda v: op.before_created(v.metrics, v.registry), with_views("metrics registry", """
        SELECT count(*) FILTER (month_year < CAST(created_at AS DATE)) AS before_date,
          count(*) FILTER (month_year < date_trunc('month', created_at)) AS before_month
        FROM metrics JOIN registry ON id = interest_id""")),
    "present_all_periods": (lambda v: op.present_in_all(yearly(v), "year"), with_views("metrics", """
        SELECT interest_id, count(DISTINCT year(month_year)) AS total_periods FROM metrics WHERE interest_id IS NOT NULL GROUP BY 1
        HAVING count(DISTINCT year(month_year)) = (SELECT count(DISTINCT year(month_year)) FROM metrics)""")),
    "tenure_cumulative": (lambda v: op.tenure_cumulative(v.metrics), with_views("tenure", """
        SELECT total_periods, count(*) AS interests,
          round(100.0 * sum(count(*)) OVER (ORDER BY total_periods DESC) / sum(count(*)) OVER (), 2) AS cumulative_percent
        FROM tenure GROUP BY 1""")),
    "removed_points": (lambda v: op.removed_points(v.metrics, MIN_MONTHS), with_views("tenure", f"""
        SELECT count(*) AS records, count(DISTINCT interest_id) AS interests FROM metrics
        WHERE interest_id IN (SELECT interest_id FROM tenure WHERE total_periods < {MIN_MONTHS})""")),
    "cohort_tenure_filter": (lambda v: op.interests_per_month(kept(v)), with_views("tenure", f"""
        , {KEPT} SELECT month_year, count(DISTINCT interest_id) AS interests FROM kept WHERE month_year IS NOT NULL GROUP BY 1""")),
    "top_bottom_by_max": (lambda v: op.top_and_bottom(kept(v)), with_views("tenure", f"""
        , {KEPT}, best AS (SELECT interest_id, max(composition) AS max_value FROM kept GROUP BY 1),
        ranked AS (SELECT *, dense_rank() OVER (ORDER BY max_value DESC) AS top, dense_rank() OVER (ORDER BY max_value) AS bottom FROM best),
        ends AS (SELECT 'top' AS side, interest_id, max_value, top AS rnk FROM ranked WHERE top <= 10
          UNION ALL SELECT 'bottom', interest_id, max_value, bottom FROM ranked WHERE bottom <= 10)
        SELECT side, interest_id, (SELECT max(month_year) FROM kept k WHERE k.interest_id = e.interest_id AND composition = max_value) AS month_year,
          CAST(max_value AS DOUBLE) AS max_value, rnk FROM ends e""")),
    "lowest_average_rank": (lambda v: op.lowest_average(kept(v)), with_views("tenure", f"""
        , {KEPT} SELECT interest_id, round(CAST(sum(ranking) AS DOUBLE) / count(*), 2) AS avg_value FROM kept
        GROUP BY 1 ORDER BY avg_value, interest_id LIMIT 5""")),
    "top_stddev": (lambda v: op.most_volatile(kept(v)), with_views("tenure", f"""
        , {KEPT} SELECT interest_id, round(stddev_samp(percentile_ranking), 2) AS stddev FROM kept
        GROUP BY 1 ORDER BY stddev DESC, interest_id LIMIT 5""")),
    "extreme_months": (lambda v: op.extreme_months(kept(v)), with_views("tenure", f"""
        , {KEPT}, chosen AS (SELECT interest_id, round(stddev_samp(percentile_ranking), 2) AS stddev FROM kept
          GROUP BY 1 ORDER BY stddev DESC, interest_id LIMIT 5),
        ends AS (SELECT interest_id, stddev, max(percentile_ranking) AS max_value, min(percentile_ranking) AS min_value
          FROM kept JOIN chosen USING (interest_id) WHERE month_year IS NOT NULL GROUP BY 1, 2)
        SELECT e.*, max(CASE WHEN percentile_ranking = max_value THEN month_year END) AS max_month,
          min(CASE WHEN percentile_ranking = min_value THEN month_year END) AS min_month
        FROM ends e JOIN kept k USING (interest_id) WHERE month_year IS NOT NULL GROUP BY ALL""")),
}
