"""Subscription questions: orders as plan changes of customers."""

from __future__ import annotations

from ..operators import subscription as op
from .sqlviews import with_views

AS_OF = "1999-12-31"
YEAR = ("1999-01-01", "2000-01-01")
HORIZON = "2001-12-31"

_PAYMENTS = f"""
        , priced AS (SELECT m.*, p.plan_name, p.price, q.price AS prev_price,
            (year(start_date) - year(prev_start)) * 12 + month(start_date) - month(prev_start) AS apart
          FROM moves m JOIN plan_names p USING (plan_id) LEFT JOIN plan_names q ON q.plan_id = prev_plan_id WHERE p.price > 0),
        billed AS (SELECT *, CAST(prev_start + to_months(CAST(apart AS INTEGER)) AS DATE) AS same_month,
            CAST(prev_start + to_months(CAST(apart + 1 AS INTEGER)) AS DATE) AS month_after FROM priced),
        placed AS (SELECT *, CASE WHEN prev_plan_id = 2 AND plan_id = 3
              THEN CASE WHEN same_month >= start_date THEN same_month ELSE month_after END ELSE start_date END AS begins,
            CASE WHEN prev_plan_id = 1 AND plan_id IN (2, 3) AND same_month <> start_date THEN prev_price ELSE 0 END AS credit,
            CASE WHEN plan_id = 3 THEN 12 ELSE 1 END AS every FROM billed),
        spread AS (SELECT *, unnest(generate_series(0, 100)) AS k FROM placed),
        paid AS (SELECT *, CAST(begins + to_months(CAST(k * every AS INTEGER)) AS DATE) AS payment_date FROM spread)
        SELECT customer_id, CAST(plan_id AS BIGINT) AS plan_id, plan_name, payment_date,
          CAST(CASE WHEN k = 0 THEN price - credit ELSE price END AS DOUBLE) AS amount,
          row_number() OVER (PARTITION BY customer_id ORDER BY payment_date, start_date, plan_id) AS payment_order
        FROM paid WHERE payment_date <= DATE '{HORIZON}' AND (next_start IS NULL OR payment_date < next_start)"""

QUERIES = {
    "customer_count": (lambda v: op.customer_count(v.subs), with_views("subs", "SELECT count(DISTINCT customer_id) AS customers FROM subs")),
    "trial_starts": (lambda v: op.starts_by_month(v.subs), with_views("subs", """
        SELECT CAST(date_trunc('month', start_date) AS DATE) AS month, count(*) AS starts FROM subs WHERE plan_id = 0 GROUP BY 1""")),
    "starts_after": (lambda v: op.starts_after(v.subs, v.plans, AS_OF), with_views("subs plan_names", f"""
        SELECT CAST(plan_id AS BIGINT) AS plan_id, plan_name, count(*) AS starts FROM subs JOIN plan_names USING (plan_id)
        WHERE start_date > DATE '{AS_OF}' GROUP BY 1, 2""")),
    "churn_rate": (lambda v: op.churn_rate(v.subs), with_views("subs", """
        SELECT count(DISTINCT customer_id) FILTER (plan_id = 4) AS churned,
          round(100.0 * count(DISTINCT customer_id) FILTER (plan_id = 4) / count(DISTINCT customer_id), 1) AS churn_percent FROM subs""")),
    "next_state": (lambda v: op.next_state(v.subs, v.plans), with_views("moves plan_names", """
        SELECT a.plan_name, b.plan_name AS next_plan_name, count(*) AS changes,
          round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY a.plan_name), 1) AS percent_of_plan
        FROM moves m JOIN plan_names a ON a.plan_id = m.plan_id JOIN plan_names b ON b.plan_id = next_plan_id GROUP BY 1, 2""")),
    "after_initial_trial": (lambda v: op.after_initial_trial(v.subs, v.plans), with_views("moves plan_names subs", """
        , firsts AS (SELECT next_plan_id, count(*) AS n FROM moves WHERE pos = 1 AND plan_id = 0 AND next_plan_id IS NOT NULL GROUP BY 1)
        SELECT CAST(plan_id AS BIGINT) AS plan_id, plan_name, n AS customers,
          round(100.0 * n / (SELECT count(DISTINCT customer_id) FROM subs), 1) AS percent_of_customers,
          round(100.0 * n / (SELECT count(DISTINCT customer_id) FROM subs), 0) AS percent_rounded
        FROM firsts JOIN plan_names ON plan_id = next_plan_id""")),
    "downgrades": (lambda v: op.changes_between(v.subs, op.PRO_MONTHLY, op.BASIC, *YEAR), with_views("moves", """
        SELECT count(DISTINCT customer_id) AS customers, count(*) AS changes FROM moves
        WHERE plan_id = 2 AND next_plan_id = 1 AND year(next_start) = 1999""")),
    "state_as_of": (lambda v: op.state_as_of(v.subs, v.plans, AS_OF), with_views("moves plan_names", f"""
        , now AS (SELECT plan_id, count(*) AS n FROM moves
          WHERE start_date <= DATE '{AS_OF}' AND (next_start IS NULL OR next_start > DATE '{AS_OF}') GROUP BY 1)
        SELECT CAST(plan_id AS BIGINT) AS plan_id, plan_name, n AS customers,
          round(100.0 * n / (SELECT sum(n) FROM now), 1) AS percent_of_customers FROM now JOIN plan_names USING (plan_id)""")),
    "upgrades_in_year": (lambda v: op.starters_between(v.subs, op.PRO_ANNUAL, *YEAR), with_views("subs", """
        SELECT count(DISTINCT customer_id) AS customers FROM subs WHERE plan_id = 3 AND year(start_date) = 1999""")),
    "days_to_upgrade": (lambda v: op.days_to_upgrade(v.subs), with_views("subs", """
        SELECT count(*) AS customers, round(CAST(sum(d) AS DOUBLE) / count(*), 2) AS avg_days FROM (
          SELECT min(start_date) FILTER (plan_id = 3) - min(start_date) AS d FROM subs GROUP BY customer_id) WHERE d IS NOT NULL""")),
    "upgrade_buckets": (lambda v: op.upgrade_buckets(v.subs), with_views("subs", """
        , reached AS (SELECT min(start_date) FILTER (plan_id = 3) - min(start_date) AS d FROM subs GROUP BY customer_id)
        SELECT b AS bucket, count(*) AS customers, round(CAST(sum(d) AS DOUBLE) / count(*), 2) AS avg_days,
          CASE WHEN b = 0 THEN 0 ELSE 30 * b + 1 END || '-' || 30 * (b + 1) AS label
        FROM (SELECT d, CAST(CASE WHEN d <= 30 THEN 0 ELSE (d - 1) // 30 END AS BIGINT) AS b FROM reached WHERE d IS NOT NULL) GROUP BY b""")),
    "journey": (lambda v: op.journey(v.subs, v.plans), with_views("changes plan_names", """
        SELECT customer_id, count(*) AS steps,
          string_agg(plan_name || ' (' || CAST(start_date AS VARCHAR) || ')', ' > ' ORDER BY start_date, plan_id) AS journey
        FROM changes JOIN plan_names USING (plan_id) GROUP BY 1""")),
    "payment_schedule": (lambda v: op.payment_schedule(v.subs, v.plans, HORIZON), with_views("moves plan_names", _PAYMENTS)),
}
