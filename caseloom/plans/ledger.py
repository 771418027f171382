"""Ledger questions: orders as account transactions, events as wallet transactions with a time of day."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ledger as op
from ..sources.schemas import DATA_TABLES, schema
from ..sources.views import Views
from ..streaming.balance import run_balance_stream
from .sqlviews import with_views


def realtime_balance(v: Views):
    """The event table read as a stream of files until nothing is left."""
    # The pattern finds the table as one file and as a folder of part files.
    stream = v.spark.readStream.schema(schema(DATA_TABLES["events"])).parquet(f"{v.t.folder}/events.parquet*")
    return run_balance_stream(v.wallet_rows(stream))


def hour_slice():
    """Hours since the start of 1970 by the clock, a fine slice for busy wallets."""
    return F.unix_date(F.col("txn_date")) * 24 + F.hour("txn_time")


SIGNED = "CAST(net AS DOUBLE) AS signed_amount"
ROW = "customer_id, txn_date, txn_type, CAST(txn_amount AS DOUBLE) AS txn_amount, txn_id"

QUERIES = {
    "signed_amount": (lambda v: op.signed_amount(v.txns), with_views("txns", f"SELECT {ROW}, {SIGNED} FROM txns")),
    "count_by_type": (lambda v: op.totals_by_type(v.txns), with_views("txns", """
        SELECT txn_type, count(*) AS txns, CAST(sum(txn_amount) AS DOUBLE) AS total_amount FROM txns GROUP BY 1""")),
    "avg_of_sums": (lambda v: op.deposit_averages(v.txns), with_views("txns", """
        SELECT CAST(sum(n) // count(*) AS BIGINT) AS avg_count_int, sum(n) / count(*) AS avg_count,
          CAST(floor(sum(floor(CAST(s AS DOUBLE) / n)) / count(*)) AS BIGINT) AS avg_of_averages_int,
          -- millionths, halves up, then ten-thousandths: whole-number arithmetic
          CAST((2 * sum(micro) + 100 * count(*)) // (200 * count(*)) AS DOUBLE) / 10000 AS avg_of_averages,
          CAST(sum(s) AS DOUBLE) / sum(n) AS overall_average
        FROM (SELECT customer_id, count(*) AS n, sum(txn_amount) AS s,
            (2 * CAST(sum(txn_amount) * 100 AS HUGEINT) * 10000 + count(*)) // (2 * count(*)) AS micro
          FROM txns WHERE txn_type = 'deposit' GROUP BY 1)""")),
    "active_customers": (lambda v: op.active_customers(v.txns, exactly_one=True), with_views("txns", """
        SELECT txn_month AS month, count(*) AS customers FROM (
          SELECT customer_id, txn_month FROM txns GROUP BY 1, 2
          HAVING count(*) FILTER (txn_type = 'deposit') > 1 AND count(*) FILTER (txn_type <> 'deposit') = 1) GROUP BY 1""")),
    "active_customers_any": (lambda v: op.active_customers(v.txns, exactly_one=False), with_views("txns", """
        SELECT txn_month AS month, count(*) AS customers FROM (
          SELECT customer_id, txn_month FROM txns GROUP BY 1, 2
          HAVING count(*) FILTER (txn_type = 'deposit') > 1 AND count(*) FILTER (txn_type <> 'deposit') >= 1) GROUP BY 1""")),
    "running_balance": (lambda v: op.running_balance(v.txns), with_views("txns", f"""
        SELECT {ROW}, {SIGNED}, CAST(sum(net) OVER (PARTITION BY customer_id ORDER BY txn_date) AS DOUBLE) AS running_balance FROM txns""")),
    "running_balance_per_row": (
        lambda v: op.running_balance_per_row(v.wallet, ["txn_time", "txn_id"], hour_slice()), with_views("wallet", f"""
        SELECT {ROW}, txn_time, {SIGNED}, CAST(sum(net) OVER (PARTITION BY customer_id ORDER BY txn_time, txn_id
          ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_balance FROM wallet""")),
    "closing_balance": (lambda v: op.closing_balance(v.txns), with_views("closing", """
        SELECT customer_id, txn_month AS month, CAST(net_amount AS DOUBLE) AS net_amount,
          CAST(closing_balance AS DOUBLE) AS closing_balance FROM closing""")),
    "closing_balance_dense": (lambda v: op.closing_balance(v.txns, densify=True), with_views("txns", """
        , spans AS (SELECT customer_id, unnest(generate_series(min(txn_month), (SELECT max(txn_month) FROM txns), INTERVAL 1 MONTH)) AS m
          FROM txns GROUP BY 1),
        filled AS (SELECT s.customer_id, CAST(m AS DATE) AS month, coalesce(sum(net), 0) AS net_amount
          FROM spans s LEFT JOIN txns t ON t.customer_id = s.customer_id AND t.txn_month = m GROUP BY 1, 2)
        SELECT customer_id, month, CAST(net_amount AS DOUBLE) AS net_amount,
          CAST(sum(net_amount) OVER (PARTITION BY customer_id ORDER BY month) AS DOUBLE) AS closing_balance FROM filled""")),
    "balance_growth": (lambda v: op.balance_growth(v.txns), with_views("closing", """
        , led AS (SELECT *, lead(closing_balance) OVER (PARTITION BY customer_id ORDER BY txn_month) AS nxt
          FROM closing WHERE closing_balance <> 0),
        rated AS (SELECT *, round(CAST(nxt AS DOUBLE) / CAST(closing_balance AS DOUBLE) - 1, 2) AS growth FROM led)
        SELECT customer_id, txn_month AS month, CAST(net_amount AS DOUBLE) AS net_amount,
          CAST(closing_balance AS DOUBLE) AS closing_balance, CAST(coalesce(nxt, closing_balance) AS DOUBLE) AS next_balance, growth,
          CAST(CASE WHEN nxt > closing_balance AND growth > 0.05 THEN 1 ELSE 0 END AS BIGINT) AS grew FROM rated""")),
    "growth_share": (lambda v: op.growth_share(v.txns), with_views("closing", """
        , led AS (SELECT *, lead(closing_balance) OVER (PARTITION BY customer_id ORDER BY txn_month) AS nxt
          FROM closing WHERE closing_balance <> 0)
        SELECT count(*) FILTER (up) AS grown, count(*) AS customer_months, count(*) FILTER (up) / count(*) AS growth_share FROM (
          SELECT nxt > closing_balance AND round(CAST(nxt AS DOUBLE) / CAST(closing_balance AS DOUBLE) - 1, 2) > 0.05 AS up FROM led)""")),
    "balance_stats": (lambda v: op.balance_stats(v.txns), with_views("txns", """
        SELECT customer_id, CAST(min(b) AS DOUBLE) AS min_balance, CAST(sum(b) AS DOUBLE) / count(*) AS avg_balance,
          CAST(trunc(CAST(sum(b) AS DOUBLE) / count(*)) AS BIGINT) AS avg_balance_int, CAST(max(b) AS DOUBLE) AS max_balance
        FROM (SELECT customer_id, sum(net) OVER (PARTITION BY customer_id ORDER BY txn_date) AS b FROM txns) GROUP BY 1""")),
    "balance_stats_rows": (lambda v: op.balance_stats_rows(v.txns), with_views("txns", f"""
        SELECT {ROW}, CAST(b AS DOUBLE) AS running_balance, CAST(min(b) OVER w AS DOUBLE) AS min_balance,
          CAST(sum(b) OVER w AS DOUBLE) / count(*) OVER w AS avg_balance, CAST(max(b) OVER w AS DOUBLE) AS max_balance
        FROM (SELECT *, sum(net) OVER (PARTITION BY customer_id ORDER BY txn_date) AS b FROM txns)
        WINDOW w AS (PARTITION BY customer_id)""")),
    "monthly_provision": (lambda v: op.monthly_provision(v.txns), with_views("closing", """
        SELECT txn_month AS month, CAST(sum(closing_balance) AS DOUBLE) AS provision FROM closing GROUP BY 1""")),
    "moving_avg_rows": (
        lambda v: op.moving_average_rows(v.wallet, 30, ["txn_time", "txn_id"], hour_slice()), with_views("wallet", f"""
        SELECT {ROW}, txn_time, {SIGNED}, CAST(sum(net) OVER w AS DOUBLE) / count(*) OVER w AS moving_avg,
          CAST(trunc(CAST(sum(net) OVER w AS DOUBLE) / count(*) OVER w) AS BIGINT) AS moving_avg_int FROM wallet
        WINDOW w AS (PARTITION BY customer_id ORDER BY txn_time, txn_id ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""")),
    "moving_avg_days": (lambda v: op.moving_average_days(v.txns, 30), with_views("txns", f"""
        SELECT {ROW}, {SIGNED}, CAST(sum(net) OVER w AS DOUBLE) / count(*) OVER w AS moving_avg FROM txns
        WINDOW w AS (PARTITION BY customer_id ORDER BY txn_date RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW)""")),
    "moving_avg_week": (lambda v: op.moving_average_days(v.wallet, 7), with_views("wallet", f"""
        SELECT {ROW}, txn_time, {SIGNED}, CAST(sum(net) OVER w AS DOUBLE) / count(*) OVER w AS moving_avg FROM wallet
        WINDOW w AS (PARTITION BY customer_id ORDER BY txn_date RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)""")),
    "realtime_balance": (realtime_balance, with_views("wallet", """
        SELECT customer_id, CAST(sum(net) AS DOUBLE) AS balance, count(*) AS txns, max(txn_time) AS last_txn_time FROM wallet GROUP BY 1""")),
}
