"""Balances, growth and moving averages on a small ledger."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from caseloom.operators import ledger as op

from .conftest import rows
from .tables import d

TXNS = [
    (1, d("2020-01-02"), "deposit", 312, 1), (1, d("2020-03-05"), "purchase", 612, 2), (1, d("2020-03-17"), "deposit", 324, 3),
    (1, d("2020-03-19"), "purchase", 664, 4),
    (2, d("2020-01-03"), "deposit", 549, 5), (2, d("2020-03-24"), "deposit", 61, 6),
    (3, d("2020-01-10"), "deposit", 100, 7), (3, d("2020-01-10"), "withdrawal", 40, 8), (3, d("2020-01-20"), "deposit", 5, 9),
    (3, d("2020-02-01"), "withdrawal", 65, 10), (3, d("2020-03-01"), "deposit", 10, 11),
]


@pytest.fixture(scope="module")
def txns(spark):
    return spark.createDataFrame(TXNS, "customer_id int, txn_date date, txn_type string, txn_amount int, txn_id int")


def test_totals_and_deposits(txns):
    assert rows(op.totals_by_type(txns)) == [("deposit", 7, 1361), ("purchase", 2, 1276), ("withdrawal", 2, 105)]
    averages = op.deposit_averages(txns).first()
    assert averages.avg_of_averages_int == (318 + 305 + 38) // 3
    assert averages.avg_count_int == 2 and round(averages.avg_count, 4) == 2.3333
    # An average of per-customer averages is not the overall average.
    assert float(averages.avg_of_averages) == round((318 + 305 + 115 / 3) / 3, 4)
    assert round(averages.overall_average, 4) == round(1361 / 7, 4)


def test_active_customers_reads_one_as_exactly_one(txns):
    assert rows(op.active_customers(txns)) == [(d("2020-01-01"), 1)]
    more = txns.unionByName(txns.filter("txn_id = 8"))
    assert rows(op.active_customers(more)) == []
    assert rows(op.active_customers(more, exactly_one=False)) == [(d("2020-01-01"), 1)]


def test_running_balance_peers(txns):
    assert rows(op.running_balance(txns).filter("customer_id = 3"), "txn_id", "running_balance") == [
        (10, 0), (11, 10), (7, 60), (8, 60), (9, 65)
    ]
    assert rows(op.running_balance_per_row(txns).filter("customer_id = 3"), "txn_id", "running_balance") == [
        (10, 0), (11, 10), (7, 100), (8, 60), (9, 65)
    ]


def test_closing_balance(txns):
    closing = op.closing_balance(txns)
    assert rows(closing.filter("customer_id < 3"), "customer_id", "month", "closing_balance") == [
        (1, d("2020-01-01"), 312), (1, d("2020-03-01"), -640), (2, d("2020-01-01"), 549), (2, d("2020-03-01"), 610)
    ]
    dense = op.closing_balance(txns, densify=True)
    assert rows(dense.filter("customer_id = 2"), "month", "net_amount", "closing_balance") == [
        (d("2020-01-01"), 549, 549), (d("2020-02-01"), 0, 549), (d("2020-03-01"), 61, 610)
    ]
    assert rows(op.monthly_provision(txns)) == [(d("2020-01-01"), 926), (d("2020-02-01"), 0), (d("2020-03-01"), -20)]


def test_growth_skips_zero_balances(txns):
    growth = {(r.customer_id, r.month.month): (r.next_balance, r.growth, r.grew) for r in op.balance_growth(txns).collect()}
    assert growth[(1, 1)] == (-640, round(-640 / 312 - 1, 2), 0)
    assert growth[(2, 1)] == (610, 0.11, 1)
    assert growth[(2, 3)] == (610, None, 0)
    # Customer 3's February balance is zero: January compares with March.
    assert growth[(3, 1)] == (10, -0.85, 0) and (3, 2) not in growth
    share = op.growth_share(txns).first()
    assert (share.grown, share.customer_months) == (1, 6)


def test_stats_agree_with_rows(txns):
    stats = {r.customer_id: tuple(r)[1:] for r in op.balance_stats(txns).collect()}
    assert stats[3] == (0, 39, (60 + 60 + 65 + 0 + 10) / 5, 65)
    by_row = rows(op.balance_stats_rows(txns), "customer_id", "min_balance", "avg_balance", "max_balance")
    assert set(by_row) == {(k, low, exact, high) for k, (low, _, exact, high) in stats.items()} and len(by_row) == len(TXNS)


def test_last_running_balance_is_last_closing_balance(txns):
    last_run = op.running_balance(txns).groupBy("customer_id").agg(F.max_by("running_balance", "txn_date").alias("b"))
    last_close = op.closing_balance(txns).groupBy("customer_id").agg(F.max_by("closing_balance", "month").alias("b"))
    assert rows(last_run) == rows(last_close)


def test_moving_averages_differ_by_rows_and_days(txns):
    by_rows = {r.txn_id: r.moving_avg for r in op.moving_average_rows(txns, 2).collect()}
    by_days = {r.txn_id: r.moving_avg for r in op.moving_average_days(txns, 30).collect()}
    assert len(by_rows) == len(by_days) == len(TXNS)
    assert by_rows[2] == (312 - 612) / 2 and by_days[2] == -612
    assert by_days[10] == (100 - 40 + 5 - 65) / 4 and by_days[11] == (-65 + 10) / 2
    assert by_days[7] == by_days[8] == 30


def test_decimal_amounts(spark):
    df = spark.createDataFrame([(1, dt.date(2020, 1, 1), "deposit", Decimal("0.10"), 1), (1, dt.date(2020, 1, 2), "purchase", Decimal("0.30"), 2)],
                               "customer_id int, txn_date date, txn_type string, txn_amount decimal(12,2), txn_id int")
    assert rows(op.running_balance(df), "running_balance") == [(Decimal("-0.20"),), (Decimal("0.10"),)]
