"""Subscription state and payments on the sample customers."""

from decimal import Decimal

import pytest

from caseloom.operators import subscription as op

from .conftest import rows
from .tables import PAYMENTS, d


@pytest.fixture(scope="module")
def subs(case):
    return case("subscriptions")


@pytest.fixture(scope="module")
def plans(case):
    return case("plans")


def schedule(spark, plans, changes, horizon="2020-12-31"):
    data = [(1, p, d(day)) for p, day in changes]
    df = spark.createDataFrame(data, "customer_id int, plan_id int, start_date date")
    return [(r.plan_id, str(r.payment_date), float(r.amount)) for r in op.payment_schedule(df, plans, horizon).orderBy("payment_order").collect()]


def test_sample_payments(subs, plans):
    paid = op.payment_schedule(subs, plans, "2020-12-31")
    expected = [(c, p, d(day), Decimal(a), n) for c, p, day, a, n in PAYMENTS]
    assert rows(paid, "customer_id", "plan_name", "payment_date", "amount", "payment_order") == sorted(expected, key=repr)


def test_payments_recover_after_short_months(spark, plans):
    assert [day for _, day, _ in schedule(spark, plans, [(1, "2020-01-31")], "2020-05-31")] == [
        "2020-01-31", "2020-02-29", "2020-03-31", "2020-04-30", "2020-05-31"
    ]


def test_change_on_a_billing_date_is_paid_in_full(spark, plans):
    assert schedule(spark, plans, [(1, "2020-01-10"), (2, "2020-03-10")], "2020-03-31")[-1] == (2, "2020-03-10", 19.9)
    assert schedule(spark, plans, [(1, "2020-01-10"), (2, "2020-03-11")], "2020-03-31")[-1] == (2, "2020-03-11", 10.0)


def test_annual_after_pro_monthly_waits_for_the_billing_date(spark, plans):
    assert schedule(spark, plans, [(2, "2020-01-10"), (3, "2020-02-20")]) == [
        (2, "2020-01-10", 19.9), (2, "2020-02-10", 19.9), (3, "2020-03-10", 199.0)
    ]
    assert schedule(spark, plans, [(3, "2019-02-01")], "2021-01-31") == [(3, "2019-02-01", 199.0), (3, "2020-02-01", 199.0)]


def test_churn_stops_payments(spark, plans):
    assert schedule(spark, plans, [(2, "2020-01-10"), (4, "2020-02-10")]) == [(2, "2020-01-10", 19.9)]


def test_transitions(subs, plans):
    assert rows(op.next_state(subs, plans).filter("plan_name = 'trial'"), "next_plan_name", "changes", "percent_of_plan") == [
        ("basic monthly", 3, 42.9), ("pro annual", 1, 14.3), ("pro monthly", 3, 42.9)
    ]
    assert rows(op.after_initial_trial(subs, plans), "plan_name", "customers", "percent_rounded") == [
        ("basic monthly", 3, 43.0), ("pro annual", 1, 14.0), ("pro monthly", 3, 43.0)
    ]
    assert rows(op.changes_between(subs, op.PRO_MONTHLY, op.BASIC, "2020-01-01", "2021-01-01")) == [(0, 0)]
    assert rows(op.changes_between(subs, op.BASIC, op.PRO_MONTHLY, "2021-01-01", "2022-01-01")) == [(1, 1)]


def test_states_and_counts(subs, plans):
    assert rows(op.customer_count(subs)) == [(7,)]
    assert rows(op.churn_rate(subs)) == [(1, 14.3)]
    assert rows(op.state_as_of(subs, plans, "2020-12-31"), "plan_name", "customers") == [
        ("basic monthly", 2), ("churn", 1), ("pro annual", 3), ("pro monthly", 1)
    ]
    assert rows(op.starts_after(subs, plans, "2020-12-31")) == [(2, "pro monthly", 1)]
    assert set(rows(op.starts_by_month(subs))) == {(d(f"2020-{m:02}-01"), 1) for m in (3, 5, 6, 7, 8, 9, 12)}
    assert rows(op.starters_between(subs, op.PRO_ANNUAL, "2020-01-01", "2021-01-01")) == [(3,)]


def test_two_changes_on_one_day(spark, plans):
    data = [(1, 0, "2020-01-01"), (1, 2, "2020-01-08"), (1, 4, "2020-01-08"), (1, 2, "2020-01-08"), (2, 1, "2020-01-02")]
    subs = spark.createDataFrame([(c, p, d(day)) for c, p, day in data], "customer_id int, plan_id int, start_date date")
    assert rows(op.next_state(subs, plans), "plan_name", "next_plan_name", "changes") == [("pro monthly", "churn", 1), ("trial", "pro monthly", 1)]
    assert rows(op.state_as_of(subs, plans, "2020-01-31"), "plan_name", "customers") == [("basic monthly", 1), ("churn", 1)]
    assert rows(op.churn_rate(subs)) == [(1, 50.0)]
    assert rows(op.journey(subs, plans), "journey") == [("basic monthly (2020-01-02)",), ("trial (2020-01-01) > pro monthly (2020-01-08) > churn (2020-01-08)",)]
    assert rows(op.payment_schedule(subs, plans, "2020-01-31"), "customer_id", "payment_date") == [(2, d("2020-01-02"))]


def test_upgrades(subs):
    assert rows(op.upgrade_days(subs)) == [(16, 143), (19, 68), (2, 7)]
    assert rows(op.days_to_upgrade(subs)) == [(3, 72.67)]
    assert rows(op.upgrade_buckets(subs), "label", "customers") == [("0-30", 1), ("121-150", 1), ("61-90", 1)]


@pytest.mark.parametrize("days,label", [(0, "0-30"), (30, "0-30"), (31, "31-60"), (60, "31-60"), (61, "61-90")])
def test_bucket_borders(spark, days, label):
    import datetime as dt

    start = dt.date(2020, 1, 1)
    df = spark.createDataFrame([(1, 0, start), (1, 3, start + dt.timedelta(days))], "customer_id int, plan_id int, start_date date")
    assert rows(op.upgrade_buckets(df), "label") == [(label,)]


def test_journey(subs, plans):
    assert rows(op.journey(subs, plans).filter("customer_id = 15"), "journey") == [
        ("trial (2020-03-17) > pro monthly (2020-03-24) > churn (2020-04-29)",)
    ]
