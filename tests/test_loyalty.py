"""Loyalty questions on the small restaurant tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from caseloom.operators import loyalty as op

from .conftest import rows


@pytest.fixture(scope="module")
def diner(case):
    return case("sales"), case("menu"), case("members")


def test_spend_and_days(diner):
    sales, menu, _ = diner
    assert rows(op.total_spend(sales, menu)) == [("A", 76), ("B", 74), ("C", 36)]
    assert rows(op.visit_days(sales)) == [("A", 4), ("B", 6), ("C", 2)]


def test_first_and_favourite_items(diner):
    sales, menu, _ = diner
    assert rows(op.first_items(sales, menu)) == [("A", "curry"), ("A", "sushi"), ("B", "curry"), ("C", "ramen")]
    assert rows(op.most_purchased(sales, menu)) == [("ramen", 8)]
    assert rows(op.most_purchased(sales, menu, 3)) == [("curry", 4), ("ramen", 8), ("sushi", 3)]
    assert rows(op.favourite_items(sales, menu), "customer_id", "product_name", "purchase_count") == [
        ("A", "ramen", 3), ("B", "curry", 2), ("B", "ramen", 2), ("B", "sushi", 2), ("C", "ramen", 3)
    ]


def test_items_around_the_join_date(diner):
    sales, menu, members = diner
    assert rows(op.first_after_event(sales, menu, members)) == [("A", "ramen"), ("B", "sushi")]
    # Customer A has two items on the last day before joining: the lower product id is kept.
    assert rows(op.last_before_event(sales, menu, members), "customer_id", "product_name") == [("A", "sushi"), ("B", "sushi")]
    assert rows(op.spend_before_event(sales, menu, members)) == [("A", 2, 25), ("B", 3, 40)]


def test_points(diner):
    sales, menu, members = diner
    assert rows(op.points(sales, menu, ["sushi"])) == [("A", 860), ("B", 940), ("C", 360)]
    bonus = op.points_with_bonus(sales, menu, members, ["sushi"], "2021-01-01", "2021-02-01")
    assert rows(bonus) == [("A", 1370), ("B", 820)]


def test_member_flag_and_rank(diner):
    sales, menu, members = diner
    flags = op.member_flag(sales, menu, members)
    assert flags.count() == 15
    assert rows(flags.groupBy("customer_id", "member").count()) == [
        ("A", "N", 2), ("A", "Y", 4), ("B", "N", 3), ("B", "Y", 3), ("C", "N", 3)
    ]
    ranked = op.member_rank(sales, menu, members)
    assert rows(ranked.filter("member = 'N' AND ranking IS NOT NULL")) == []
    # The non-member curry of January 1 uses up rank 1.
    assert rows(ranked.filter("customer_id = 'A' AND product_name = 'curry'"), "order_date", "ranking") == [
        (dt.date(2021, 1, 1), None), (dt.date(2021, 1, 7), 2)
    ]


def test_rows_without_customer_are_kept(spark, diner):
    _, menu, members = diner
    sales = spark.createDataFrame([(None, "2021-01-01", 1), (None, "2021-01-02", 1)], "customer_id string, d string, product_id int")
    sales = sales.select("customer_id", F.col("d").cast("date").alias("order_date"), "product_id")
    assert op.member_rank(sales, menu, members).count() == 2
