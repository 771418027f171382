"""Delivery and ingredient questions on the small dirty tables."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from caseloom.operators import clean, delivery as op, lists
from caseloom.sources.sinks import append_rows

from .conftest import rows
from .tables import ROWS


@pytest.fixture(scope="module")
def kitchen(case):
    class Kitchen:
        orders = clean.clean_orders(case("customer_orders"))
        runs = clean.clean_runs(case("runner_orders"))
        names, recipes, toppings = case("pizza_names"), case("pizza_recipes"), case("pizza_toppings")
        ratings, runners = case("ratings"), case("runners")
        raw_orders, raw_runs = case("customer_orders"), case("runner_orders")

    return Kitchen


@pytest.fixture(scope="module")
def prices(spark):
    return spark.createDataFrame([(1, 12), (2, 10)], "pizza_id int, price int")


def test_cleaning(kitchen):
    cleaned = {r.order_id: r for r in kitchen.runs.collect()}
    assert cleaned[8].distance == Decimal("23.4") and cleaned[8].duration == 15 and cleaned[8].cancellation is None
    assert cleaned[10].duration == 10 and cleaned[1].cancellation is None
    assert cleaned[6].pickup_time is None and cleaned[6].distance is None
    assert {r.exclusions for r in kitchen.orders.collect()} == {"", "4", None, "2, 6"}
    rejected = clean.reject_counts(kitchen.raw_runs, {"distance": "decimal(5,1)", "duration": "int"}).first()
    assert (rejected.distance, rejected.duration) == (8, 8)


def test_grain(kitchen):
    assert rows(clean.repeated_keys(kitchen.ratings, ["order_id"])) == []
    assert rows(clean.repeated_keys(kitchen.raw_orders, ["order_id", "pizza_id"])) == [(10, 1, 2), (4, 1, 2)]


def test_duplicates_are_real_quantities(kitchen, spark):
    deduped = clean.drop_exact_duplicates(kitchen.raw_orders)
    assert deduped.count() == 13
    again = spark.createDataFrame([ROWS["customer_orders"][4]], kitchen.raw_orders.schema)
    assert append_rows(deduped, again).count() == 14


def test_counts(kitchen):
    assert rows(op.order_counts(kitchen.orders)) == [(14, 10)]
    assert rows(op.success_count(kitchen.runs)) == [(1, 4), (2, 3), (3, 1)]
    assert rows(op.delivered_by_type(kitchen.orders, kitchen.runs, kitchen.names)) == [(1, "Meatlovers", 9), (2, "Vegetarian", 3)]
    assert rows(op.ordered_by_customer_and_type(kitchen.orders, kitchen.names)) == [
        (101, "Meatlovers", 2), (101, "Vegetarian", 1), (102, "Meatlovers", 2), (102, "Vegetarian", 1),
        (103, "Meatlovers", 3), (103, "Vegetarian", 1), (104, "Meatlovers", 3), (105, "Vegetarian", 1),
    ]
    assert rows(op.largest_orders(kitchen.orders, kitchen.runs)) == [(4, 103, 3)]


@pytest.mark.parametrize("raw", [False, True])
def test_changes_with_every_form_of_missing(kitchen, raw):
    """Empty text and NULL mean no change; the word null is cleaned away first."""
    orders = clean.sentinels_to_null(kitchen.raw_orders, ["exclusions", "extras"], keep_empty=False) if raw else kitchen.orders
    assert rows(op.change_counts(orders, kitchen.runs)) == [
        (101, 0, 2, 0), (102, 0, 3, 0), (103, 3, 0, 0), (104, 2, 1, 1), (105, 1, 0, 0)
    ]
    assert rows(op.both_changes(orders, kitchen.runs)) == [(1,)]


def test_runner_metrics(kitchen):
    assert rows(op.signups_by_week(kitchen.runners)) == [(2, 2), (3, 1), (4, 1)]
    pickups = {r.runner_id: r for r in op.pickup_minutes(kitchen.orders, kitchen.runs).collect()}
    assert {k: v.avg_minutes_int for k, v in pickups.items()} == {1: 15, 2: 24, 3: 10}
    assert round(pickups[1].avg_minutes, 2) == 15.67 and pickups[2].avg_minutes == 24.2
    by_size = {r["items"]: r for r in op.minutes_by_order_size(kitchen.orders, kitchen.runs).collect()}
    assert {k: (v.avg_minutes_int, v.avg_minutes) for k, v in by_size.items()} == {1: (12, 12.2), 2: (18, 18.5), 3: (30, 30.0)}
    assert rows(op.average_distance(kitchen.orders, kitchen.runs)) == [
        (c, Decimal(x)) for c, x in [(101, "20.0"), (102, "16.7"), (103, "23.4"), (104, "10.0"), (105, "25.0")]
    ]
    assert rows(op.duration_spread(kitchen.runs)) == [(30,)]
    assert {r.order_id: r.speed for r in op.run_speeds(kitchen.runs).collect()} == {
        1: 37.5, 2: 44.44, 3: 40.2, 4: 35.1, 5: 40.0, 7: 60.0, 8: 93.6, 10: 60.0
    }
    assert rows(op.success_percent(kitchen.runs)) == [(1, 100.0), (2, 75.0), (3, 50.0)]


def test_money(kitchen, prices):
    assert rows(op.revenue(kitchen.orders, kitchen.runs, prices)) == [(138, "$138")]
    assert rows(op.revenue(kitchen.orders, kitchen.runs, prices, per_extra=1), "revenue") == [(142,)]
    assert op.net_after_cost(kitchen.orders, kitchen.runs, prices).first().net == Decimal("94.44")
    assert op.net_after_cost(kitchen.orders, kitchen.runs, prices, cost_per="item").first().net == Decimal("73.38")


def test_the_way_of_unpriced_items_is_paid(kitchen, prices):
    # Without a price for pizza 2 only the twelve items of the others earn; the distances of all delivered orders stay.
    full, part = (op.net_after_cost(kitchen.orders, kitchen.runs, p).first() for p in (prices, prices.where("pizza_id <> 2")))
    assert part.cost == full.cost == Decimal("43.56") and part.revenue < full.revenue
    assert op.net_after_cost(kitchen.orders, kitchen.runs, prices.limit(0)).first().revenue == 0
    each = op.net_after_cost(kitchen.orders, kitchen.runs, prices.limit(0), cost_per="item").first()
    assert each.cost == Decimal("64.62")


def test_delivery_fact(kitchen):
    fact = {r.order_id: r for r in op.delivery_fact(kitchen.orders, kitchen.runs, kitchen.ratings).collect()}
    assert sorted(fact) == [1, 2, 3, 4, 5, 7, 8, 10]
    assert (fact[4].rating, fact[4].pickup_minutes, fact[4].total_items, fact[4].avg_speed) == (3, 30, 3, 35.1)


def test_token_counts_and_recipes(kitchen):
    assert rows(lists.token_counts(kitchen.orders, "extras", kitchen.toppings)) == [(1, "Bacon", 4), (4, "Cheese", 1), (5, "Chicken", 1)]
    assert rows(lists.token_counts(kitchen.orders, "exclusions", kitchen.toppings)) == [
        (2, "BBQ Sauce", 1), (4, "Cheese", 4), (6, "Mushrooms", 1)
    ]
    assert rows(lists.recipe_list(kitchen.recipes, kitchen.names, kitchen.toppings), "pizza_name", "ingredients") == [
        ("Meatlovers", "Bacon, BBQ Sauce, Beef, Cheese, Chicken, Mushrooms, Pepperoni, Salami"),
        ("Vegetarian", "Cheese, Mushrooms, Onions, Peppers, Tomatoes, Tomato Sauce"),
    ]


def test_labels(kitchen):
    labels = lists.order_label(kitchen.orders, kitchen.names, kitchen.toppings)
    assert labels.count() == 14
    by_order = rows(labels.filter("order_id >= 9"), "order_id", "label")
    assert set(by_order) == {
        (9, "Meatlovers - Exclude Cheese - Extra Bacon, Chicken"),
        (10, "Meatlovers"),
        (10, "Meatlovers - Exclude BBQ Sauce, Mushrooms - Extra Bacon, Cheese"),
    }


def test_ingredient_lists_and_usage(kitchen):
    ingredients = lists.ingredient_list(kitchen.orders, kitchen.names, kitchen.recipes, kitchen.toppings)
    assert ingredients.count() == 14
    assert ("Meatlovers: 2xBacon, Beef, 2xCheese, Chicken, Pepperoni, Salami",) in rows(ingredients.filter("order_id = 10"), "ingredients")
    # Alphabetical order without regard to case: Bacon comes before BBQ Sauce.
    assert rows(ingredients.filter("order_id = 1"), "ingredients") == [
        ("Meatlovers: Bacon, BBQ Sauce, Beef, Cheese, Chicken, Mushrooms, Pepperoni, Salami",)
    ]
    usage = lists.ingredient_usage(kitchen.orders, kitchen.runs, kitchen.recipes, kitchen.toppings)
    assert {r.topping_name: r.times_used for r in usage.collect()} == {
        "Bacon": 12, "Mushrooms": 11, "Cheese": 10, "Beef": 9, "Chicken": 9, "Pepperoni": 9, "Salami": 9, "BBQ Sauce": 8,
        "Onions": 3, "Peppers": 3, "Tomatoes": 3, "Tomato Sauce": 3,
    }


def test_new_product(kitchen):
    added = lists.with_everything(kitchen.names, kitchen.recipes, kitchen.toppings, "Supreme")
    assert rows(added.filter("pizza_id = 3")) == [(3, "Supreme", "1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12")]
    assert added.count() == 3


def test_items_of_repeated_and_missing_orders(spark):
    """Every item meets every delivered run of its order; nothing is counted by order first."""
    items = spark.createDataFrame([(1, 7), (1, 7), (1, 8), (2, 7), (None, 7), (3, None), (4, 9)], "order_id int, pizza_id int")
    runs = spark.createDataFrame([(1, 2.5), (1, 3.0), (2, None), (3, 1.0), (None, 1.0), (4, 1.0)], "order_id int, distance double")
    names = spark.createDataFrame([(7, "a"), (8, "b"), (8, "c"), (None, "d")], "pizza_id int, pizza_name string")
    found = op.delivered_by_type(items, runs, names)
    assert rows(found) == [(7, "a", 4), (8, "b", 2), (8, "c", 2)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [pizza_id" in plan and "Aggregate [order_id" not in plan


LISTS = [(1, "1, 2", None), (2, "1, 2", "3"), (3, "3", "1, 2"), (4, "77", "3"), (5, None, None), (6, "", "3"), (6, "", "3"), (7, "2", "77, 1")]


@pytest.mark.parametrize("frequent", [0, 1, 2, 100])
def test_labels_of_common_and_rare_lists(spark, frequent):
    items = spark.createDataFrame([(k, k, 1, e, x) for k, e, x in LISTS], "order_id int, customer_id int, pizza_id int, exclusions string, extras string")
    names = spark.createDataFrame([(1, "P")], "pizza_id int, pizza_name string")
    toppings = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "topping_id int, topping_name string")
    found = lists.order_label(items, names, toppings, frequent)
    assert rows(found, "order_id", "label") == [
        (1, "P - Exclude a, b"), (2, "P - Exclude a, b - Extra c"), (3, "P - Exclude c - Extra a, b"), (4, "P - Extra c"), (5, "P"),
        (6, "P - Extra c"), (6, "P - Extra c"), (7, "P - Exclude b - Extra a"),
    ]
