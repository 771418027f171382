"""Delivery and ingredient questions over dirty item orders and runs."""

from __future__ import annotations

from ..operators import delivery as op, lists
from .sqlviews import with_views

MINUTES = "date_diff('minute', order_time, pickup_time)"
SPEED = "round(distance / (nullif(duration, 0) / CAST(60 AS DOUBLE)), 2)"
TOKENS = "unnest(string_split({0}, ', '))"
NEW_PRODUCT = "Supreme"

_USED = """
        SELECT order_id, customer_id, pizza_id, row_id, topping_id, sum(n) AS n FROM (
          SELECT i.order_id, i.customer_id, i.pizza_id, i.row_id, r.topping_id, 1 AS n FROM numbered i JOIN recipe_items r USING (pizza_id)
          WHERE i.exclusions IS NULL OR NOT list_contains(string_split(i.exclusions, ', '), CAST(r.topping_id AS VARCHAR))
          UNION ALL SELECT order_id, customer_id, pizza_id, row_id, CAST(t AS BIGINT), 1 FROM (
            SELECT *, unnest(string_split(extras, ', ')) AS t FROM numbered)) GROUP BY ALL"""

QUERIES = {
    "order_counts": (lambda v: op.order_counts(v.orders), with_views("items", """
        SELECT count(*) AS items, count(DISTINCT order_id) AS orders FROM items""")),
    "success_count": (lambda v: op.success_count(v.runs), with_views("runs", """
        SELECT runner_id, count(*) FILTER (cancellation IS NULL) AS successful_orders FROM runs GROUP BY 1""")),
    "delivered_by_type": (lambda v: op.delivered_by_type(v.orders, v.runs, v.pizza_names), with_views("delivered_items", """
        SELECT pizza_id, p_name AS pizza_name, count(*) AS delivered FROM delivered_items JOIN part ON p_partkey = pizza_id GROUP BY 1, 2""")),
    "ordered_by_customer_and_type": (
        lambda v: op.ordered_by_customer_and_type(v.orders, v.pizza_names), with_views("items", """
        SELECT customer_id, p_name AS pizza_name, count(*) AS ordered FROM items JOIN part ON p_partkey = pizza_id GROUP BY 1, 2""")),
    "max_items_orders": (lambda v: op.largest_orders(v.orders, v.runs), with_views("delivered_items", """
        SELECT order_id, customer_id, n AS items FROM (
          SELECT order_id, customer_id, count(*) AS n, dense_rank() OVER (ORDER BY count(*) DESC) AS r
          FROM delivered_items GROUP BY 1, 2) WHERE r = 1""")),
    "change_counts": (lambda v: op.change_counts(v.orders, v.runs), with_views("delivered_items", """
        SELECT customer_id, count(*) FILTER (exclusions IS NOT NULL OR extras IS NOT NULL) AS at_least_one_change,
          count(*) FILTER (exclusions IS NULL AND extras IS NULL) AS no_change,
          count(*) FILTER (exclusions IS NOT NULL AND extras IS NOT NULL) AS both_changes FROM delivered_items GROUP BY 1""")),
    "both_changes": (lambda v: op.both_changes(v.orders, v.runs), with_views("delivered_items", """
        SELECT count(*) AS both_changes FROM delivered_items WHERE exclusions IS NOT NULL AND extras IS NOT NULL""")),
    "signup_week": (lambda v: op.signups_by_week(v.runners), """
        SELECT week_of_year, count(*) AS runner_count FROM (
          SELECT (dayofyear(d) - 1 + dayofweek(date_trunc('year', d))) // 7 + 1 AS week_of_year
          FROM (SELECT CAST(min(o_orderdate) AS DATE) + 3 AS d FROM orders GROUP BY o_custkey)) GROUP BY 1"""),
    "avg_minutes_int": (lambda v: op.pickup_minutes(v.orders, v.runs), with_views("delivered_items", f"""
        SELECT runner_id, CAST(sum({MINUTES}) // count(*) AS BIGINT) AS avg_minutes_int,
          sum({MINUTES}) / count(*) AS avg_minutes FROM delivered_items GROUP BY 1""")),
    "minute_diff": (lambda v: op.minutes_by_order_size(v.orders, v.runs), with_views("delivered_items", """
        SELECT items, CAST(sum(m) // count(*) AS BIGINT) AS avg_minutes_int, sum(m) / count(*) AS avg_minutes FROM (
          SELECT order_id, count(*) AS items, date_diff('minute', any_value(order_time), any_value(pickup_time)) AS m
          FROM delivered_items GROUP BY 1) GROUP BY 1""")),
    "avg_distance": (lambda v: op.average_distance(v.orders, v.runs), with_views("delivered_items", """
        SELECT customer_id, CAST((2 * tenths + n) // (2 * n) AS DOUBLE) / 10 AS avg_distance FROM (
          SELECT customer_id, count(*) AS n, CAST(sum(CAST(round(distance * 10) AS BIGINT)) AS BIGINT) AS tenths
          FROM delivered_items GROUP BY 1)""")),
    "value_spread": (lambda v: op.duration_spread(v.runs), with_views("runs", """
        SELECT max(duration) - min(duration) AS spread FROM runs""")),
    "speed": (lambda v: op.run_speeds(v.runs), with_views("delivered", f"""
        SELECT runner_id, order_id, {SPEED} AS speed FROM delivered""")),
    "success_percent": (lambda v: op.success_percent(v.runs), with_views("runs", """
        SELECT runner_id, round(100.0 * count(distance) / count(*), 2) AS success_percent FROM runs GROUP BY 1""")),
    "revenue_by_type": (lambda v: op.revenue(v.orders, v.runs, v.prices), with_views("delivered_items prices", """
        SELECT CAST(sum(price) AS BIGINT) AS revenue, '$' || sum(price) AS revenue_text
        FROM delivered_items JOIN prices USING (pizza_id)""")),
    "extras_surcharge": (lambda v: op.revenue(v.orders, v.runs, v.prices, per_extra=1), with_views("delivered_items prices", """
        SELECT CAST(sum(p) AS BIGINT) AS revenue, '$' || sum(p) AS revenue_text FROM (
          SELECT price + coalesce(len(string_split(extras, ', ')), 0) AS p FROM delivered_items JOIN prices USING (pizza_id))""")),
    "delivery_fact": (lambda v: op.delivery_fact(v.orders, v.runs, v.ratings), with_views("delivered_items", f"""
        SELECT customer_id, order_id, runner_id,
          CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderpriority[1] AS BIGINT) END AS rating,
          order_time, pickup_time, {MINUTES} AS pickup_minutes, duration, {SPEED} AS avg_speed, count(*) AS total_items
        FROM delivered_items JOIN orders ON o_orderkey = order_id GROUP BY ALL""")),
    "net_after_cost": (lambda v: op.net_after_cost(v.orders, v.runs, v.prices), with_views("delivered_items prices", """
        , earned AS (SELECT sum(price) AS r FROM delivered_items JOIN prices USING (pizza_id)),
        paid AS (SELECT sum(CAST(d AS DECIMAL(9,1)) * 0.30) AS c FROM (SELECT order_id, any_value(distance) AS d FROM delivered_items GROUP BY 1))
        SELECT CAST(r AS BIGINT) AS revenue, CAST(c AS DOUBLE) AS cost, CAST(r - c AS DOUBLE) AS net FROM earned, paid""")),
    "net_after_item_cost": (
        lambda v: op.net_after_cost(v.orders, v.runs, v.prices, cost_per="item"), with_views("delivered_items prices", """
        , earned AS (SELECT sum(price) AS r FROM delivered_items JOIN prices USING (pizza_id)),
        paid AS (SELECT sum(CAST(distance AS DECIMAL(9,1)) * 0.30) AS c FROM delivered_items)
        SELECT CAST(r AS BIGINT) AS revenue, CAST(c AS DOUBLE) AS cost, CAST(r - c AS DOUBLE) AS net FROM earned, paid""")),
    "explode_list": (lambda v: lists.token_counts(v.orders, "extras", v.toppings), with_views("items toppings", """
        SELECT topping_id, topping_name, count(*) AS times
        FROM (SELECT CAST(unnest(string_split(extras, ', ')) AS BIGINT) AS topping_id FROM items) JOIN toppings USING (topping_id)
        GROUP BY 1, 2""")),
    "common_exclusion": (lambda v: lists.token_counts(v.orders, "exclusions", v.toppings), with_views("items toppings", """
        SELECT topping_id, topping_name, count(*) AS times
        FROM (SELECT CAST(unnest(string_split(exclusions, ', ')) AS BIGINT) AS topping_id FROM items) JOIN toppings USING (topping_id)
        GROUP BY 1, 2""")),
    "recipe_list": (lambda v: lists.recipe_list(v.recipes, v.pizza_names, v.toppings), with_views("recipe_items", """
        SELECT pizza_id, pizza_name, string_agg(topping_name, ', ' ORDER BY topping_id) AS ingredients FROM recipe_items GROUP BY 1, 2""")),
    "order_label": (lambda v: lists.order_label(v.orders, v.pizza_names, v.toppings), with_views("items toppings", """
        , listed AS (SELECT list, string_agg(topping_name, ', ' ORDER BY topping_id) AS names FROM (
          SELECT list, CAST(unnest(string_split(list, ', ')) AS BIGINT) AS topping_id
          FROM (SELECT exclusions AS list FROM items UNION SELECT extras FROM items)) JOIN toppings USING (topping_id) GROUP BY 1)
        SELECT order_id, customer_id, pizza_id,
          concat_ws(' - ', p_name, 'Exclude ' || e.names, 'Extra ' || x.names) AS label
        FROM items JOIN part ON p_partkey = pizza_id
          LEFT JOIN listed e ON e.list = exclusions LEFT JOIN listed x ON x.list = extras""")),
    "ingredient_list": (
        lambda v: lists.ingredient_list(v.orders, v.pizza_names, v.recipes, v.toppings),
        with_views("items recipe_items", f"""
        , numbered AS (SELECT *, row_number() OVER () AS row_id FROM items), used AS ({_USED})
        SELECT n.order_id, n.customer_id, n.pizza_id, p_name || ': ' || coalesce(string_agg(
            CASE WHEN u.n > 1 THEN u.n || 'x' ELSE '' END || topping_name, ', ' ORDER BY lower(topping_name)), '') AS ingredients
        FROM numbered n JOIN part ON p_partkey = n.pizza_id LEFT JOIN used u ON u.row_id = n.row_id LEFT JOIN toppings t ON t.topping_id = u.topping_id
        GROUP BY n.row_id, n.order_id, n.customer_id, n.pizza_id, p_name""")),
    "ingredient_usage": (
        lambda v: lists.ingredient_usage(v.orders, v.runs, v.recipes, v.toppings),
        with_views("items delivered recipe_items", f"""
        , numbered AS (SELECT *, row_number() OVER () AS row_id FROM items), used AS ({_USED})
        SELECT topping_id, topping_name, CAST(sum(n) AS BIGINT) AS times_used
        FROM used JOIN delivered USING (order_id) JOIN toppings USING (topping_id) GROUP BY 1, 2""")),
    "new_product": (
        lambda v: lists.with_everything(v.pizza_names, v.recipes, v.toppings, NEW_PRODUCT), with_views("recipe_items", f"""
        SELECT pizza_id, pizza_name, string_agg(topping_id, ', ' ORDER BY topping_id) AS toppings FROM recipe_items GROUP BY 1, 2
        UNION ALL SELECT (SELECT max(p_partkey) + 1 FROM part), '{NEW_PRODUCT}', string_agg(topping_id, ', ' ORDER BY topping_id) FROM toppings""")),
}
