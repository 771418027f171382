"""Loyalty questions over line items as sales, parts as the menu and customers as members."""

from __future__ import annotations

from ..operators import loyalty as op
from .sqlviews import with_views

DOUBLED = ("red widget", "hot ring")
PERIOD = ("1996-01-01", "1997-01-01")
DOUBLED_SQL = "product_name IN ('red widget', 'hot ring')"

QUERIES = {
    "spend_per_customer": (lambda v: op.total_spend(v.sales, v.menu), with_views("sales menu", """
        SELECT customer_id, CAST(sum(price) AS DOUBLE) AS total_spent FROM sales JOIN menu USING (product_id) GROUP BY 1""")),
    "distinct_days": (lambda v: op.visit_days(v.sales), with_views("sales", """
        SELECT customer_id, count(DISTINCT order_date) AS visit_days FROM sales GROUP BY 1""")),
    "first_item": (lambda v: op.first_items(v.sales, v.menu), with_views("sales menu", """
        SELECT DISTINCT customer_id, product_name FROM (
          SELECT *, min(order_date) OVER (PARTITION BY customer_id) AS first_day FROM sales) JOIN menu USING (product_id)
        WHERE order_date = first_day""")),
    "top_item": (lambda v: op.most_purchased(v.sales, v.menu), with_views("menu", """
        SELECT product_name, count(*) AS purchase_count FROM lineitem JOIN menu ON product_id = l_partkey
        JOIN orders ON o_orderkey = l_orderkey GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""")),
    "favorite_item": (lambda v: op.favourite_items(v.sales, v.menu), with_views("sales menu", """
        SELECT customer_id, product_id, product_name, n AS purchase_count FROM (
          SELECT customer_id, product_id, count(*) AS n, max(count(*)) OVER (PARTITION BY customer_id) AS most
          FROM sales GROUP BY 1, 2) JOIN menu USING (product_id) WHERE n = most""")),
    "first_after_event": (lambda v: op.first_after_event(v.sales, v.menu, v.members), with_views("sales menu members", """
        SELECT DISTINCT customer_id, product_name FROM (
          SELECT s.*, min(order_date) OVER (PARTITION BY customer_id) AS first_day
          FROM sales s JOIN members USING (customer_id) WHERE order_date > join_date) JOIN menu USING (product_id)
        WHERE order_date = first_day""")),
    "last_before_event": (lambda v: op.last_before_event(v.sales, v.menu, v.members), with_views("sales menu members", """
        SELECT customer_id, order_date, product_id, product_name FROM (
          SELECT s.*, row_number() OVER (PARTITION BY customer_id ORDER BY order_date DESC, product_id) AS r
          FROM sales s JOIN members USING (customer_id) WHERE order_date < join_date) JOIN menu USING (product_id)
        WHERE r = 1""")),
    "spend_before_event": (lambda v: op.spend_before_event(v.sales, v.menu, v.members), with_views("sales menu members", """
        SELECT customer_id, count(*) AS product_count, CAST(sum(price) AS DOUBLE) AS total_spent
        FROM sales JOIN menu USING (product_id) JOIN members USING (customer_id) WHERE order_date < join_date GROUP BY 1""")),
    "points": (lambda v: op.points(v.sales, v.menu, DOUBLED), with_views("sales menu", f"""
        SELECT customer_id, CAST(sum(price * CASE WHEN {DOUBLED_SQL} THEN 20 ELSE 10 END) AS DOUBLE) AS points
        FROM sales JOIN menu USING (product_id) GROUP BY 1""")),
    "points_bonus_window": (
        lambda v: op.points_with_bonus(v.sales, v.menu, v.members, DOUBLED, *PERIOD), with_views("sales menu members", f"""
        SELECT customer_id, CAST(sum(price * CASE
            WHEN order_date >= join_date AND order_date < join_date + 7 OR {DOUBLED_SQL} THEN 20 ELSE 10 END) AS DOUBLE) AS points
        FROM sales JOIN menu USING (product_id) JOIN members USING (customer_id) WHERE year(order_date) = 1996 GROUP BY 1""")),
    "member_flag": (lambda v: op.member_flag(v.sales, v.menu, v.members), with_views("sales menu members", """
        SELECT customer_id, order_date, product_name, CAST(price AS DOUBLE) AS price,
          CASE WHEN join_date IS NULL OR order_date < join_date THEN 'N' ELSE 'Y' END AS member
        FROM sales JOIN menu USING (product_id) LEFT JOIN members USING (customer_id)""")),
    "member_rank": (lambda v: op.member_rank(v.sales, v.menu, v.members), with_views("sales menu members", """
        SELECT customer_id, order_date, product_name, CAST(price AS DOUBLE) AS price,
          CASE WHEN order_date >= join_date THEN 'Y' ELSE 'N' END AS member, CASE WHEN order_date >= join_date THEN
            dense_rank() OVER (PARTITION BY customer_id, product_name ORDER BY order_date) END AS ranking
        FROM sales JOIN menu USING (product_id) LEFT JOIN members USING (customer_id)""")),
}
