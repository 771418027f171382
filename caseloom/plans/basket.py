"""Basket questions: orders as transactions, line items as basket lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import basket as op
from ..operators.impact import share_of_parent
from ..sources.views import Views
from .sqlviews import with_views

SUMS = """CAST(sum(quantity) AS BIGINT) AS quantity, CAST(sum(gross) AS DOUBLE) AS revenue, CAST(sum(rebate) AS DOUBLE) AS discount"""


def share_query(parent: list[str], child: list[str]):
    def build(v: Views):
        return share_of_parent(v.lines.withColumn("revenue", op.gross()), parent, child, "revenue")

    over = f"PARTITION BY {', '.join(parent)}" if parent else ""
    columns = ", ".join(parent + child)
    return build, with_views("lines", f"""
        SELECT {columns}, CAST(sum(gross) AS DOUBLE) AS revenue,
          round(100.0 * CAST(sum(gross) AS DOUBLE) / CAST(sum(sum(gross)) OVER ({over}) AS DOUBLE), 2) AS share
        FROM lines GROUP BY {columns}""")


def top_query(parent: str):
    return lambda v: op.top_per_parent(v.lines, parent), with_views("lines", f"""
        SELECT {parent}, product_id, CAST(q AS BIGINT) AS quantity FROM (
          SELECT {parent}, product_id, sum(quantity) AS q, rank() OVER (PARTITION BY {parent} ORDER BY sum(quantity) DESC) AS r
          FROM lines GROUP BY 1, 2) WHERE r = 1""")


def segment_totals(v: Views):
    return v.lines.groupBy("category", "segment").agg(*op.line_totals(), F.count(F.lit(1)).alias("lines"))


QUERIES = {
    "sales_totals": (lambda v: op.sales_totals(v.lines), with_views("lines", f"""
        SELECT {SUMS}, count(DISTINCT txn_id) AS transactions FROM lines""")),
    "avg_per_basket": (lambda v: op.average_basket(v.lines), with_views("baskets", """
        SELECT round(CAST(sum(products) AS DOUBLE) / count(*), 4) AS avg_products,
          round(CAST(sum(rebate) AS DOUBLE) / count(*), 4) AS avg_discount,
          round(CAST(sum(revenue) AS DOUBLE) / count(*), 4) AS avg_revenue FROM baskets""")),
    "member_baskets": (lambda v: op.member_baskets(v.member_lines), with_views("baskets", """
        SELECT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 't' ELSE 'f' END AS member, count(*) AS transactions,
          round(CAST(sum(revenue) AS DOUBLE) / count(*), 4) AS avg_revenue, round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS share
        FROM baskets JOIN orders ON o_orderkey = txn_id GROUP BY 1""")),
    "basket_percentiles": (lambda v: op.basket_percentiles(v.lines), with_views("baskets", """
        SELECT f AS fraction, round(v, 4) AS revenue FROM (SELECT quantile_cont(CAST(revenue AS DOUBLE), [0.25, 0.5, 0.75]) AS q FROM baskets),
          LATERAL (SELECT unnest([CAST(0.25 AS DOUBLE), 0.5, 0.75]) AS f, unnest(q) AS v)""")),
    "top_products": (lambda v: op.top_products(v.lines), with_views("lines", """
        SELECT product_id, CAST(sum(gross) AS DOUBLE) AS revenue FROM lines GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3""")),
    "segment_totals": (segment_totals, with_views("lines", f"SELECT category, segment, {SUMS}, count(*) AS lines FROM lines GROUP BY 1, 2")),
    "sales_rollup": (lambda v: op.sales_rollup(v.lines), with_views("lines", f"""
        SELECT category, segment, {SUMS}, grouping(category, segment) AS level FROM lines GROUP BY ROLLUP (category, segment)""")),
    "top_per_parent": top_query("segment"),
    "top_per_category": top_query("category"),
    "share_of_parent": share_query(["segment"], ["product_id"]),
    "segment_share": share_query(["category"], ["segment"]),
    "category_share": share_query([], ["category"]),
    "penetration": (lambda v: op.penetration(v.lines), with_views("lines", """
        SELECT product_id, count(DISTINCT txn_id) AS transactions,
          round(100.0 * count(DISTINCT txn_id) / (SELECT count(DISTINCT txn_id) FROM lines), 4) AS penetration
        FROM lines WHERE quantity >= 1 GROUP BY 1""")),
    "basket_triples": (lambda v: op.basket_triples(v.lines), with_views("lines", """
        , held AS (SELECT DISTINCT txn_id, product_id FROM lines WHERE quantity >= 1),
        triples AS (SELECT x.product_id AS product_1, y.product_id AS product_2, z.product_id AS product_3, count(*) AS transactions
          FROM held x JOIN held y ON y.txn_id = x.txn_id AND y.product_id > x.product_id
            JOIN held z ON z.txn_id = y.txn_id AND z.product_id > y.product_id GROUP BY 1, 2, 3)
        SELECT * FROM triples WHERE transactions = (SELECT max(transactions) FROM triples)""")),
}
