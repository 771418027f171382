"""Click log questions: events as clicks on parts."""

from __future__ import annotations

from ..operators import funnel as op
from ..sources.views import Views
from .sqlviews import with_views


def product_table(v: Views):
    return op.funnel(v.clicks, v.pages, op.PRODUCT)


def summary(v: Views):
    return op.visit_summary(v.clicks, v.pages, v.campaigns)


SPLIT = "CASE WHEN click > 0 THEN 'clicked' WHEN impression > 0 THEN 'impression only' ELSE 'no impression' END"

QUERIES = {
    "avg_cookies": (lambda v: op.users_and_cookies(v.users), """
        SELECT count(*) AS users, CAST(sum(n) AS DOUBLE) / count(*) AS avg_cookies
        FROM (SELECT user_id, count(DISTINCT hour(ts)) AS n FROM events GROUP BY 1)"""),
    "visits_by_month": (lambda v: op.visits_by_month(v.clicks, v.users), with_views("clicks", """
        SELECT CAST(date_trunc('month', event_time) AS DATE) AS month, count(DISTINCT visit_id) AS visits FROM clicks GROUP BY 1""")),
    "events_by_type": (lambda v: op.events_by_type(v.clicks, v.event_types), with_views("clicks kinds", """
        SELECT kind AS event_type, event_name, count(*) AS events FROM clicks JOIN kinds USING (kind) GROUP BY 1, 2""".replace(
        "kind AS event_type", "CAST(kind AS BIGINT) AS event_type"))),
    "ci_filter": (lambda v: op.events_named(v.clicks, v.event_types, "add to CART"), with_views("clicks", """
        SELECT count(*) AS events, count(DISTINCT visit_id) AS visits FROM clicks WHERE kind = 2""")),
    "purchase_rate": (lambda v: op.purchase_rate(v.clicks), with_views("clicks", """
        SELECT round(100.0 * count(DISTINCT CASE WHEN kind = 3 THEN visit_id END) / count(DISTINCT visit_id), 2) AS purchase_percent
        FROM clicks""")),
    "purchase_rate_subquery": (lambda v: op.purchase_rate_subquery(v.clicks), with_views("clicks", """
        SELECT round(100.0 * count(DISTINCT visit_id) / (SELECT count(DISTINCT visit_id) FROM clicks), 2) AS purchase_percent
        FROM clicks WHERE kind = 3""")),
    "checkout_no_purchase": (lambda v: op.checkout_without_purchase(v.clicks, v.pages), with_views("clicks buyers site_pages", """
        SELECT count(*) AS checkout_visits,
          round(100.0 * count(*) FILTER (visit_id NOT IN (SELECT visit_id FROM buyers)) / count(*), 2) AS no_purchase_percent
        FROM (SELECT DISTINCT visit_id FROM clicks JOIN site_pages USING (page_id) WHERE kind = 1 AND page_name = 'Checkout')""")),
    "top_pages": (lambda v: op.top_pages(v.clicks, v.pages), with_views("clicks site_pages", """
        SELECT page_id, page_name, count(*) AS views FROM clicks JOIN site_pages USING (page_id) WHERE kind = 1
        GROUP BY 1, 2 ORDER BY views DESC, page_id LIMIT 3""")),
    "category_views": (lambda v: op.category_views(v.clicks, v.pages), with_views("clicks site_pages", """
        SELECT product_category, count(*) FILTER (kind = 1) AS views, count(*) FILTER (kind = 2) AS cart_adds
        FROM clicks JOIN site_pages USING (page_id) WHERE product_category IS NOT NULL GROUP BY 1""")),
    "purchased_products": (lambda v: op.purchased_products(v.clicks, v.pages), with_views("product_funnel", """
        SELECT product_id, page_name, product_category, purchased FROM product_funnel WHERE purchased > 0""")),
    "top_products_converted": (lambda v: op.top_products_converted(v.clicks, v.pages), with_views("product_funnel", """
        SELECT product_id, page_name, product_category, purchased FROM product_funnel ORDER BY purchased DESC, product_id LIMIT 3""")),
    "abandoned_products": (lambda v: op.abandoned_products(v.clicks, v.pages), with_views("product_funnel", """
        SELECT product_id, page_name, product_category, abandoned FROM product_funnel WHERE abandoned > 0""")),
    "funnel_product": (product_table, with_views("product_funnel", "SELECT * FROM product_funnel")),
    "funnel_category": (lambda v: op.funnel(v.clicks, v.pages, op.CATEGORY), with_views("product_funnel", """
        SELECT product_category, CAST(sum(views) AS BIGINT) AS views, CAST(sum(cart_adds) AS BIGINT) AS cart_adds,
          CAST(sum(abandoned) AS BIGINT) AS abandoned, CAST(sum(purchased) AS BIGINT) AS purchased FROM product_funnel GROUP BY 1""")),
    "funnel_leaders": (lambda v: op.funnel_leaders(product_table(v)), with_views("product_funnel", """
        , long AS (UNPIVOT (SELECT product_id, CAST(views AS DECIMAL(18,2)) AS views, CAST(cart_adds AS DECIMAL(18,2)) AS cart_adds,
            CAST(abandoned AS DECIMAL(18,2)) AS abandoned, CAST(purchased AS DECIMAL(18,2)) AS purchased,
            CAST(round(100.0 * purchased / nullif(views, 0), 2) AS DECIMAL(18,2)) AS view_to_purchase FROM product_funnel)
          ON views, cart_adds, abandoned, purchased, view_to_purchase INTO NAME metric VALUE value)
        SELECT metric, product_id, CAST(value AS DOUBLE) AS value FROM (
          SELECT *, row_number() OVER (PARTITION BY metric ORDER BY value DESC, product_id) AS r FROM long) WHERE r = 1""")),
    "conversion_rates": (lambda v: op.conversion_rates(product_table(v)), with_views("product_funnel", """
        SELECT round(avg(100.0 * cart_adds / nullif(views, 0)), 2) AS view_to_cart,
          round(avg(100.0 * purchased / nullif(cart_adds, 0)), 2) AS cart_to_purchase FROM product_funnel""")),
    "cart_products": (lambda v: op.cart_products(v.clicks, v.pages), with_views("visits", """
        SELECT visit_id, cart_products FROM visits WHERE cart_products IS NOT NULL""")),
    "visit_summary": (summary, with_views("visit_campaigns", "SELECT * FROM visit_campaigns")),
    "campaign_uplift": (lambda v: op.campaign_uplift(summary(v)), with_views("visit_campaigns", f"""
        , cohorts AS (SELECT campaign_name, {SPLIT} AS cohort, count(*) AS visits, CAST(sum(purchase) AS BIGINT) AS purchases,
            CAST(sum(page_views) AS DOUBLE) / count(*) AS avg_page_views, CAST(sum(cart_adds) AS DOUBLE) / count(*) AS avg_cart_adds,
            round(100.0 * sum(purchase) / count(*), 2) AS purchase_percent FROM visit_campaigns GROUP BY 1, 2)
        SELECT c.*, round(c.purchase_percent - b.purchase_percent, 2) AS uplift
        FROM cohorts c LEFT JOIN cohorts b ON b.cohort = 'no impression' AND b.campaign_name IS NOT DISTINCT FROM c.campaign_name""")),
}
