"""Click log questions on a small log."""

import pytest
from pyspark.sql import functions as F

from caseloom.operators import funnel as op

from .conftest import rows
from .tables import t

# visit, user, cookie, page, event type, sequence, time
LOG = [
    ("v1", 1, "c1", 1, 1, 1, t("2020-01-31 23:50:00")), ("v1", 1, "c1", 3, 1, 2, t("2020-01-31 23:51:00")),
    ("v1", 1, "c1", 3, 2, 3, t("2020-01-31 23:52:00")), ("v1", 1, "c1", 4, 2, 4, t("2020-02-01 00:01:00")),
    ("v1", 1, "c1", 2, 1, 5, t("2020-02-01 00:02:00")), ("v1", 1, "c1", 9, 3, 6, t("2020-02-01 00:03:00")),
    ("v2", 1, "c2", 3, 1, 1, t("2020-02-05 10:00:00")), ("v2", 1, "c2", 3, 2, 2, t("2020-02-05 10:01:00")),
    ("v2", 1, "c2", 2, 1, 3, t("2020-02-05 10:02:00")), ("v2", 1, "c2", 3, 4, 4, t("2020-02-05 10:03:00")),
    ("v3", 2, "c3", 4, 1, 1, t("2020-02-06 09:00:00")), ("v3", 2, "c3", 3, 4, 2, t("2020-02-06 09:01:00")),
    ("v3", 2, "c3", 3, 5, 3, t("2020-02-06 09:02:00")),
]
PAGES = [(1, "Home", None, None), (2, "Checkout", None, None), (3, "Salmon", "Fish", 1), (4, "Crab", "Shellfish", 2), (5, "Lobster", "Shellfish", 3)]


@pytest.fixture(scope="module")
def site(spark):
    class Site:
        events = spark.createDataFrame(LOG, "visit_id string, user_id int, cookie_id string, page_id int, event_type int, sequence_number int, event_time timestamp_ntz")
        pages = spark.createDataFrame(PAGES, "page_id int, page_name string, product_category string, product_id int")
        users = spark.createDataFrame([(1, "c1"), (1, "c2"), (2, "c3")], "user_id int, cookie_id string")
        types = op.event_types(spark)
        campaigns = spark.createDataFrame([
            ("winter", t("2020-01-01 00:00:00"), t("2020-01-31 23:59:59")), ("spring", t("2020-02-01 00:00:00"), t("2020-02-05 23:00:00")),
            ("overlap", t("2020-02-03 00:00:00"), t("2020-02-28 00:00:00")),
        ], "campaign_name string, start_date timestamp_ntz, end_date timestamp_ntz")

    return Site


def test_users_visits_and_types(site):
    assert rows(op.users_and_cookies(site.users)) == [(2, 1.5)]
    # Visit v1 crosses midnight at the end of the month.
    assert [r.visits for r in op.visits_by_month(site.events, site.users).orderBy("month").collect()] == [1, 3]
    assert rows(op.events_by_type(site.events, site.types), "event_name", "events") == [
        ("Ad Click", 1), ("Ad Impression", 2), ("Add to Cart", 3), ("Page View", 6), ("Purchase", 1)
    ]
    assert rows(op.events_named(site.events, site.types, "ADD TO cart")) == [(3, 2)]


def test_rates(site):
    assert rows(op.purchase_rate(site.events)) == rows(op.purchase_rate_subquery(site.events)) == [(33.33,)]
    assert rows(op.checkout_without_purchase(site.events, site.pages)) == [(2, 50.0)]
    assert [tuple(r) for r in op.top_pages(site.events, site.pages).collect()] == [(2, "Checkout", 2), (3, "Salmon", 2), (1, "Home", 1)]
    assert rows(op.category_views(site.events, site.pages)) == [("Fish", 2, 2), ("Shellfish", 1, 1)]


def test_funnels(site):
    products = op.funnel(site.events, site.pages, op.PRODUCT)
    assert rows(products) == [(1, "Salmon", "Fish", 2, 2, 1, 1), (2, "Crab", "Shellfish", 1, 1, 0, 1)]
    assert rows(op.funnel(site.events, site.pages, op.CATEGORY)) == [("Fish", 2, 2, 1, 1), ("Shellfish", 1, 1, 0, 1)]
    assert rows(products.filter("purchased + abandoned != cart_adds")) == []
    assert rows(op.abandoned_products(site.events, site.pages)) == [(1, "Salmon", "Fish", 1)]
    assert rows(op.purchased_products(site.events, site.pages)) == [(1, "Salmon", "Fish", 1), (2, "Crab", "Shellfish", 1)]
    assert [r.product_id for r in op.top_products_converted(site.events, site.pages).collect()] == [1, 2]
    assert rows(op.conversion_rates(products)) == [(100.0, 75.0)]
    leaders = {r.metric: (r.product_id, float(r.value)) for r in op.funnel_leaders(products).collect()}
    assert leaders == {"views": (1, 2.0), "cart_adds": (1, 2.0), "purchased": (1, 1.0), "abandoned": (1, 1.0), "view_to_purchase": (2, 100.0)}


def test_visit_summary_has_one_row_per_visit(site):
    visits = {r.visit_id: r for r in op.visit_summary(site.events, site.pages, site.campaigns).collect()}
    assert sorted(visits) == ["v1", "v2", "v3"]
    # The start decides the campaign, although v1 goes on after its end; of two campaigns the earlier one is kept.
    assert [visits[v].campaign_name for v in ("v1", "v2", "v3")] == ["winter", "spring", "overlap"]
    assert (visits["v1"].page_views, visits["v1"].cart_adds, visits["v1"].purchase, visits["v1"].cart_products) == (3, 2, 1, "Salmon, Crab")
    assert (visits["v3"].impression, visits["v3"].click, visits["v3"].cart_products) == (1, 1, None)
    assert rows(op.cart_products(site.events, site.pages)) == [("v1", "Salmon, Crab"), ("v2", "Salmon")]


def test_uplift_compares_within_the_campaign(spark):
    visits = spark.createDataFrame([
        ("a", 0, 0, 1, 2, 1), ("a", 0, 0, 0, 4, 1), ("a", 1, 1, 1, 2, 2), ("a", 1, 0, 0, 2, 2), (None, 0, 0, 0, 1, 0), (None, 2, 1, 1, 1, 0),
    ], "campaign_name string, impression int, click int, purchase int, page_views int, cart_adds int")
    out = rows(op.campaign_uplift(visits).select("campaign_name", "cohort", "visits", "purchase_percent", "uplift"))
    assert set(out) == {
        ("a", "no impression", 2, 50.0, 0.0), ("a", "clicked", 1, 100.0, 50.0), ("a", "impression only", 1, 0.0, -50.0),
        (None, "no impression", 1, 0.0, 0.0), (None, "clicked", 1, 100.0, 100.0),
    }


def test_events_on_unknown_pages_count_in_the_summary(site):
    visits = op.visit_summary(site.events.withColumn("page_id", F.lit(77)), site.pages, site.campaigns)
    assert visits.agg(F.sum("page_views")).first()[0] == 6
