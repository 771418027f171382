"""Clickstream questions over events(visit_id, page_id, event_type, sequence_number, event_time, ...) and site pages.

Events are counted per visit and page before they are joined, so a visit with very many events stays small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import ci_equals, mean, month_of, percent
from .grouped import not_in
from .intervals import first_interval

# The event type codes and names of the click log.
EVENT_NAMES = {1: "Page View", 2: "Add to Cart", 3: "Purchase", 4: "Ad Impression", 5: "Ad Click"}
VIEW, CART, PURCHASE, IMPRESSION, CLICK = EVENT_NAMES
CHECKOUT = "Checkout"


def is_type(code: int) -> Column:
    return F.col("event_type") == code


def event_types(spark) -> DataFrame:
    """The event type lookup as a table."""
    return spark.createDataFrame(list(EVENT_NAMES.items()), "event_type int, event_name string")


def users_and_cookies(users: DataFrame) -> DataFrame:
    """Number of users and cookies per user (AG2, AG5, AG11)."""
    per_user = users.groupBy("user_id").agg(F.count("cookie_id").alias("n"))
    return per_user.agg(F.count(F.lit(1)).alias("users"), mean(F.col("n")).alias("avg_cookies"))


def visits_by_month(events: DataFrame, users: DataFrame) -> DataFrame:
    """Distinct visits of known cookies per month (AG2, AG10)."""
    seen = events.select("cookie_id", "visit_id", month_of(F.col("event_time")).alias("month")).distinct()
    known = seen.join(users.select("cookie_id").distinct(), "cookie_id", "left_semi")
    return known.groupBy("month").agg(F.countDistinct("visit_id").alias("visits"))


def events_by_type(events: DataFrame, types: DataFrame) -> DataFrame:
    """Events per type with the type's name (JN1, AG1)."""
    counts = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))
    return counts.join(types, "event_type").select("event_type", "event_name", "events")


def events_named(events: DataFrame, types: DataFrame, name: str) -> DataFrame:
    """Events and visits of the type with this name, whatever its case (FLT11)."""
    codes = types.filter(ci_equals(F.col("event_name"), name)).select("event_type")
    return events.join(codes, "event_type", "left_semi").agg(
        F.count(F.lit(1)).alias("events"), F.countDistinct("visit_id").alias("visits")
    )


def visits_with_purchase(events: DataFrame) -> DataFrame:
    return events.filter(is_type(PURCHASE)).select("visit_id").distinct()


def purchase_rate(events: DataFrame) -> DataFrame:
    """Percentage of visits with a purchase, from one flag per visit (AG9, AG13)."""
    flags = events.groupBy("visit_id").agg(F.max(is_type(PURCHASE)).alias("bought"))
    return flags.agg(percent(F.count_if("bought"), F.count("visit_id")).alias("purchase_percent"))


def purchase_rate_subquery(events: DataFrame) -> DataFrame:
    """The same percentage with the number of all visits as a scalar subquery (JN10)."""
    visits = events.select("visit_id").distinct().agg(F.count("visit_id")).scalar()
    return visits_with_purchase(events).agg(percent(F.count("visit_id"), visits).alias("purchase_percent"))


def checkout_without_purchase(events: DataFrame, pages: DataFrame) -> DataFrame:
    """Percentage of visits viewing the checkout that buy nothing; visits are counted once on both sides (DO17)."""
    checkout = pages.filter(F.col("page_name") == CHECKOUT).select("page_id", F.lit(True).alias("_checkout"))
    flags = events.join(checkout, "page_id", "left").groupBy("visit_id").agg(
        F.max(is_type(VIEW) & F.coalesce("_checkout", F.lit(False))).alias("seen"), F.max(is_type(PURCHASE)).alias("bought")
    )
    return flags.agg(
        F.count_if("seen").alias("checkout_visits"),
        percent(F.count_if(F.col("seen") & ~F.col("bought")), F.count_if("seen")).alias("no_purchase_percent"),
    )


def top_pages(events: DataFrame, pages: DataFrame, n: int = 3) -> DataFrame:
    """Pages with the most views; equal counts go by page id (LM1)."""
    views = events.filter(is_type(VIEW)).groupBy("page_id").agg(F.count(F.lit(1)).alias("views"))
    return views.join(pages, "page_id").select("page_id", "page_name", "views").orderBy(F.desc("views"), "page_id").limit(n)


def visit_pages(events: DataFrame) -> DataFrame:
    """Views and cart adds per visit and page."""
    wanted = events.filter(is_type(VIEW) | is_type(CART))
    return wanted.groupBy("visit_id", "page_id").agg(
        F.count_if(is_type(VIEW)).alias("views"), F.count_if(is_type(CART)).alias("cart_adds")
    )


def funnel(events: DataFrame, pages: DataFrame, by: Sequence[str]) -> DataFrame:
    """Views, cart adds, abandoned and purchased cart adds per product or any coarser page columns (DO14, DO15).

    A cart add counts as purchased when its visit holds a purchase. One pass gives all four numbers, and a product
    without abandoned or purchased cart adds keeps a zero.
    """
    bought = visits_with_purchase(events).withColumn("_bought", F.lit(True))
    flagged = visit_pages(events).join(bought, "visit_id", "left")
    purchased = F.when(F.col("_bought"), F.col("cart_adds")).otherwise(0)
    per_page = flagged.groupBy("page_id").agg(
        F.sum("views").alias("views"), F.sum("cart_adds").alias("cart_adds"), F.sum(purchased).alias("purchased")
    )
    products = pages.filter(F.col("product_id").isNotNull())
    return per_page.join(products, "page_id").groupBy(*by).agg(
        F.sum("views").alias("views"), F.sum("cart_adds").alias("cart_adds"),
        (F.sum("cart_adds") - F.sum("purchased")).alias("abandoned"), F.sum("purchased").alias("purchased"),
    )


PRODUCT = ["product_id", "page_name", "product_category"]
CATEGORY = ["product_category"]


def category_views(events: DataFrame, pages: DataFrame) -> DataFrame:
    """Views and cart adds per product category (AG7)."""
    per_page = events.groupBy("page_id").agg(
        F.sum(F.when(is_type(VIEW), 1).otherwise(0)).alias("v"), F.sum(F.when(is_type(CART), 1).otherwise(0)).alias("c")
    )
    known = pages.filter(F.col("product_category").isNotNull())
    return per_page.join(known, "page_id").groupBy("product_category").agg(
        F.sum("v").alias("views"), F.sum("c").alias("cart_adds")
    )


def cart_adds_by_product(cart_events: DataFrame, pages: DataFrame, into: str) -> DataFrame:
    per_page = cart_events.groupBy("page_id").agg(F.count(F.lit(1)).alias("n"))
    products = pages.filter(F.col("product_id").isNotNull())
    return per_page.join(products, "page_id").groupBy(*PRODUCT).agg(F.sum("n").alias(into))


def purchased_products(events: DataFrame, pages: DataFrame) -> DataFrame:
    """Cart adds per product in visits that bought something, by semi join (JN7)."""
    carts = events.filter(is_type(CART)).join(visits_with_purchase(events), "visit_id", "left_semi")
    return cart_adds_by_product(carts, pages, "purchased")


def top_products_converted(events: DataFrame, pages: DataFrame, n: int = 3) -> DataFrame:
    """Products purchased most often; equal counts go by product id (JN7, LM1)."""
    return purchased_products(events, pages).orderBy(F.desc("purchased"), "product_id").limit(n)


def abandoned_products(events: DataFrame, pages: DataFrame) -> DataFrame:
    """Cart adds per product in visits that bought nothing, by NULL-aware anti join (JN8)."""
    carts = not_in(events.filter(is_type(CART)), "visit_id", visits_with_purchase(events), "visit_id")
    return cart_adds_by_product(carts, pages, "abandoned")


def funnel_leaders(products: DataFrame) -> DataFrame:
    """The product leading in each funnel metric and in view-to-purchase percentage (LM1).

    Works on a product funnel table; equal values go to the lowest product id. One aggregation finds all leaders.
    """
    rate = percent(F.col("purchased"), F.col("views")).cast("decimal(18,2)")
    metrics = {
        "views": F.col("views"), "cart_adds": F.col("cart_adds"), "purchased": F.col("purchased"),
        "abandoned": F.col("abandoned"), "view_to_purchase": rate,
    }
    value = {m: F.max(F.when(v.isNotNull(), F.struct(v.cast("decimal(18,2)").alias("value"), (-F.col("product_id")).alias("id"))))
             for m, v in metrics.items()}
    best = products.agg(*[v.alias(m) for m, v in value.items()])
    rows = F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), (-F.col(m)["id"]).alias("product_id"), F.col(m)["value"].alias("value"))
        for m in metrics
    ]))
    return best.select(rows.alias("r")).select("r.metric", "r.product_id", "r.value")


def conversion_rates(products: DataFrame) -> DataFrame:
    """Mean over products of view-to-cart and cart-to-purchase percentages (DO16)."""
    def avg_percent(part: str, whole: str) -> Column:
        rate = F.lit(100.0) * F.col(part) / F.nullif(F.col(whole), F.lit(0))
        # Ten decimals before the sum, so the order of the rows cannot change the result.
        return F.round(mean(rate.cast("decimal(28,10)")), 2)

    return products.agg(
        avg_percent("cart_adds", "views").alias("view_to_cart"), avg_percent("purchased", "cart_adds").alias("cart_to_purchase")
    )


def cart_products(events: DataFrame, pages: DataFrame, visit: Sequence[str] = ("visit_id",)) -> DataFrame:
    """Names of the pages added to the cart per visit, in sequence order (AG16)."""
    named = events.filter(is_type(CART)).join(pages.select("page_id", "page_name"), "page_id")
    names = F.expr("listagg(page_name, ', ') WITHIN GROUP (ORDER BY sequence_number)")
    return named.groupBy(*visit).agg(names.alias("cart_products"))


def visit_summary(events: DataFrame, pages: DataFrame, campaigns: DataFrame) -> DataFrame:
    """One row per visit with its counts, purchase flag, campaign and cart products (DO18).

    The campaign is the earliest one running at the visit's start. Events on unknown pages still count.
    """
    # The counts are hash aggregated over all events; only cart adds meet the pages and are gathered as text.
    visits = events.groupBy("user_id", "visit_id").agg(
        F.min("event_time").alias("visit_start_time"),
        F.count_if(is_type(VIEW)).alias("page_views"),
        F.count_if(is_type(CART)).alias("cart_adds"),
        F.max(F.when(is_type(PURCHASE), 1).otherwise(0)).alias("purchase"),
        F.count_if(is_type(IMPRESSION)).alias("impression"),
        F.count_if(is_type(CLICK)).alias("click"),
    )
    placed = first_interval(visits, campaigns, "visit_start_time", "start_date", "end_date", "campaign_name",
                            seen=events.select("event_time"))
    return placed.join(cart_products(events, pages, ["user_id", "visit_id"]), ["user_id", "visit_id"], "left")


def campaign_uplift(visits: DataFrame) -> DataFrame:
    """Purchase rate per campaign of visits without an impression, with one, and with a click (DO19).

    ``uplift`` compares with the same campaign's visits that had no impression.
    """
    reached = F.when(F.col("click") > 0, "clicked").when(F.col("impression") > 0, "impression only")
    per_cohort = visits.groupBy("campaign_name", reached.otherwise("no impression").alias("cohort")).agg(
        F.count(F.lit(1)).alias("visits"), F.sum("purchase").alias("purchases"),
        mean(F.col("page_views")).alias("avg_page_views"), mean(F.col("cart_adds")).alias("avg_cart_adds"),
    ).withColumn("purchase_percent", percent(F.col("purchases"), F.col("visits")))
    base = per_cohort.filter("cohort = 'no impression'").select(
        F.col("campaign_name").alias("_campaign"), F.col("purchase_percent").alias("_base")
    )
    joined = per_cohort.join(base, F.col("campaign_name").eqNullSafe(F.col("_campaign")), "left")
    return joined.withColumn("uplift", F.round(F.col("purchase_percent") - F.col("_base"), 2)).drop("_campaign", "_base")
