"""Cleaning, JSON, rows in and out, and the plain filters and counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import has_text, month_of, money_text, weekday_name
from ..operators import clean
from ..operators.grouped import not_in
from ..sources.readers import json_field, json_fields
from ..sources.sinks import append_batch, append_rows, new_folder, replace_table, stage
from ..sources.views import Views
from .sqlviews import ORDER_TIME, with_views


def filter_basic(v: Views):
    kept = v.t.orders.filter((F.col("o_orderstatus") != "F") & (F.col("o_orderpriority") == "1-URGENT"))
    return kept.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"), F.count("o_custkey").alias("customers"))


def count_by_priority(v: Views):
    return v.t.orders.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("orders"), F.countDistinct("o_custkey").alias("customers"),
        F.sum(F.col("o_totalprice").cast("decimal(12,2)")).alias("total"),
        F.min("o_orderdate").cast("date").alias("first_day"), F.max("o_orderdate").cast("date").alias("last_day"),
    )


def dedup_exact(v: Views):
    """Duplicates are real here: a user's events of one type on one day."""
    rows = v.t.events.select("user_id", F.col("ts").cast("date").alias("day"), "event_type")
    return clean.drop_exact_duplicates(rows)


def append_twice(v: Views):
    """Duplicates removed and then put back by appending the rows of one type again."""
    rows = v.t.events.select("user_id", F.col("ts").cast("date").alias("day"), "event_type")
    again = rows.filter("event_type = 'purchase'")
    return append_rows(clean.drop_exact_duplicates(rows), again).groupBy("event_type").agg(F.count(F.lit(1)).alias("records"))


def replaced_result(v: Views):
    """A result table replaced by a second result; the catalog points to the new files when they are complete (SNK2)."""
    folder = new_folder(v.spark, "replaced")
    counts = v.t.orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))
    replace_table(counts, "orders_by_status", folder)
    return replace_table(counts.where("o_orderstatus <> 'P'"), "orders_by_status", folder)


def appended_result(v: Views):
    """A result table written batch by batch, the last one twice (SNK3)."""
    path = new_folder(v.spark, "appended")
    counts = v.t.orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))
    append_batch(counts.where("o_orderstatus <> 'P'"), path, "settled")
    for _ in range(2):
        table = append_batch(counts.where("o_orderstatus = 'P'"), path, "pending")
    return table.drop("batch")


def clean_sentinel(v: Views):
    missing = lambda c: F.count_if(F.col(c).isNull())
    return v.orders.agg(
        F.count(F.lit(1)).alias("items"), missing("exclusions").alias("null_exclusions"), missing("extras").alias("null_extras"),
        F.count_if(F.col("exclusions") == "").alias("empty_exclusions"), F.count_if(F.col("extras") == "").alias("empty_extras"),
        F.count_if(has_text(F.col("exclusions"))).alias("with_exclusions"), F.count_if(has_text(F.col("extras"))).alias("with_extras"),
    )


def raw_unit_forms(v: Views):
    """How often each unit spelling occurs before cleaning (FLT6)."""
    text = F.col("duration")
    form = F.when(text.contains("minutes"), "minutes").when(text.contains("mins"), "mins").when(text.contains("minute"), "minute")
    return v.raw_runs.groupBy(
        form.otherwise("none").alias("duration_unit"), F.when(F.col("distance").like("%km%"), "km").otherwise("none").alias("distance_unit")
    ).agg(F.count(F.lit(1)).alias("runs"))


def reject_counts(v: Views):
    types = {"distance": "decimal(5,1)", "duration": "int", "pickup_time": "timestamp_ntz"}
    return clean.reject_counts(v.raw_runs, types)


def grain_check(v: Views):
    """Order and line number do not identify a line item: how many keys repeat, and how often."""
    repeated = clean.repeated_keys(v.t.lineitem, ["l_orderkey", "l_linenumber"])
    return repeated.groupBy("copies").agg(F.count(F.lit(1)).alias("keys"))


def split_fraction(v: Views):
    text = v.t.events.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_time"))
    return clean.split_fraction(text, "event_time")


def month_start(v: Views):
    return v.metrics.groupBy("month_year", "_year", "_month").agg(F.count(F.lit(1)).alias("records"))


def json_extract(v: Views):
    typed = json_fields(v.t.events.select("event_type", "props", json_field(F.col("props"), "k").alias("k_text")), "props", "k bigint")
    return typed.groupBy("k", "k_text").agg(F.count(F.lit(1)).alias("events"))


def orders_by_hour(v: Views):
    return v.orders.groupBy(F.hour("order_time").alias("hour_of_day")).agg(F.count("pizza_id").alias("items")).orderBy("hour_of_day")


def orders_by_weekday(v: Views):
    return v.orders.groupBy(weekday_name(F.col("order_time")).alias("weekday")).agg(
        F.count("pizza_id").alias("items")
    ).orderBy(F.desc("items"), "weekday")


def monthly_revenue_text(v: Views):
    total = F.sum(F.col("o_totalprice").cast("decimal(12,2)"))
    return v.t.orders.groupBy(month_of(F.col("o_orderdate")).alias("month")).agg(money_text(total).alias("revenue_text"))


def quiet_parts(v: Views):
    """Parts never named in an event's JSON text, with SQL's NOT IN (JN8)."""
    named = v.t.events.select(F.from_json("props", "k bigint").getField("k").alias("k"))
    return not_in(v.t.part, "p_partkey", named, "k").groupBy("p_type").agg(F.count(F.lit(1)).alias("parts"))


def materialised_funnel(v: Views):
    """The product funnel written once as a result table, then read twice (SNK1)."""
    from ..operators.funnel import PRODUCT, conversion_rates, funnel, funnel_leaders

    table = stage(funnel(v.clicks, v.pages, PRODUCT), "product-funnel")
    rates = conversion_rates(table)
    return funnel_leaders(table).select("metric", "value").unionByName(
        rates.select(F.explode(F.create_map(
            F.lit("view_to_cart"), F.col("view_to_cart"), F.lit("cart_to_purchase"), F.col("cart_to_purchase")
        )).alias("metric", "value")).withColumn("value", F.col("value").cast("decimal(18,2)"))
    )


QUERIES = {
    "filter_basic": (filter_basic, """
        SELECT o_orderstatus, count(*) AS orders, count(o_custkey) AS customers FROM orders
        WHERE o_orderstatus <> 'F' AND o_orderpriority = '1-URGENT' GROUP BY 1"""),
    "count_by_priority": (count_by_priority, """
        SELECT o_orderpriority, count(*) AS orders, count(DISTINCT o_custkey) AS customers,
          CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total,
          CAST(min(o_orderdate) AS DATE) AS first_day, CAST(max(o_orderdate) AS DATE) AS last_day
        FROM orders GROUP BY 1"""),
    "dedup_exact": (dedup_exact, "SELECT DISTINCT user_id, CAST(ts AS DATE) AS day, event_type FROM events"),
    "append_rows": (append_twice, """
        SELECT event_type, count(*) AS records FROM (
          SELECT DISTINCT user_id, CAST(ts AS DATE) AS day, event_type FROM events
          UNION ALL SELECT user_id, CAST(ts AS DATE), event_type FROM events WHERE event_type = 'purchase') GROUP BY 1"""),
    "replaced_result": (replaced_result, "SELECT o_orderstatus, count(*) AS orders FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1"),
    "appended_result": (appended_result, "SELECT o_orderstatus, count(*) AS orders FROM orders GROUP BY 1"),
    "clean_sentinel": (clean_sentinel, with_views("raw_items", """
        SELECT count(*) AS items, count(*) FILTER (exclusions IS NULL OR exclusions = 'null') AS null_exclusions,
          count(*) FILTER (extras IS NULL OR extras = 'null') AS null_extras,
          count(*) FILTER (exclusions = '') AS empty_exclusions, count(*) FILTER (extras = '') AS empty_extras,
          count(*) FILTER (exclusions NOT IN ('', 'null')) AS with_exclusions,
          count(*) FILTER (extras NOT IN ('', 'null')) AS with_extras FROM raw_items""")),
    "clean_units": (lambda v: v.runs, with_views("runs", "SELECT * FROM runs")),
    "raw_unit_forms": (raw_unit_forms, with_views("raw_runs", """
        SELECT coalesce(nullif(regexp_extract(duration, 'minutes|mins|minute'), ''), 'none') AS duration_unit,
          CASE WHEN distance LIKE '%km%' THEN 'km' ELSE 'none' END AS distance_unit, count(*) AS runs
        FROM raw_runs GROUP BY 1, 2""")),
    "reject_counts": (reject_counts, with_views("raw_runs", """
        SELECT count(*) FILTER (TRY_CAST(distance AS DECIMAL(5,1)) IS NULL) AS distance,
          count(*) FILTER (TRY_CAST(duration AS INTEGER) IS NULL) AS duration,
          count(*) FILTER (TRY_CAST(pickup_time AS TIMESTAMP) IS NULL) AS pickup_time FROM raw_runs""")),
    "grain_check": (grain_check, """
        SELECT copies, count(*) AS keys FROM (SELECT count(*) AS copies FROM lineitem GROUP BY l_orderkey, l_linenumber)
        WHERE copies > 1 GROUP BY 1"""),
    "split_fraction": (split_fraction, """
        SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS event_time,
          strftime(ts, '%Y-%m-%d %H:%M:%S') AS datetime_without_fraction, strftime(ts, '%f') AS fraction,
          date_trunc('second', ts) AS event_second FROM events"""),
    "month_start": (month_start, with_views("metrics", """
        SELECT month_year, CAST(year(month_year) AS BIGINT) AS _year, CAST(month(month_year) AS BIGINT) AS _month,
          count(*) AS records FROM metrics GROUP BY 1, 2, 3""")),
    "json_extract": (json_extract, """
        SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.k') AS k_text,
          count(*) AS events FROM events GROUP BY 1, 2"""),
    "orders_by_hour": (orders_by_hour, f"""
        SELECT hour({ORDER_TIME}) AS hour_of_day, count(*) AS items
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1 ORDER BY 1"""),
    "orders_by_weekday": (orders_by_weekday, """
        SELECT dayname(o_orderdate) AS weekday, count(*) AS items
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1 ORDER BY 2 DESC, 1"""),
    "monthly_revenue_text": (monthly_revenue_text, """
        SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
          '$' || CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS VARCHAR) AS revenue_text FROM orders GROUP BY 1"""),
    "quiet_parts": (quiet_parts, """
        SELECT p_type, count(*) AS parts FROM part
        WHERE p_partkey NOT IN (SELECT CAST(json_extract(props, '$.k') AS BIGINT) FROM events) GROUP BY 1"""),
    "materialised_funnel": (materialised_funnel, with_views("product_funnel", """
        SELECT 'views' AS metric, CAST(max(views) AS DOUBLE) AS value FROM product_funnel
        UNION ALL SELECT 'cart_adds', max(cart_adds) FROM product_funnel
        UNION ALL SELECT 'purchased', max(purchased) FROM product_funnel
        UNION ALL SELECT 'abandoned', max(abandoned) FROM product_funnel
        UNION ALL SELECT 'view_to_purchase', max(round(100.0 * purchased / nullif(views, 0), 2)) FROM product_funnel
        UNION ALL SELECT 'view_to_cart', round(avg(100.0 * cart_adds / nullif(views, 0)), 2) FROM product_funnel
        UNION ALL SELECT 'cart_to_purchase', round(avg(100.0 * purchased / nullif(cart_adds, 0)), 2) FROM product_funnel""")),
}
