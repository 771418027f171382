"""Delivery questions over item orders (one row per item) and runs (one row per order), both already cleaned.

Orders are counted to one row per order before they meet the runs: every metric needs only the number of items.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import has_text, int_avg, mean, minute_boundaries, money_text, percent, split_list, sunday_week

# The two cancellation texts of the delivery runs.
CANCELLED = ("Restaurant Cancellation", "Customer Cancellation")


def delivered_runs(runs: DataFrame) -> DataFrame:
    """Runs that reached the customer: a distance was recorded."""
    return runs.filter(F.col("distance").isNotNull())


def order_sizes(orders: DataFrame) -> DataFrame:
    """One row per order with its number of items."""
    return orders.groupBy("order_id", "customer_id", "order_time").agg(F.count(F.lit(1)).alias("items"))


def delivered_orders(orders: DataFrame, runs: DataFrame) -> DataFrame:
    """Order sizes joined to the delivered runs, with the pickup wait in clock minutes (SF11)."""
    joined = order_sizes(orders).join(delivered_runs(runs), "order_id")
    return joined.withColumn("pickup_minutes", minute_boundaries(F.col("order_time"), F.col("pickup_time")))


def speed() -> Column:
    """Kilometres per hour, two decimals; NULL for a zero duration (SF17, SF18)."""
    hours = F.nullif(F.col("duration"), F.lit(0)).cast("double") / 60
    return F.round(F.col("distance").cast("double") / hours, 2)


def order_counts(orders: DataFrame) -> DataFrame:
    """Items ordered and distinct orders (AG1, AG2)."""
    return orders.agg(F.count(F.lit(1)).alias("items"), F.countDistinct("order_id").alias("orders"))


def success_count(runs: DataFrame, cancelled: Sequence[str] = CANCELLED) -> DataFrame:
    """Orders per runner that were not cancelled (AG7, FLT4)."""
    bad = F.sum(F.when(F.col("cancellation").isin(*cancelled), 1).otherwise(0))
    return runs.groupBy("runner_id").agg((F.count("order_id") - bad).alias("successful_orders"))


def delivered_by_type(orders: DataFrame, runs: DataFrame, names: DataFrame) -> DataFrame:
    """Delivered items per product (JN2, AG1)."""
    # Items are not counted by order and product first: nearly all differ, so the counts would only fill each task's memory.
    kept = orders.select("order_id", "pizza_id").join(delivered_runs(runs).select("order_id"), "order_id")
    totals = kept.groupBy("pizza_id").agg(F.count(F.lit(1)).alias("delivered"))
    return totals.join(names, "pizza_id").select("pizza_id", "pizza_name", "delivered")


def ordered_by_customer_and_type(orders: DataFrame, names: DataFrame) -> DataFrame:
    """Items per customer and product name (AG1)."""
    counts = orders.groupBy("customer_id", "pizza_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(names, "pizza_id").groupBy("customer_id", "pizza_name").agg(F.sum("n").alias("ordered"))


def largest_orders(orders: DataFrame, runs: DataFrame) -> DataFrame:
    """Delivered orders with the most items, ties kept (WN4): a maximum replaces the global rank."""
    sizes = order_sizes(orders).join(delivered_runs(runs).select("order_id"), "order_id")
    most = sizes.agg(F.max("items")).scalar()
    return sizes.filter(F.col("items") == most).select("order_id", "customer_id", "items")


def change_counts(orders: DataFrame, runs: DataFrame) -> DataFrame:
    """Delivered items per customer with at least one change, with none, and with both kinds (AG7, AG8, FLT8)."""
    changed = has_text(F.col("exclusions")) | has_text(F.col("extras"))
    neither = ~F.coalesce(has_text(F.col("exclusions")), F.lit(False)) & ~F.coalesce(has_text(F.col("extras")), F.lit(False))
    both = has_text(F.col("exclusions")) & has_text(F.col("extras"))
    per_order = orders.groupBy("order_id", "customer_id").agg(
        F.sum(F.when(changed, 1).otherwise(0)).alias("c"), F.count(F.when(neither, 1)).alias("n"), F.count_if(both).alias("b")
    )
    return per_order.join(delivered_runs(runs).select("order_id"), "order_id").groupBy("customer_id").agg(
        F.sum("c").alias("at_least_one_change"), F.sum("n").alias("no_change"), F.sum("b").alias("both_changes")
    )


def both_changes(orders: DataFrame, runs: DataFrame) -> DataFrame:
    """Delivered items with exclusions and extras (FLT8)."""
    return change_counts(orders, runs).agg(F.coalesce(F.sum("both_changes"), F.lit(0)).alias("both_changes"))


def signups_by_week(runners: DataFrame, shift_days: int = 3) -> DataFrame:
    """Sign-ups per Sunday-based week of the date moved by ``shift_days`` (SF13, SF9)."""
    week = sunday_week(F.date_add("registration_date", shift_days)).alias("week_of_year")
    return runners.groupBy(week).agg(F.count(F.lit(1)).alias("runner_count"))


def pickup_minutes(orders: DataFrame, runs: DataFrame) -> DataFrame:
    """Average wait per runner over items, truncated and exact (AG4, SF11)."""
    weighted = F.sum(F.col("pickup_minutes") * F.col("items"))
    return delivered_orders(orders, runs).groupBy("runner_id").agg(
        F.call_function("div", weighted, F.sum("items")).alias("avg_minutes_int"),
        (weighted.cast("double") / F.sum("items")).alias("avg_minutes"),
    )


def minutes_by_order_size(orders: DataFrame, runs: DataFrame) -> DataFrame:
    """Average wait by number of items in the order (AG11)."""
    return delivered_orders(orders, runs).groupBy("items").agg(
        int_avg(F.col("pickup_minutes")).alias("avg_minutes_int"), mean(F.col("pickup_minutes")).alias("avg_minutes")
    )


def average_distance(orders: DataFrame, runs: DataFrame) -> DataFrame:
    """Average distance per customer over items, one decimal (AG5); divided and rounded in decimals, so halves go up."""
    weighted = F.sum(F.col("distance") * F.col("items")) / F.sum("items")
    return delivered_orders(orders, runs).groupBy("customer_id").agg(F.round(weighted, 1).alias("avg_distance"))


def duration_spread(runs: DataFrame) -> DataFrame:
    """Longest minus shortest delivery (AG6)."""
    return runs.agg((F.max("duration") - F.min("duration")).alias("spread"))


def run_speeds(runs: DataFrame) -> DataFrame:
    """Speed of every delivered run (AG12, SF17)."""
    done = delivered_runs(runs).filter(F.col("duration").isNotNull())
    return done.select("runner_id", "order_id", speed().alias("speed")).distinct()


def success_percent(runs: DataFrame) -> DataFrame:
    """Share of runs per runner that were delivered (AG13)."""
    return runs.groupBy("runner_id").agg(
        percent(F.count("distance"), F.count("order_id")).alias("success_percent")
    )


def revenue(orders: DataFrame, runs: DataFrame, prices: DataFrame, per_extra: int = 0) -> DataFrame:
    """Revenue of delivered items; ``per_extra`` is added for each extra of the item itself (PRJ4, JN15, AG21).

    Items whose product has no price earn nothing. The extras are counted on the item's own row, so no join on the
    order can multiply them.
    """
    earned = F.col("price") + F.size(split_list(F.col("extras"))) * per_extra
    per_order = orders.join(prices, "pizza_id").groupBy("order_id").agg(F.sum(earned).alias("earned"))
    total = F.sum("earned")
    return per_order.join(delivered_runs(runs).select("order_id"), "order_id").agg(
        total.alias("revenue"), money_text(total).alias("revenue_text")
    )


def delivery_fact(orders: DataFrame, runs: DataFrame, ratings: DataFrame) -> DataFrame:
    """One row per delivered order with rating, wait, speed and size (DO8, AG23)."""
    return delivered_orders(orders, runs).join(ratings.select("order_id", "rating"), "order_id", "left").select(
        "customer_id", "order_id", "runner_id", "rating", "order_time", "pickup_time", "pickup_minutes", "duration",
        speed().alias("avg_speed"), F.col("items").alias("total_items"),
    )


def net_after_cost(orders: DataFrame, runs: DataFrame, prices: DataFrame, per_km: str = "0.30",
                   cost_per: str = "order") -> DataFrame:
    """Revenue minus distance pay; the distance is paid once per delivered ``order`` or once per delivered ``item`` (AG22).

    Items whose product has no price earn nothing, but their way is paid.
    """
    per_order = orders.join(prices, "pizza_id", "left").groupBy("order_id").agg(
        F.sum(F.coalesce("price", F.lit(0))).alias("earned"), F.count(F.lit(1)).alias("items")
    )
    times = {"order": F.lit(1), "item": F.col("items")}[cost_per]
    pay = F.col("distance") * F.lit(per_km).cast("decimal(6,2)") * times
    return per_order.join(delivered_runs(runs), "order_id").agg(
        F.sum("earned").alias("revenue"), F.sum(pay).alias("cost"), (F.sum("earned") - F.sum(pay)).alias("net")
    )
