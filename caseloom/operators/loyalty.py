"""Restaurant-style loyalty questions over sales(customer_id, order_date, product_id), menu and members."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .grouped import join_back


def total_spend(sales: DataFrame, menu: DataFrame) -> DataFrame:
    """Amount spent per customer (JN1, AG3)."""
    return sales.join(menu, "product_id").groupBy("customer_id").agg(F.sum("price").alias("total_spent"))


def visit_days(sales: DataFrame) -> DataFrame:
    """Days with at least one sale per customer (AG2)."""
    return sales.groupBy("customer_id").agg(F.countDistinct("order_date").alias("visit_days"))


def most_purchased(sales: DataFrame, menu: DataFrame, n: int = 1) -> DataFrame:
    """The ``n`` products sold most often; equal counts go by name (LM1)."""
    sold = sales.groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))
    named = sold.join(menu, "product_id").groupBy("product_name").agg(F.sum("n").alias("purchase_count"))
    return named.orderBy(F.desc("purchase_count"), "product_name").limit(n)


def _edge_items(sales: DataFrame, menu: DataFrame, latest: bool, ties: bool) -> DataFrame:
    """Products bought on each customer's first (last) day.

    A product is on the customer's first day exactly when its own first day is, so the rows shrink to one per customer
    and product before anything is ranked; the rank-one filter then prunes each map task's rows before the shuffle.
    """
    edge = (F.max if latest else F.min)("order_date").alias("order_date")
    per_product = sales.groupBy("customer_id", "product_id").agg(edge)
    day = F.desc("order_date") if latest else F.asc("order_date")
    w = Window.partitionBy("customer_id")
    rank = F.dense_rank().over(w.orderBy(day)) if ties else F.row_number().over(w.orderBy(day, "product_id"))
    return per_product.withColumn("_r", rank).filter("_r = 1").drop("_r").join(menu, "product_id")


def first_items(sales: DataFrame, menu: DataFrame) -> DataFrame:
    """Every product bought on the customer's first day (WN2, AG12)."""
    return _edge_items(sales, menu, latest=False, ties=True).select("customer_id", "product_name").distinct()


def favourite_items(sales: DataFrame, menu: DataFrame) -> DataFrame:
    """Each customer's most often bought products, ties kept (WN3)."""
    counts = sales.groupBy("customer_id", "product_id").agg(F.count(F.lit(1)).alias("purchase_count"))
    rank = F.dense_rank().over(Window.partitionBy("customer_id").orderBy(F.desc("purchase_count")))
    return (
        counts.withColumn("_r", rank).filter("_r = 1").join(menu, "product_id")
        .select("customer_id", "product_id", "product_name", "purchase_count")
    )


def sales_relative_to(sales: DataFrame, events: DataFrame, event_date: str, when: Column) -> DataFrame:
    """Sales of customers that have an event, on the rows where ``when`` holds against its date (JN5, FLT2)."""
    return sales.join(events.select("customer_id", event_date), "customer_id").filter(when)


def first_after_event(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    """Products of the first day strictly after joining (DO3)."""
    after = sales_relative_to(sales, members, "join_date", F.col("order_date") > F.col("join_date"))
    return first_items(after, menu)


def last_before_event(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    """One product of the last day before joining; the lowest product id decides a tie (DO3, WN1)."""
    before = sales_relative_to(sales, members, "join_date", F.col("order_date") < F.col("join_date"))
    return _edge_items(before, menu, latest=True, ties=False).select(
        "customer_id", "order_date", "product_id", "product_name"
    )


def spend_before_event(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    """Items and amount per member before joining (JN5, AG3)."""
    before = sales_relative_to(sales, members, "join_date", F.col("order_date") < F.col("join_date"))
    return before.join(menu, "product_id").groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("product_count"), F.sum("price").alias("total_spent")
    )


def points(sales: DataFrame, menu: DataFrame, doubled: Sequence[str], per_unit: int = 10) -> DataFrame:
    """Loyalty points per customer: ``per_unit`` per currency unit, twice that for the ``doubled`` products (DO1)."""
    factor = F.when(F.col("product_name").isin(*doubled), 2 * per_unit).otherwise(per_unit)
    return sales.join(menu, "product_id").groupBy("customer_id").agg(F.sum(F.col("price") * factor).alias("points"))


def points_with_bonus(sales: DataFrame, menu: DataFrame, members: DataFrame, doubled: Sequence[str],
                      start: str, end: str, bonus_days: int = 7, per_unit: int = 10) -> DataFrame:
    """Member points in ``[start, end)``, all doubled in the first ``bonus_days`` from the join date (DO2).

    The period is a plain range on the date, so it can reach the scan as a pushed filter (FLT12).
    """
    in_period = sales.filter((F.col("order_date") >= F.lit(start).cast("date"))
                             & (F.col("order_date") < F.lit(end).cast("date")))
    bonus = F.col("order_date").between(F.col("join_date"), F.date_add("join_date", bonus_days - 1))
    factor = F.when(bonus | F.col("product_name").isin(*doubled), 2 * per_unit).otherwise(per_unit)
    return (
        in_period.join(menu, "product_id").join(members, "customer_id")
        .groupBy("customer_id").agg(F.sum(F.col("price") * factor).alias("points"))
    )


def member_flag(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    """Every sale with Y when the customer was a member that day, else N (PRJ5, JN3)."""
    return sales.join(menu, "product_id").join(members, "customer_id", "left").select(
        "customer_id", "order_date", "product_name", "price",
        F.when(F.col("order_date") >= F.col("join_date"), "Y").otherwise("N").alias("member"),
    )


def member_rank(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    """``member_flag`` plus the day's rank within customer and product, NULL for non-member rows (WN14).

    Rows before joining still use up ranks. The rank depends on the day alone, so only distinct days are ranked.
    """
    keys = ["customer_id", "product_name"]
    days = sales.join(menu, "product_id").select(*keys, "order_date").distinct()
    ranked = days.withColumn("_r", F.dense_rank().over(Window.partitionBy(*keys).orderBy("order_date")))
    rows = join_back(member_flag(sales, menu, members), ranked, [*keys, "order_date"])
    return rows.withColumn("ranking", F.when(F.col("member") == "Y", F.col("_r"))).drop("_r")
