"""Basket reports over lines(txn_id, product_id, segment, category, quantity, price, discount rate, member)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import mean, percent
from ..sources.sinks import stage
from .grouped import order_statistics

# Rows or pairs that a task holds at once when transactions are collected and pairs are counted.
TASK_ROWS = 1 << 19


def gross() -> Column:
    """Line revenue before discount."""
    return F.col("quantity") * F.col("price")


def discounted() -> Column:
    """Line discount amount."""
    return gross() * F.col("discount")


def line_totals() -> list[Column]:
    return [
        F.sum("quantity").alias("quantity"), F.sum(gross()).alias("revenue"), F.sum(discounted()).alias("discount"),
    ]


def sales_totals(lines: DataFrame) -> DataFrame:
    """Quantity, revenue before discount, discount and transactions overall (AG30, AG2)."""
    per_txn = lines.groupBy("txn_id").agg(*line_totals())
    return per_txn.agg(*[F.sum(c).alias(c) for c in ("quantity", "revenue", "discount")], F.count("txn_id").alias("transactions"))


def per_transaction(lines: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per transaction: distinct products, revenue and discount."""
    # One row per transaction and product first: the distinct count becomes a plain count.
    per_item = lines.groupBy("txn_id", *by, "product_id").agg(F.sum(gross()).alias("r"), F.sum(discounted()).alias("d"))
    return per_item.groupBy("txn_id", *by).agg(
        F.count("product_id").alias("products"), F.sum("r").alias("revenue"), F.sum("d").alias("discount")
    )


def average_basket(lines: DataFrame) -> DataFrame:
    """Average distinct products, discount and revenue per transaction (AG31)."""
    return per_transaction(lines).agg(
        F.round(mean(F.col("products")), 4).alias("avg_products"), F.round(mean(F.col("discount")), 4).alias("avg_discount"),
        F.round(mean(F.col("revenue")), 4).alias("avg_revenue"),
    )


def member_baskets(lines: DataFrame) -> DataFrame:
    """Transactions of members and others: count, share and average revenue (AG25, AG31)."""
    per_txn = lines.groupBy("txn_id", "member").agg(F.sum(gross()).alias("revenue"))
    split = per_txn.groupBy("member").agg(
        F.count("txn_id").alias("transactions"), F.round(mean(F.col("revenue")), 4).alias("avg_revenue")
    )
    whole = split.agg(F.sum("transactions")).scalar()
    return split.withColumn("share", percent(F.col("transactions"), whole))


def basket_percentiles(lines: DataFrame, fractions: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Interpolated percentiles of revenue per transaction (AG24), exact at any size."""
    cents = lines.groupBy("txn_id").agg((F.sum(gross()) * 100).cast("long").alias("cents")).select("cents")
    found = order_statistics(cents, "cents", fractions)
    return found.select("fraction", F.round(F.col("value") / 100, 4).alias("revenue"))


def top_products(lines: DataFrame, n: int = 3) -> DataFrame:
    """Products with the highest revenue before discount; equal revenues go by product id (LM1)."""
    return lines.groupBy("product_id").agg(F.sum(gross()).alias("revenue")).orderBy(F.desc("revenue"), "product_id").limit(n)


def sales_rollup(lines: DataFrame) -> DataFrame:
    """Quantity, revenue and discount per segment, per category and overall in one pass (AG30)."""
    per_segment = lines.groupBy("category", "segment").agg(*line_totals())
    return per_segment.rollup("category", "segment").agg(
        *[F.sum(c).alias(c) for c in ("quantity", "revenue", "discount")],
        F.grouping_id().cast("int").alias("level"),
    )


def top_per_parent(lines: DataFrame, parent: str, measure: str = "quantity") -> DataFrame:
    """Best-selling product of each segment or category, ties kept (WN18).

    Ranks one row per product; map tasks drop all but their own best rows before the shuffle.
    """
    value = F.sum("quantity") if measure == "quantity" else F.sum(gross())
    per_product = lines.groupBy(parent, "product_id").agg(value.alias(measure))
    rank = F.rank().over(Window.partitionBy(parent).orderBy(F.desc(measure)))
    return per_product.withColumn("_r", rank).filter("_r = 1").drop("_r")


def penetration(lines: DataFrame) -> DataFrame:
    """Share of all transactions that hold a product (AG26)."""
    bought = lines.filter(F.col("quantity") >= 1)
    per_product = bought.select("product_id", "txn_id").distinct().groupBy("product_id").agg(F.count("txn_id").alias("transactions"))
    whole = lines.agg(F.countDistinct("txn_id")).scalar()
    return per_product.withColumn("penetration", percent(F.col("transactions"), whole, 4))


def _dealt(df: DataFrame, rows: int | None, *keys: str) -> DataFrame:
    """Rows dealt by their keys to as many tasks as ``rows``, the number that each task's memory depends on, needs.

    Left to itself Spark sizes tasks by shuffled bytes, which do not show what compressed arrays become when they are opened.
    """
    return df.repartition(*keys) if rows is None else df.repartition(max(1, -(-rows // TASK_ROWS)), *keys)


def _baskets(items: DataFrame, support: DataFrame, rows: int | None = None) -> DataFrame:
    """One row per transaction of three products or more: its products, those in fewer transactions first.

    ``rows`` is the number of items; they are dealt by transaction at once, as collecting them by product first shrinks nothing.
    """
    sets = _dealt(items.join(support, "_i"), rows, "_t").groupBy("_t").agg(F.array_sort(F.collect_list(F.struct("_s", "_i"))).alias("_items"))
    return sets.filter(F.size("_items") >= 3)


def conditional_baskets(baskets: DataFrame, block: int = 1 << 16) -> DataFrame:
    """The conditional database of every product: for each of its transactions the products after it, if two or more.

    A transaction of n products gives n - 2 rows. A product in more than ``block`` transactions is dealt to several salts.
    """
    each = baskets.select("_t", "_items", F.posexplode("_items").alias("_p", "_x")).filter(F.col("_p") + 2 < F.size("_items"))
    salts = F.floor(F.col("_x._s") / block) + 1
    return each.select(
        F.col("_x._i").alias("a"), salts.alias("_salts"), F.pmod(F.xxhash64("_t"), salts).alias("_salt"),
        F.transform(F.slice("_items", F.col("_p") + 2, F.size("_items")), lambda x: x["_i"]).alias("_rest"),
    )


def _strong_pairs(conditional: DataFrame, least: int, pairs: int | None = None) -> DataFrame:
    """Pairs in ``least`` transactions or more, counted product by product so that arrays are shuffled, not pairs.

    ``pairs`` is the number of pairs in all transactions.
    """
    dealt = _dealt(conditional, pairs, "a", "_salt").select("a", "_salt", "_salts", F.explode("_rest").alias("b"))
    counted = dealt.groupBy("a", "_salt", "_salts", "b").agg(F.count(F.lit(1)).alias("_n"))
    # The count of a product with one salt is final, so its weak pairs end here.
    kept = counted.filter((F.col("_n") >= least) | (F.col("_salts") > 1))
    return kept.groupBy("a", "b").agg(F.sum("_n").alias("_n")).filter(F.col("_n") >= least).select("a", "b")


def _triples(conditional: DataFrame, strong: DataFrame | None = None) -> DataFrame:
    """The triples of each conditional database, which is first narrowed to the strong partners of its product."""
    rest = F.col("_rest")
    if strong is not None:
        conditional = conditional.join(strong.groupBy("a").agg(F.collect_list("b").alias("_with")), "a")
        rest = F.array_intersect("_rest", "_with")
    fans = conditional.select("a", F.array_sort(rest).alias("_rest")).filter(F.size("_rest") >= 2)
    second = fans.select("a", "_rest", F.posexplode("_rest").alias("_p", "b"))
    return second.select("a", "b", F.explode(F.slice("_rest", F.col("_p") + 2, F.size("_rest"))).alias("c"))


def _counted(triples: DataFrame) -> DataFrame:
    return triples.groupBy("a", "b", "c").agg(F.count(F.lit(1)).alias("n"))


def basket_triples(lines: DataFrame, seed_items: int = 40) -> DataFrame:
    """The most frequent combinations of three products in one transaction, all ties (JN16).

    Exact, by prefix projection, for baskets of any size. Counting only the ``seed_items`` most frequent products gives a triple
    count that is really reached; rarer products cannot be part of a better triple. Each remaining product has a conditional
    database: its transactions, cut to the more frequent products. Partners are counted in it, those in too few transactions
    leave it, and what is left is combined to triples. Only if no triple occurs twice are all triples of all baskets made, as
    then they are the result. Works when called.
    """
    bought = lines.filter(F.col("quantity") >= 1).select(F.col("txn_id").alias("_t"), F.col("product_id").alias("_i"))
    items = stage(bought.distinct(), "basket-items")
    rows = items.count()
    support = items.groupBy("_i").agg(F.count(F.lit(1)).alias("_s"))
    seed = F.broadcast(support.orderBy(F.desc("_s"), "_i").limit(seed_items))
    seeded = _counted(_triples(conditional_baskets(_baskets(items, seed, rows))))
    least = max(seeded.agg(F.max("n")).first()[0] or 0, 2)
    baskets = stage(_baskets(items, support.filter(F.col("_s") >= least), rows), "baskets")
    pairs = baskets.agg(F.sum(F.expr("size(_items) * (size(_items) - 1L) div 2"))).first()[0] or 0
    conditional = conditional_baskets(baskets)
    strong = stage(_strong_pairs(conditional, least, pairs), "basket-strong")
    totals = stage(_counted(_triples(conditional, strong)).filter(F.col("n") >= least), "basket-counts")
    most = totals.agg(F.max("n")).first()[0]
    if most is None:
        # Each occurs once, so there is nothing to count.
        best = _triples(conditional_baskets(_baskets(items, support, rows))).withColumn("n", F.lit(1).cast("bigint"))
    else:
        best = totals.filter(F.col("n") == most)
    triple = F.array_sort(F.array("a", "b", "c"))
    return best.select(
        *(triple[i].alias(f"product_{i + 1}") for i in range(3)), F.col("n").alias("transactions")
    )
