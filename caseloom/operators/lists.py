"""Delimited topping lists: counting tokens, ordered name lists, item labels and ingredient totals.

Work is done per distinct list text (or distinct item configuration) and joined back, so rows that repeat the same
list are exploded once, however many there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import split_list

# The list texts that are broadcast, the most common ones; each of the others stands in fewer rows than any of these.
FREQUENT = 10_000


def ordered_names(order_by: str, name: str = "topping_name", sep: str = ", ") -> Column:
    """Ordered string aggregation (AG16, AG17)."""
    return F.expr(f"listagg({name}, '{sep}') WITHIN GROUP (ORDER BY {order_by})")


def explode_list(df: DataFrame, column: str, into: str = "topping_id") -> DataFrame:
    """One row per integer token of a delimited list; rows without tokens give none (JN9, JN14)."""
    return df.withColumn(into, F.explode(split_list(F.col(column)))).withColumn(into, F.col(into).try_cast("int"))


def token_counts(orders: DataFrame, column: str, toppings: DataFrame) -> DataFrame:
    """How often each topping occurs in a list column (DO4)."""
    lists = orders.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    counts = explode_list(lists, column).groupBy("topping_id").agg(F.sum("n").alias("times"))
    return counts.join(toppings, "topping_id").select("topping_id", "topping_name", "times")


def recipe_list(recipes: DataFrame, names: DataFrame, toppings: DataFrame) -> DataFrame:
    """Standard ingredients of each product by topping id (AG17, JN11).

    Equal topping texts are resolved once and joined back to the products that carry them.
    """
    texts = explode_list(recipes.select("toppings").distinct(), "toppings").join(toppings, "topping_id")
    resolved = texts.groupBy("toppings").agg(ordered_names("topping_id").alias("ingredients"))
    return recipes.join(resolved, "toppings").join(names, "pizza_id").select("pizza_id", "pizza_name", "ingredients")


def names_by_list(orders: DataFrame, column: str, toppings: DataFrame, into: str) -> DataFrame:
    """Every distinct list text with its topping names by id."""
    tokens = explode_list(orders.select(column).distinct(), column)
    return tokens.join(toppings, "topping_id").groupBy(column).agg(ordered_names("topping_id").alias(into))


def with_list_names(rows: DataFrame, orders: DataFrame, column: str, toppings: DataFrame, into: str, frequent: int = FREQUENT) -> DataFrame:
    """``rows`` with the topping names of their list text, NULL for rows without one; ``orders`` holds all list texts.

    A few texts (or none at all) may stand in most rows. The ``frequent`` most common texts are broadcast; the others are
    joined by text, and rows that have nothing left to look up are dealt by all their values, so no text gathers rows in one task.
    """
    texts = orders.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    named = texts.join(names_by_list(orders, column, toppings, into), column, "left")
    common = named.orderBy(F.desc("_n"), column).limit(frequent).drop("_n")
    rare = named.join(F.broadcast(common.select(column)), column, "left_anti")
    found = rows.join(F.broadcast(common.withColumn("_common", F.lit(True))), column, "left")
    text = F.when(F.col("_common").isNull(), F.col(column))
    asked = found.withColumn("_text", text).withColumn("_dealt", F.when(text.isNull(), F.xxhash64(*rows.columns)).otherwise(0))
    answers = rare.select(F.col(column).alias("_text"), F.lit(0).cast("bigint").alias("_dealt"), F.col(into).alias("_late"))
    late = asked.join(answers, ["_text", "_dealt"], "left")
    return late.select(*rows.columns, F.coalesce(into, "_late").alias(into))


def order_label(orders: DataFrame, names: DataFrame, toppings: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """``Name - Exclude a, b - Extra c, d`` for every ordered item (DO5)."""
    rows = orders.select("order_id", "customer_id", "pizza_id", "exclusions", "extras").join(names, "pizza_id")
    rows = with_list_names(rows, orders, "exclusions", toppings, "without", frequent)
    labelled = with_list_names(rows, orders, "extras", toppings, "added", frequent)
    return labelled.select(
        "order_id", "customer_id", "pizza_id",
        F.concat_ws(
            " - ", "pizza_name", F.concat(F.lit("Exclude "), F.col("without")), F.concat(F.lit("Extra "), F.col("added"))
        ).alias("label"),
    )


CONFIGURATION = ["toppings", "exclusions", "extras"]


def _with_recipes(orders: DataFrame, recipes: DataFrame) -> DataFrame:
    """Items with the topping text of their product and blank text for missing lists."""
    blank = {c: F.coalesce(F.col(c), F.lit("")) for c in ("exclusions", "extras")}
    return orders.withColumns(blank).join(recipes, "pizza_id")


def _used(configurations: DataFrame) -> DataFrame:
    """Configurations exploded to the toppings they use: recipe without the exclusions, plus the extras.

    Products with equal recipes share their configurations, so these are far fewer than the items.
    """
    used = F.concat(
        F.array_except(split_list(F.col("toppings")), split_list(F.col("exclusions"))), split_list(F.col("extras"))
    )
    tokens = configurations.withColumn("_t", F.explode(used))
    return tokens.withColumn("topping_id", F.col("_t").try_cast("int")).drop("_t")


def ingredient_list(orders: DataFrame, names: DataFrame, recipes: DataFrame, toppings: DataFrame) -> DataFrame:
    """``Name: 2xBacon, Beef, ...`` for every ordered item, names in alphabetical order without regard to case (DO6)."""
    rows = _with_recipes(orders, recipes)
    used = _used(rows.select(*CONFIGURATION).distinct())
    counts = used.groupBy(*CONFIGURATION, "topping_id").agg(F.count(F.lit(1)).alias("n")).join(toppings, "topping_id")
    times = F.when(F.col("n") > 1, F.concat(F.col("n").cast("string"), F.lit("x"))).otherwise("")
    lists = (
        counts.withColumn("_item", F.concat(times, F.col("topping_name")))
        .groupBy(*CONFIGURATION)
        .agg(ordered_names("lower(topping_name)", "_item").alias("_items"))
    )
    return rows.join(names, "pizza_id").join(lists, CONFIGURATION, "left").select(
        "order_id", "customer_id", "pizza_id",
        F.concat(F.col("pizza_name"), F.lit(": "), F.coalesce("_items", F.lit(""))).alias("ingredients"),
    )


def ingredient_usage(orders: DataFrame, runs: DataFrame, recipes: DataFrame, toppings: DataFrame) -> DataFrame:
    """How often each ingredient went into a delivered item (DO7)."""
    delivered = runs.filter(F.col("distance").isNotNull()).select("order_id")
    configurations = _with_recipes(orders, recipes).join(delivered, "order_id").groupBy(*CONFIGURATION).agg(
        F.count(F.lit(1)).alias("n")
    )
    used = _used(configurations).groupBy("topping_id").agg(F.sum("n").alias("times_used"))
    return used.join(toppings, "topping_id").select("topping_id", "topping_name", "times_used")


def with_everything(names: DataFrame, recipes: DataFrame, toppings: DataFrame, name: str) -> DataFrame:
    """The recipe table after adding one product that uses every topping (SNK3).

    Returns product id, name and topping list; the new id follows the largest one.
    """
    # The topping table is a vocabulary: its whole list is the value being built.
    every = toppings.agg(ordered_names("topping_id", "topping_id").alias("toppings"))
    new = every.select(
        (names.agg(F.max("pizza_id")).scalar() + 1).alias("pizza_id"), F.lit(name).alias("pizza_name"), "toppings"
    )
    current = names.join(recipes, "pizza_id").select("pizza_id", "pizza_name", "toppings")
    return current.unionByName(new)
