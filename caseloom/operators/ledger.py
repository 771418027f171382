"""Account ledgers: txns(customer_id, txn_date, txn_type, txn_amount, ...) to balances, growth and provision.

A balance depends on the date only, so rows shrink to one per customer and date (or month) before any window runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import int_avg, mean, month_of, rounded_ratio, safe_ratio
from .grouped import join_back, rows_frame, steps

KEY = ["customer_id"]
DEPOSIT = "deposit"


def signed() -> Column:
    """Deposits count up, everything else counts down (PRJ3)."""
    return F.when(F.col("txn_type") == DEPOSIT, F.col("txn_amount")).otherwise(-F.col("txn_amount"))


def signed_amount(txns: DataFrame) -> DataFrame:
    return txns.withColumn("signed_amount", signed())


def totals_by_type(txns: DataFrame) -> DataFrame:
    """Count and amount per transaction type (AG1, AG3)."""
    return txns.groupBy("txn_type").agg(F.count(F.lit(1)).alias("txns"), F.sum("txn_amount").alias("total_amount"))


def deposit_averages(txns: DataFrame) -> DataFrame:
    """Average over customers of their deposit count and mean deposit, truncated and exact, and the overall mean (AG11)."""
    per_customer = txns.filter(F.col("txn_type") == DEPOSIT).groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("n"), F.sum("txn_amount").alias("s")
    )
    own_mean_int = F.call_function("div", F.col("s"), F.col("n"))
    own_mean = rounded_ratio(F.col("s"), F.col("n"), 6)
    return per_customer.agg(
        int_avg(F.col("n")).alias("avg_count_int"),
        mean(F.col("n")).alias("avg_count"),
        int_avg(own_mean_int).alias("avg_of_averages_int"),
        rounded_ratio(F.sum(own_mean), F.count(F.lit(1)), 4).alias("avg_of_averages"),
        safe_ratio(F.sum("s"), F.sum("n")).alias("overall_average"),
    )


def active_customers(txns: DataFrame, exactly_one: bool = True) -> DataFrame:
    """Customers per month with more than one deposit and one other transaction (AG7, AG11).

    ``exactly_one=False`` accepts one or more others.
    """
    per_month = txns.groupBy(*KEY, month_of(F.col("txn_date")).alias("month")).agg(
        F.count_if(F.col("txn_type") == DEPOSIT).alias("deposits"), F.count_if(F.col("txn_type") != DEPOSIT).alias("others")
    )
    others = F.col("others") == 1 if exactly_one else F.col("others") >= 1
    kept = per_month.filter((F.col("deposits") > 1) & others)
    return kept.groupBy("month").agg(F.count(F.lit(1)).alias("customers"))


def running_balance(txns: DataFrame) -> DataFrame:
    """Every transaction with the balance at the end of its day; rows of one day share it (WN5)."""
    daily = steps(txns, KEY, "txn_date", signed()).select(*KEY, "txn_date", F.col("running").alias("running_balance"))
    return join_back(signed_amount(txns), daily, [*KEY, "txn_date"])


def running_balance_per_row(txns: DataFrame, order_by: Sequence[str] = ("txn_date", "txn_id"),
                            slice_by: Column | None = None) -> DataFrame:
    """Every transaction with the balance right after it; ``order_by`` must be unique per customer.

    Only the rows of one customer and slice are windowed together. ``slice_by`` must not decrease along the order; it
    is the date by default, an hour or minute for very busy customers.
    """
    sliced = signed_amount(txns).withColumn("_slice", F.col("txn_date") if slice_by is None else slice_by)
    per_slice = steps(sliced, KEY, "_slice", F.col("signed_amount"))
    earlier = per_slice.select(*KEY, "_slice", (F.col("running") - F.col("net")).alias("_earlier"))
    inside = Window.partitionBy(*KEY, "_slice").orderBy(*order_by).rowsBetween(Window.unboundedPreceding, 0)
    rows = sliced.withColumn("_so_far", F.sum("signed_amount").over(inside))
    return join_back(rows, earlier, [*KEY, "_slice"]).withColumn(
        "running_balance", F.col("_earlier") + F.col("_so_far")
    ).drop("_earlier", "_so_far", "_slice")


def closing_balance(txns: DataFrame, densify: bool = False) -> DataFrame:
    """Net amount and closing balance per customer and month (DO9).

    Months without transactions have no row; ``densify=True`` adds them, from the customer's first month to the last
    month of the data, with a net amount of zero.
    """
    monthly = txns.select(*KEY, month_of(F.col("txn_date")).alias("month"), signed().alias("_amount"))
    if densify:
        last = monthly.agg(F.max("month")).scalar()
        months = F.expr("interval 1 month")
        filler = monthly.groupBy(*KEY).agg(F.min("month").alias("_first")).select(
            *KEY, F.explode(F.sequence(F.col("_first"), last, months)).alias("month"),
            F.lit(0).cast(monthly.schema["_amount"].dataType).alias("_amount"),
        )
        monthly = monthly.unionByName(filler)
    return steps(monthly, KEY, "month", F.col("_amount")).select(
        *KEY, "month", F.col("net").alias("net_amount"), F.col("running").alias("closing_balance")
    )


def balance_growth(txns: DataFrame, threshold: float = 0.05) -> DataFrame:
    """Customer-months with the next month's balance and a flag for growth above ``threshold`` (WN9, WN10).

    Zero balances are dropped before the next month is looked up. The last month of a customer compares with itself.
    """
    by_month = Window.partitionBy(*KEY).orderBy("month")
    balances = closing_balance(txns).filter(F.col("closing_balance") != 0)
    nxt = F.lead("closing_balance").over(by_month)
    compared = balances.withColumn("_next", nxt).withColumns({
        "next_balance": F.coalesce("_next", "closing_balance"),
        "growth": F.round(F.col("_next").cast("double") / F.col("closing_balance").cast("double") - 1, 2),
    })
    grew = (F.col("next_balance") > F.col("closing_balance")) & (F.col("growth") > threshold)
    return compared.withColumn("grew", F.when(grew, 1).otherwise(0)).drop("_next")


def growth_share(txns: DataFrame, threshold: float = 0.05) -> DataFrame:
    """Share of customer-months whose balance grows by more than ``threshold`` (DO10, AG13)."""
    return balance_growth(txns, threshold).agg(
        F.sum("grew").alias("grown"), F.count("grew").alias("customer_months"),
        safe_ratio(F.sum("grew"), F.count("grew")).alias("growth_share"),
    )


def balance_stats(txns: DataFrame) -> DataFrame:
    """Lowest, average and highest running balance per customer, each transaction counting once (DO11)."""
    daily = steps(txns, KEY, "txn_date", signed())
    return daily.groupBy(*KEY).agg(
        F.min("running").alias("min_balance"),
        F.call_function("div", F.sum(F.col("running") * F.col("n")), F.sum("n")).alias("avg_balance_int"),
        (F.sum(F.col("running") * F.col("n")).cast("double") / F.sum("n")).alias("avg_balance"),
        F.max("running").alias("max_balance"),
    )


def balance_stats_rows(txns: DataFrame) -> DataFrame:
    """Every transaction with its running balance and the customer's lowest, average and highest (WN11)."""
    whole = Window.partitionBy(*KEY).orderBy("txn_date").rangeBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    daily = steps(txns, KEY, "txn_date", signed()).select(
        *KEY, "txn_date", F.col("running").alias("running_balance"),
        F.min("running").over(whole).alias("min_balance"),
        (F.sum(F.col("running") * F.col("n")).over(whole).cast("double") / F.sum("n").over(whole)).alias("avg_balance"),
        F.max("running").over(whole).alias("max_balance"),
    )
    return join_back(txns, daily, [*KEY, "txn_date"])


def monthly_provision(txns: DataFrame, densify: bool = False) -> DataFrame:
    """Sum of all customers' closing balances per month (DO12)."""
    return closing_balance(txns, densify).groupBy("month").agg(F.sum("closing_balance").alias("provision"))


def moving_average_rows(txns: DataFrame, rows: int = 30, order_by: Sequence[str] = ("txn_date", "txn_id"),
                        slice_by: Column | None = None, chunk_rows: int = 100_000) -> DataFrame:
    """Average signed amount over the last ``rows`` transactions of the customer, this one included (WN12),
    exact and truncated."""
    return rows_frame(
        signed_amount(txns), KEY, order_by, F.col("txn_date") if slice_by is None else slice_by, rows - 1,
        {"_s": F.sum("signed_amount"), "_n": F.count("signed_amount")}, chunk_rows,
    ).withColumns({
        "moving_avg": F.col("_s").cast("double") / F.col("_n"),
        "moving_avg_int": F.call_function("div", F.col("_s"), F.col("_n")),
    }).drop("_s", "_n")


def moving_average_days(txns: DataFrame, days: int = 30) -> DataFrame:
    """Average signed amount over the last ``days`` calendar days of the customer, today included (WN13)."""
    daily = steps(txns, KEY, "txn_date", signed())
    # Days as a number, so the frame is a plain range over the one-row-per-day frame.
    day = F.datediff(F.col("txn_date"), F.lit("1970-01-01").cast("date"))
    frame = Window.partitionBy(*KEY).orderBy(day).rangeBetween(-(days - 1), 0)
    averages = daily.select(
        *KEY, "txn_date", (F.sum("net").over(frame).cast("double") / F.sum("n").over(frame)).alias("moving_avg")
    )
    return join_back(signed_amount(txns), averages, [*KEY, "txn_date"])


