"""Subscription changes subs(customer_id, plan_id, start_date) and plans(plan_id, plan_name, price).

The end of a plan is the customer's next change. A customer's rows are reduced to one per start date first, so the
ordered windows below see at most one row per customer and day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec, functions as F

from ..functions import mean, month_of, percent

# The plan table.
PLANS = [
    (0, "trial", "0.00"),
    (1, "basic monthly", "9.90"),
    (2, "pro monthly", "19.90"),
    (3, "pro annual", "199.00"),
    (4, "churn", None),
]
TRIAL, BASIC, PRO_MONTHLY, PRO_ANNUAL, CHURN = (p[0] for p in PLANS)


def by_start() -> WindowSpec:
    return Window.partitionBy("customer_id").orderBy("start_date", "plan_id")


def plan_table(spark) -> DataFrame:
    """The plan lookup as a table (five rows)."""
    rows = spark.createDataFrame(PLANS, "plan_id int, plan_name string, price string")
    return rows.withColumn("price", F.col("price").cast("decimal(5,2)"))


def state_changes(subs: DataFrame) -> DataFrame:
    """Every change once; those of one day follow each other by plan id."""
    return subs.select("customer_id", "start_date", "plan_id").distinct()


def customer_count(subs: DataFrame) -> DataFrame:
    """Distinct customers (AG2)."""
    return subs.agg(F.countDistinct("customer_id").alias("customers"))


def starts_by_month(subs: DataFrame, plan: int = TRIAL) -> DataFrame:
    """Starts of one plan per month (AG33)."""
    chosen = subs.filter(F.col("plan_id") == plan)
    return chosen.groupBy(month_of(F.col("start_date")).alias("month")).agg(F.count(F.lit(1)).alias("starts"))


def starts_after(subs: DataFrame, plans: DataFrame, after: str) -> DataFrame:
    """Starts later than a date per plan (AG33)."""
    late = subs.filter(F.col("start_date") > F.lit(after).cast("date"))
    counts = late.groupBy("plan_id").agg(F.count(F.lit(1)).alias("starts"))
    return counts.join(plans, "plan_id").select("plan_id", "plan_name", "starts")


def churn_rate(subs: DataFrame, plan: int = CHURN) -> DataFrame:
    """Customers that ever churned and their percentage, one decimal (AG29)."""
    flags = subs.groupBy("customer_id").agg(F.max(F.col("plan_id") == plan).alias("left"))
    return flags.agg(
        F.count_if("left").alias("churned"), percent(F.count_if("left"), F.count("customer_id"), 1).alias("churn_percent")
    )


def transitions(subs: DataFrame) -> DataFrame:
    """Each change with the plan that follows it (WN15); the last change of a customer has none."""
    changes = state_changes(subs)
    return changes.withColumns({
        "next_plan_id": F.lead("plan_id").over(by_start()), "next_start_date": F.lead("start_date").over(by_start())
    })


def next_state(subs: DataFrame, plans: DataFrame) -> DataFrame:
    """Counts of plan-to-next-plan changes and their percentage of all changes out of the plan (WN15)."""
    moves = transitions(subs).filter(F.col("next_plan_id").isNotNull())
    counts = moves.groupBy("plan_id", "next_plan_id").agg(F.count(F.lit(1)).alias("changes"))
    # At most one row per pair of plans from here on.
    share = percent(F.col("changes"), F.sum("changes").over(Window.partitionBy("plan_id")), 1)
    names = [plans.select(F.col("plan_id").alias(f"{p}_id"), F.col("plan_name").alias(f"{p}_name")) for p in ("plan", "next_plan")]
    return counts.withColumn("percent_of_plan", share).join(names[0], "plan_id").join(names[1], "next_plan_id").select(
        "plan_name", "next_plan_name", "changes", "percent_of_plan"
    )


def after_initial_trial(subs: DataFrame, plans: DataFrame, plan: int = TRIAL) -> DataFrame:
    """What customers that start with the trial choose next: count and percentage of customers (WN15, AG29)."""
    first = transitions(subs).withColumn("_at", F.row_number().over(by_start())).filter(
        (F.col("_at") == 1) & (F.col("plan_id") == plan) & F.col("next_plan_id").isNotNull()
    )
    counts = first.groupBy("next_plan_id").agg(F.count(F.lit(1)).alias("customers"))
    every = subs.agg(F.countDistinct("customer_id")).scalar()
    return counts.join(plans, F.col("next_plan_id") == F.col("plan_id")).select(
        "plan_id", "plan_name", "customers", percent(F.col("customers"), every, 1).alias("percent_of_customers"),
        percent(F.col("customers"), every, 0).alias("percent_rounded"),
    )


def changes_between(subs: DataFrame, before: int, after: int, start: str, end: str) -> DataFrame:
    """Customers that went directly from one plan to another with the change in ``[start, end)`` (WN15)."""
    moved = transitions(subs).filter(
        (F.col("plan_id") == before) & (F.col("next_plan_id") == after)
        & (F.col("next_start_date") >= F.lit(start).cast("date")) & (F.col("next_start_date") < F.lit(end).cast("date"))
    )
    return moved.agg(F.countDistinct("customer_id").alias("customers"), F.count(F.lit(1)).alias("changes"))


def state_as_of(subs: DataFrame, plans: DataFrame, day: str) -> DataFrame:
    """Customers per plan on a day, with percentages (WN16). One aggregation picks each customer's latest change."""
    # Date and plan in one number, so the pick is a hash aggregate; the last of a day's changes counts.
    position = F.unix_date("start_date").cast("long") * 2**32 + F.col("plan_id")
    latest = subs.filter(F.col("start_date") <= F.lit(day).cast("date")).groupBy("customer_id").agg(
        F.max_by("plan_id", position).alias("plan_id")
    )
    counts = latest.groupBy("plan_id").agg(F.count(F.lit(1)).alias("customers"))
    total = counts.agg(F.sum("customers")).scalar()
    return counts.join(plans, "plan_id").select(
        "plan_id", "plan_name", "customers", percent(F.col("customers"), total, 1).alias("percent_of_customers")
    )


def starters_between(subs: DataFrame, plan: int, start: str, end: str) -> DataFrame:
    """Distinct customers starting a plan in ``[start, end)`` (AG2)."""
    chosen = subs.filter(
        (F.col("plan_id") == plan) & (F.col("start_date") >= F.lit(start).cast("date"))
        & (F.col("start_date") < F.lit(end).cast("date"))
    )
    return chosen.agg(F.countDistinct("customer_id").alias("customers"))


def upgrade_days(subs: DataFrame, plan: int = PRO_ANNUAL) -> DataFrame:
    """Days from a customer's first change to the first start of a plan (WN17)."""
    firsts = subs.groupBy("customer_id").agg(
        F.min("start_date").alias("_joined"), F.min(F.when(F.col("plan_id") == plan, F.col("start_date"))).alias("_reached")
    )
    reached = firsts.filter(F.col("_reached").isNotNull())
    return reached.select("customer_id", F.datediff("_reached", "_joined").alias("days"))


def days_to_upgrade(subs: DataFrame, plan: int = PRO_ANNUAL) -> DataFrame:
    """Average days to a plan, and how many customers reached it (WN17)."""
    return upgrade_days(subs, plan).agg(
        F.count(F.lit(1)).alias("customers"), F.round(mean(F.col("days")), 2).alias("avg_days")
    )


def upgrade_buckets(subs: DataFrame, plan: int = PRO_ANNUAL, width: int = 30) -> DataFrame:
    """Customers per period of ``width`` days to a plan: 0-30, 31-60, ... (AG28)."""
    bucket = (F.ceil(F.greatest(F.col("days"), F.lit(1)) / width) - 1).cast("int")
    counts = upgrade_days(subs, plan).groupBy(bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("customers"), F.round(mean(F.col("days")), 2).alias("avg_days")
    )
    low = F.when(F.col("bucket") == 0, 0).otherwise(F.col("bucket") * width + 1)
    return counts.withColumn("label", F.concat(low, F.lit("-"), (F.col("bucket") + 1) * width))


def journey(subs: DataFrame, plans: DataFrame) -> DataFrame:
    """Each customer's plans in order with their start dates, as one line of text (DO29)."""
    named = state_changes(subs).join(plans, "plan_id")
    step = F.concat(F.col("plan_name"), F.lit(" ("), F.col("start_date").cast("string"), F.lit(")"))
    return named.withColumn("step", step).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("steps"), F.expr("listagg(step, ' > ') WITHIN GROUP (ORDER BY start_date, plan_id)").alias("journey")
    )


def payment_schedule(subs: DataFrame, plans: DataFrame, horizon: str) -> DataFrame:
    """Every payment up to ``horizon`` (DO26).

    Payments fall on the plan's start and then every month (every 12 for the annual plan), counted from the start so
    that a 31st recovers after a short month. They stop before the customer's next change. A change from basic to a
    pro plan inside a paid month is charged at once, less the basic price; on a billing date the full price is due.
    From pro monthly to annual, the annual plan is charged at the next billing date.
    """
    priced = transitions(subs).join(plans, "plan_id").withColumns({
        "_prev": F.lag("plan_id").over(by_start()), "_prev_start": F.lag("start_date").over(by_start()),
        "_prev_price": F.lag("price").over(by_start()),
    })
    months_on = (F.year("start_date") - F.year("_prev_start")) * 12 + F.month("start_date") - F.month("_prev_start")
    billing = F.add_months("_prev_start", months_on)
    next_billing = F.when(billing >= F.col("start_date"), billing).otherwise(F.add_months("_prev_start", months_on + 1))
    waits = (F.col("_prev") == PRO_MONTHLY) & (F.col("plan_id") == PRO_ANNUAL)
    credited = (F.col("_prev") == BASIC) & F.col("plan_id").isin(PRO_MONTHLY, PRO_ANNUAL) & (billing != F.col("start_date"))
    due = priced.filter(F.col("price") > 0).withColumns({
        "_begin": F.when(waits, next_billing).otherwise(F.col("start_date")),
        "_last": F.least(F.date_sub("next_start_date", 1), F.lit(horizon).cast("date")),
        "_credit": F.when(credited, F.col("_prev_price")).otherwise(F.lit(0)),
        "_months": F.when(F.col("plan_id") == PRO_ANNUAL, 12).otherwise(1),
    }).filter("_begin <= _last")
    dates = F.sequence(F.col("_begin"), F.col("_last"), F.make_ym_interval(F.lit(0), F.col("_months")))
    paid = due.withColumn("payment_date", F.explode(dates))
    first = F.col("payment_date") == F.col("_begin")
    in_order = Window.partitionBy("customer_id").orderBy("payment_date", "start_date", "plan_id")
    return paid.select(
        "customer_id", "plan_id", "plan_name", "payment_date",
        (F.col("price") - F.when(first, F.col("_credit")).otherwise(F.lit(0))).cast("decimal(7,2)").alias("amount"),
        F.row_number().over(in_order).alias("payment_order"),
    )
