"""Monthly entity metrics: presence over periods, short-tenure removal, extremes and key audits.

metrics(interest_id, month_year, composition, ranking, percentile_ranking); NULL ids and months can occur.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import mean, month_of
from .grouped import not_in, top_values


def counts_with_total(metrics: DataFrame) -> DataFrame:
    """Records per month, NULL month first, with the grand total on every row (SO2, WN6)."""
    total = metrics.agg(F.count(F.lit(1))).scalar()
    per_month = metrics.groupBy("month_year").agg(F.count(F.lit(1)).alias("records"))
    return per_month.withColumn("total_records", total).orderBy(F.asc_nulls_first("month_year"))


def key_audit(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """Keys of each side that the other side lacks, as key counts and as joined-row counts (JN4, ST2).

    Both sides shrink to one row per key before the full join, so a frequent key costs one row.
    """
    sides = [
        df.filter(F.col(k).isNotNull()).groupBy(F.col(k).alias(f"_{name}")).agg(F.count(F.lit(1)).alias(f"_n{name}"))
        for df, k, name in ((left, left_key, "l"), (right, right_key, "r"))
    ]
    both = sides[0].join(sides[1], F.col("_l") == F.col("_r"), "full")
    only_left, only_right = F.col("_r").isNull(), F.col("_l").isNull()
    return both.agg(
        F.count("_l").alias("left_keys"),
        F.count("_r").alias("right_keys"),
        F.count_if(only_left).alias("left_only_keys"),
        F.count_if(only_right).alias("right_only_keys"),
        F.coalesce(F.sum(F.when(only_left, F.col("_nl"))), F.lit(0)).alias("left_only_rows"),
        F.coalesce(F.sum(F.when(only_right, F.col("_nr"))), F.lit(0)).alias("right_only_rows"),
    )


def before_created(metrics: DataFrame, registry: DataFrame) -> DataFrame:
    """Records dated before their entity was created, by date and by month (DO25)."""
    joined = metrics.join(registry, F.col("interest_id") == F.col("id"))
    created = F.col("created_at").cast("date")
    return joined.agg(
        F.count_if(F.col("month_year") < created).alias("before_date"),
        F.count_if(F.col("month_year") < month_of(created)).alias("before_month"),
    )


def tenures(metrics: DataFrame, period: str = "month_year", distinct: bool = True) -> DataFrame:
    """Periods in which each entity occurs; ``distinct=False`` counts its dated records instead (AG20)."""
    known = metrics.filter(F.col("interest_id").isNotNull())
    counted = F.countDistinct(period) if distinct else F.count(period)
    return known.groupBy("interest_id").agg(counted.alias("total_periods"))


def present_in_all(metrics: DataFrame, period: str = "month_year") -> DataFrame:
    """Entities present in every period of the data (AG19, FLT13)."""
    every = metrics.select(period).distinct().agg(F.count(period)).scalar()
    return tenures(metrics, period).filter(F.col("total_periods") == every)


def tenure_cumulative(metrics: DataFrame, period: str = "month_year", distinct: bool = True) -> DataFrame:
    """Entities per tenure and their cumulative share from the longest tenure down (DO21, WN7)."""
    histogram = tenures(metrics, period, distinct).groupBy("total_periods").agg(F.count(F.lit(1)).alias("interests"))
    # One row per tenure length: the window sees at most as many rows as there are periods.
    down = Window.orderBy(F.desc("total_periods")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = histogram.agg(F.sum("interests")).scalar()
    return histogram.withColumn(
        "cumulative_percent", F.round(F.lit(100.0) * F.sum("interests").over(down) / total, 2)
    )


def short_lived(metrics: DataFrame, min_periods: int, period: str = "month_year") -> DataFrame:
    return tenures(metrics, period).filter(F.col("total_periods") < min_periods).select("interest_id")


def removed_points(metrics: DataFrame, min_periods: int, period: str = "month_year") -> DataFrame:
    """Records and entities that a minimum tenure would remove (DO22, JN7): counted per entity, so no join is needed."""
    per_interest = metrics.filter(F.col("interest_id").isNotNull()).groupBy("interest_id").agg(
        F.count(F.lit(1)).alias("records"), F.countDistinct(period).alias("periods")
    )
    return per_interest.filter(F.col("periods") < min_periods).agg(
        F.coalesce(F.sum("records"), F.lit(0)).alias("records"), F.count("interest_id").alias("interests")
    )


def without_short_lived(metrics: DataFrame, min_periods: int, period: str = "month_year") -> DataFrame:
    """Records of entities with at least ``min_periods`` periods; records without an id are dropped too (DO20)."""
    return not_in(metrics, "interest_id", short_lived(metrics, min_periods, period), "interest_id")


def interests_per_month(metrics: DataFrame) -> DataFrame:
    """Distinct entities per month (AG2)."""
    return metrics.filter(F.col("month_year").isNotNull()).groupBy("month_year").agg(
        F.countDistinct("interest_id").alias("interests")
    )


def top_and_bottom(metrics: DataFrame, value: str = "composition", k: int = 10) -> DataFrame:
    """Entities with the ``k`` highest and ``k`` lowest maximum values, with the month of the maximum (DO23, LM2, LM3).

    Ties share a rank and are kept; the latest month wins when the maximum occurs twice.
    """
    best = metrics.filter(F.col("month_year").isNotNull()).groupBy("interest_id").agg(
        F.max(F.struct(F.col(value).alias("v"), F.col("month_year").alias("m"))).alias("_b")
    ).select("interest_id", F.col("_b.m").alias("month_year"), F.col("_b.v").alias("max_value"))
    ends = [top_values(best, "max_value", k, bottom).withColumn("side", F.lit(side)) for side, bottom in (("top", False), ("bottom", True))]
    # At most 2 * k ranked values.
    ranked = best.join(F.broadcast(ends[0].unionByName(ends[1])), "max_value")
    return ranked.select("side", "interest_id", "month_year", "max_value", "rnk")


def lowest_average(metrics: DataFrame, value: str = "ranking", n: int = 5) -> DataFrame:
    """Entities with the lowest average value; equal averages go by id (AG5, LM1)."""
    averages = metrics.groupBy("interest_id").agg(F.round(mean(F.col(value)), 2).alias("avg_value"))
    return averages.orderBy("avg_value", "interest_id").limit(n)


def most_volatile(metrics: DataFrame, value: str = "percentile_ranking", n: int = 5) -> DataFrame:
    """Entities with the largest sample standard deviation; equal ones go by id (AG15, LM1)."""
    spread = metrics.groupBy("interest_id").agg(F.round(F.stddev_samp(value), 2).alias("stddev"))
    return spread.orderBy(F.desc_nulls_last("stddev"), "interest_id").limit(n)


def extreme_months(metrics: DataFrame, value: str = "percentile_ranking", n: int = 5) -> DataFrame:
    """Highest and lowest value of the most volatile entities with their months (DO24, AG18).

    The latest month of the maximum and the earliest month of the minimum are kept. The chosen side has ``n`` rows.
    """
    chosen = F.broadcast(most_volatile(metrics, value, n))
    rows = metrics.filter(F.col("month_year").isNotNull()).join(chosen, "interest_id")
    # Months without a value are neither the highest nor the lowest one.
    pair = F.when(F.col(value).isNotNull(), F.struct(F.col(value).alias("v"), F.col("month_year").alias("m")))
    ends = rows.groupBy("interest_id").agg(
        F.any_value("stddev").alias("stddev"), F.max(pair).alias("_hi"), F.min(pair).alias("_lo")
    )
    return ends.select(
        "interest_id", "stddev", F.col("_hi.m").alias("max_month"), F.col("_hi.v").alias("max_value"),
        F.col("_lo.m").alias("min_month"), F.col("_lo.v").alias("min_value"),
    )
