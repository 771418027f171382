"""Validity intervals: open ends, stay lengths, nearest-rank percentiles and point-in-interval joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import int_avg, mean
from .grouped import join_back, radix_select

# Fixed value: the end date that stands for "still open".
OPEN_END = "9999-12-31"
# How much finer than an interval its nodes are: 2**DEPTH of them fit into it.
DEPTH = 1
PERCENTILES = {"median": "0.5", "80th percentile": "0.8", "95th percentile": "0.95"}


def closed_intervals(nodes: DataFrame, end: str = "end_date") -> DataFrame:
    """Intervals that have ended (FLT10)."""
    return nodes.filter(F.nullif(F.col(end), F.lit(OPEN_END).cast("date")).isNotNull())


def node_counts(nodes: DataFrame) -> DataFrame:
    """Node rows and distinct customers per region (AG1, AG2)."""
    # One row per region and customer first, so the distinct count is a plain count of reduced rows.
    per_customer = nodes.groupBy("region_id", "customer_id").agg(F.count("node_id").alias("n"))
    return per_customer.groupBy("region_id").agg(
        F.sum("n").alias("node_rows"), F.count("customer_id").alias("customers")
    )


def unique_nodes(nodes: DataFrame) -> DataFrame:
    """Distinct nodes (AG2)."""
    return nodes.agg(F.countDistinct("node_id").alias("unique_nodes"))


def stay_days(nodes: DataFrame, group: Sequence[str] = ("customer_id", "region_id", "node_id")) -> DataFrame:
    """Days spent per customer, region and node over closed intervals (SF10)."""
    days = F.sum(F.datediff("end_date", "start_date"))
    return closed_intervals(nodes).groupBy(*group).agg(days.alias("days_stayed"))


def average_stay(nodes: DataFrame) -> DataFrame:
    """Average days until a customer moves to another node, truncated and exact (DO13, AG11)."""
    return stay_days(nodes).agg(
        int_avg(F.col("days_stayed")).alias("avg_days_int"), mean(F.col("days_stayed")).alias("avg_days"),
        F.count(F.lit(1)).alias("stays"),
    )


def nearest_rank(df: DataFrame, group: Sequence[str], value: str,
                 fractions: Mapping[str, str] = PERCENTILES, cells: int = 4096) -> DataFrame:
    """Nearest-rank percentiles per group: the value at row ``round(n * p)`` of the sorted group, at least row 1 (AG14).

    Fractions are given as text so the rounding is done in decimals. NULL values do not count. Works when called; see
    :func:`~caseloom.operators.grouped.radix_select`.
    """

    def ranks(total: Column) -> list[Column]:
        return [
            F.struct(
                F.lit(label).alias("percentile"),
                F.greatest(F.round(total * F.lit(p).cast("decimal(4,3)"), 0).cast("long"), F.lit(1)).alias("rank"),
            )
            for label, p in fractions.items()
        ]

    return radix_select(df, group, value, ranks, cells).drop("rank")


def _ticks(col: Column, kind: T.DataType) -> Column:
    """Whole seconds in the order of the column's type: dates and local timestamps by their fields, others since the epoch."""
    if isinstance(kind, T.TimestampType):
        return F.unix_seconds(col)
    seconds = F.lit(0) if isinstance(kind, T.DateType) else F.hour(col) * 3600 + F.minute(col) * 60 + F.second(col)
    return F.unix_date(col.cast("date")).cast("long") * 86_400 + seconds


def _moments(*kinds: T.DataType) -> T.DataType:
    """The type in which dates and timestamps are compared."""
    return next((k for wanted in (T.TimestampType, T.TimestampNTZType, T.DateType) for k in kinds if isinstance(k, wanted)), T.TimestampType())


def interval_nodes(intervals: DataFrame, first: Column, last: Column, depth: int = DEPTH) -> DataFrame:
    """Rows (``_level``, ``_node``) of the binary tree over time for each interval of seconds first..last; empty ones have none.

    A node of level k holds 2**k seconds. An interval of 2**k to 2**(k+1) - 1 seconds is covered by nodes of level k - ``depth`` (0 at
    least): at most 2**(depth + 1) + 1 of them whatever its length, which reach beyond it by two nodes at most.
    """
    length = F.length(F.conv((last - first + 1).cast("string"), 10, 2))
    level = F.greatest(length - 1 - depth, F.lit(0))
    placed = intervals.withColumns({"_first": first, "_last": last}).filter("_first <= _last").withColumn("_level", level)
    at = lambda c: F.expr(f"shiftright({c}, _level)")
    return placed.withColumn("_node", F.explode(F.sequence(at("_first"), at("_last")))).drop("_first", "_last")


def intervals_at(moments: DataFrame, intervals: DataFrame, at: str, start: str, end: str, by: Sequence[str] = (), seen: DataFrame | None = None) -> DataFrame:
    """Distinct (``by``, ``at``) of ``moments`` with every interval that holds them, both ends included; others are left out.

    Intervals go to a few nodes of a binary tree over time, a moment looks at its node on each level that is in use, and the exact
    bounds are checked again. So an open interval is a few rows, as is one of a second, and moments of one day meet the intervals
    of their own hours or seconds. ``seen`` may name a column that is cheaper to scan than ``moments`` and covers its range. Both sides
    are merged, never broadcast: their sizes are estimated from before rows were made for nodes and levels.
    """
    kind = _moments(moments.schema[at].dataType, intervals.schema[start].dataType, intervals.schema[end].dataType)
    tick = lambda c: _ticks(F.col(c).cast(kind), kind)
    distinct = moments.filter(F.col(at).isNotNull()).select(*by, at).distinct()
    scanned = moments.select(at) if seen is None else seen
    bound = _ticks(F.col(scanned.columns[0]).cast(kind), kind)
    span = scanned.agg(F.struct(F.min(bound).alias("lo"), F.max(bound).alias("hi")).alias("s")).scalar()
    # Cut to the range of moments; an interval without an end is open.
    nodes = interval_nodes(
        intervals, F.greatest(tick(start), span["lo"]), F.coalesce(F.least(tick(end), span["hi"]), span["hi"])
    ).select(*(F.col(c).alias(f"_by_{c}") for c in by), *(c for c in intervals.columns if c not in by), "_level", "_node")
    used = F.array_sort(F.collect_set("_level")).alias("_levels")
    if by:
        # Only the levels of the moment's own key.
        levels = nodes.groupBy(*(f"_by_{c}" for c in by)).agg(used).select(*(F.col(f"_by_{c}").alias(c) for c in by), "_levels")
        levelled = distinct.join(levels.hint("merge"), [*by])
    else:
        levelled = distinct.withColumn("_levels", nodes.agg(used).scalar())
    probes = levelled.withColumn("_probe", F.explode("_levels")).withColumn("_tick", tick(at))
    probes = probes.withColumn("_at_node", F.expr("shiftright(_tick, _probe)"))
    on = (F.col("_probe") == F.col("_level")) & (F.col("_at_node") == F.col("_node"))
    for c in by:
        on = on & (F.col(c) == F.col(f"_by_{c}"))
    inside = (F.col(at) >= F.col(start)) & (F.col(end).isNull() | (F.col(at) <= F.col(end)))
    return probes.join(nodes.hint("merge"), on & inside).drop("_levels", "_probe", "_tick", "_at_node", "_level", "_node", *(f"_by_{c}" for c in by))


def interval_join(points: DataFrame, intervals: DataFrame, at: str, start: str, end: str, by: Sequence[str] = ()) -> DataFrame:
    """Left join of timestamps or dates to every interval that holds them, both ends included (JN6).

    ``by`` names columns that must be equal as well (NULL meets nothing); an interval without an end is open. Matches are found
    once for each distinct moment (see :func:`intervals_at`) and joined back, so a moment that very many points share is looked up once.
    """
    return join_back(points, intervals_at(points, intervals, at, start, end, by), [*by, at], "left")


def first_interval(points: DataFrame, intervals: DataFrame, at: str, start: str, end: str, name: str,
                   seen: DataFrame | None = None) -> DataFrame:
    """Every point once, with the name of the earliest-starting interval that holds it (of equals the smallest name) or NULL.

    ``seen`` may name a column that is cheaper to scan than ``points`` and covers the range of ``at``.
    """
    found = intervals_at(points, intervals.select(name, start, end), at, start, end, seen=seen)
    return join_back(points, found.groupBy(at).agg(F.min(F.struct(start, name)).alias("_first")).select(at, F.col(f"_first.{name}").alias(name)), [at], "left")
