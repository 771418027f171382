"""Building blocks that stay exact when one key holds a large share of all rows.

A window partitioned by such a key would send all its rows to one task. The helpers here shrink the key's rows first
(one row per key and date, per key and value, per slice of time), run the window over that small frame and join the
result back. The joins are plain equi-joins, so adaptive execution can split a skewed side.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..sources.sinks import stage


def join_back(rows: DataFrame, per_key: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Joins ``per_key`` onto ``rows`` by ``keys``; NULL keys meet NULL keys, as in GROUP BY."""
    renamed = per_key.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in per_key.columns if c not in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    return rows.join(renamed, same, how).drop(*[f"_k_{k}" for k in keys])


def steps(df: DataFrame, key: Sequence[str], at: str, amount: Column) -> DataFrame:
    """One row per key and date: ``net`` sum, ``n`` rows and the ``running`` total up to and including the date."""
    per_step = df.groupBy(*key, at).agg(F.sum(amount).alias("net"), F.count(F.lit(1)).alias("n"))
    so_far = Window.partitionBy(*key).orderBy(at).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return per_step.withColumn("running", F.sum("net").over(so_far))


def number_rows(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], slice_by: Column, into: str = "rn"
) -> DataFrame:
    """Exact row number per key.

    ``slice_by`` must not decrease along the order (the date of a timestamp, say). Rows are numbered inside each
    (key, slice) and shifted by the number of rows in the key's earlier slices.
    """
    sliced = df.withColumn("_slice", slice_by)
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shift = (
        sliced.groupBy(*keys, "_slice")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select(*keys, "_slice", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_shift"))
    )
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order_by)
    numbered = sliced.withColumn("_at", F.row_number().over(inside))
    return (
        join_back(numbered, shift, [*keys, "_slice"])
        .withColumn(into, F.col("_at").cast("long") + F.col("_shift"))
        .drop("_slice", "_at", "_shift")
    )


def rows_frame(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    slice_by: Column,
    preceding: int,
    aggregates: dict[str, Column],
    chunk_rows: int = 100_000,
) -> DataFrame:
    """Aggregates over the current row and the ``preceding`` rows before it.

    A key's rows are cut into chunks of ``chunk_rows``; the last ``preceding`` rows of a chunk are repeated in front
    of the next one, so each chunk can be handled by its own task and every frame is complete.
    """
    chunk_rows = max(chunk_rows, preceding)
    numbered = number_rows(df, keys, order_by, slice_by, into="_rn")
    chunk = F.floor((F.col("_rn") - 1) / chunk_rows)
    in_tail = (F.col("_rn") - 1) % chunk_rows >= chunk_rows - preceding
    copies = numbered.withColumn(
        "_copy",
        F.explode(
            F.when(in_tail, F.array(F.struct(chunk.alias("chunk"), F.lit(True).alias("own")),
                                    F.struct((chunk + 1).alias("chunk"), F.lit(False).alias("own"))))
            .otherwise(F.array(F.struct(chunk.alias("chunk"), F.lit(True).alias("own"))))
        ),
    ).select("*", F.col("_copy.chunk").alias("_chunk"), F.col("_copy.own").alias("_own"))
    frame = Window.partitionBy(*keys, "_chunk").orderBy("_rn").rowsBetween(-preceding, Window.currentRow)
    with_values = copies.select("*", *[a.over(frame).alias(name) for name, a in aggregates.items()])
    return with_values.filter("_own").drop("_copy", "_chunk", "_own", "_rn")


def top_values(df: DataFrame, value: str, k: int, ascending: bool = False, into: str = "rnk") -> DataFrame:
    """The ``k`` largest (or smallest) distinct values with their dense rank: at most ``k`` rows."""
    order = F.col(value).asc_nulls_last() if ascending else F.col(value).desc_nulls_last()
    best = df.filter(F.col(value).isNotNull()).select(value).distinct().orderBy(order).limit(k)
    return best.withColumn(into, F.row_number().over(Window.orderBy(order)))


def with_top_values(df: DataFrame, value: str, k: int, ascending: bool = False, into: str = "rnk") -> DataFrame:
    """Rows whose value is among the ``k`` best distinct values, ties kept (LM2, LM3, WN4).

    Only the ``k`` best values are ranked, so no window ever sees the whole table in one partition. The ranked side
    has at most ``k`` rows, which is what makes the broadcast safe.
    """
    return df.join(F.broadcast(top_values(df, value, k, ascending, into)), value)


def not_in(df: DataFrame, col: str, listed: DataFrame, listed_col: str) -> DataFrame:
    """``col NOT IN (listed)`` with SQL's NULL rules (JN8).

    An empty list keeps every row. A NULL in the list leaves nothing. Otherwise NULL values of ``col`` are dropped.
    The rows are removed by an anti join on the key, so the list may be of any size.
    """
    ids = listed.select(F.col(listed_col).alias("_listed"))
    facts = ids.agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_listed").isNull()).alias("nulls")).alias("f")
    ).scalar()
    kept = df.join(ids.filter("_listed IS NOT NULL").distinct(), F.col(col) == F.col("_listed"), "left_anti")
    return kept.filter((facts["n"] == 0) | ((facts["nulls"] == 0) & F.col(col).isNotNull()))


def ordinal(value: str, kind: T.DataType) -> tuple[Column, Column]:
    """An integer in the order of a column (whole numbers, dates, decimals of up to 18 digits), and the way back from ``_cell``."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.col(value).cast("long"), F.col("_cell").cast(kind)
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("long"), F.date_from_unix_date(F.col("_cell").cast("int"))
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        unit = F.lit(10**kind.scale).cast(T.DecimalType(19, 0))
        return (F.col(value) * unit).cast("long"), (F.col("_cell").cast(T.DecimalType(19, 0)) / unit).cast(kind)
    raise TypeError(f"ranks are selected among whole numbers, dates and decimals of up to 18 digits, not {kind.simpleString()}")


def running_cells(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The cells of each key with ``_upto``, the number of rows in a cell and all before it, and ``_total``, that in all cells."""
    order = Window.partitionBy(*keys).orderBy("_cell")
    return cells.withColumns({
        "_upto": F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "_total": F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
    })


def radix_select(df: DataFrame, keys: Sequence[str], value: str, targets: Callable[[Column], list[Column]], cells: int = 4096) -> DataFrame:
    """The values at some ranks of every group (``keys`` may be empty): a row for each target with its fields and ``value`` (AG14, AG24).

    ``targets`` makes structs with a field ``rank`` (from 1) out of the number of rows of the group; NULL values do not count.
    Works when called: counts per value are stored once. Then a histogram is refined: the first pass counts rows in at most ``cells``
    equal cells (values without their low bits) and finds the cell of every rank; each further pass opens only the cells that were
    hit, into ``cells`` cells of their own, until a cell is one value wide. A pass moves one row per cell, so neither outliers nor a
    group with very many different values bring more than ``cells`` rows to one place.
    """
    cells = max(2, cells)
    number, back = ordinal(value, df.schema[value].dataType)
    present = df.filter(F.col(value).isNotNull()).withColumn("_value", number)
    counts = stage(present.groupBy(*keys, "_value").agg(F.count(F.lit(1)).alias("_n")), "value-counts")
    least, most = counts.agg(F.min("_value"), F.max("_value")).first()
    shift = 0
    while least is not None and (most >> shift) - (least >> shift) >= cells:
        shift += 1
    one = counts.groupBy(*keys, F.shiftright("_value", shift).alias("_cell")).agg(F.sum("_n").alias("_n"))
    placed = running_cells(one, keys).select(*keys, "_cell", "_n", "_upto", F.explode(F.array(*targets(F.col("_total")))).alias("_t"))
    hits = _hit_cells(placed, F.col("_t.rank"), keys)
    while shift:
        above, shift = shift, max(0, shift - (cells.bit_length() - 1))
        # At most a row for each group and target, stored so that plans do not grow from pass to pass.
        hits = stage(hits, "cells-hit")
        wanted = hits.groupBy(*keys, F.col("_cell").alias("_parent")).agg(F.array_sort(F.collect_list(F.struct("_left", "_t"))).alias("_wanted"))
        opened = join_back(counts.withColumn("_parent", F.shiftright("_value", above)), wanted, [*keys, "_parent"])
        finer = opened.groupBy(*keys, "_parent", "_wanted", F.shiftright("_value", shift).alias("_cell")).agg(F.sum("_n").alias("_n"))
        placed = running_cells(finer, [*keys, "_parent"]).withColumn("_w", F.explode("_wanted"))
        hits = _hit_cells(placed.select(*keys, "_cell", "_n", "_upto", "_w._left", "_w._t"), F.col("_left"), keys)
    return hits.select(*keys, "_t.*", back.alias(value))


def _hit_cells(placed: DataFrame, rank: Column, keys: Sequence[str]) -> DataFrame:
    """The cell of every target and ``_left``, the target's rank inside it."""
    before = F.col("_upto") - F.col("_n")
    return placed.filter((rank > before) & (rank <= F.col("_upto"))).select(*keys, "_cell", (rank - before).alias("_left"), "_t")


def order_statistics(df: DataFrame, value: str, fractions: Sequence[float], cells: int = 4096, keys: Sequence[str] = ()) -> DataFrame:
    """Exact interpolated percentiles of a column of numbers, one row per group and fraction (AG24); see :func:`radix_select`."""

    def neighbours(total: Column) -> list[Column]:
        # Each fraction needs the values at two neighbouring ranks and their weights; the last value has no right neighbour.
        out = []
        for f in fractions:
            place = F.lit(float(f)) * (total - 1)
            low = F.floor(place)
            for rank, weight in ((low + 1, 1 - (place - low)), (F.least(low + 2, total), place - low)):
                out.append(F.struct(F.lit(float(f)).alias("fraction"), rank.cast("long").alias("rank"), weight.cast("double").alias("weight")))
        return out

    found = radix_select(df, keys, value, neighbours, cells)
    return found.groupBy(*keys, "fraction").agg(F.sum(F.col("weight") * F.col(value).cast("double")).alias("value"))
