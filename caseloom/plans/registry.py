"""Collects the queries of all areas and shapes their output for comparison."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..sources.views import Views
from . import basket, core, delivery, funnel, impact, intervals, ledger, loyalty, subscription, tenure

AREAS = (core, loyalty, delivery, ledger, intervals, funnel, tenure, subscription, impact, basket)


def present(df: DataFrame) -> DataFrame:
    """Decimals as doubles and integers as bigint, so results compare with any SQL engine's column types."""
    wide = {
        f.name: F.col(f.name).cast("double" if isinstance(f.dataType, T.DecimalType) else "bigint")
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DecimalType, T.IntegerType, T.ShortType))
    }
    return df.withColumns(wide) if wide else df


def _query(build: Callable[[Views], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: present(build(Views(spark, sf_dir)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _query(build) for area in AREAS for name, (build, _) in area.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: sql for area in AREAS for name, (_, sql) in area.QUERIES.items() if sql}
