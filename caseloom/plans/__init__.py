"""Registered queries and their SQL oracles, one module per business area."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import registry

    return registry.queries()


def all_oracles() -> dict[str, str]:
    from . import registry

    return registry.oracles()
