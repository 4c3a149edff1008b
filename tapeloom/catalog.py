"""Registered queries and their reference SQL, gathered from the areas."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import registry
from .plans import q_bars, q_factors, q_files, q_gates, q_merge, q_news, q_refresh, q_streams  # noqa: F401  (they register their queries)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(registry.SQL)
