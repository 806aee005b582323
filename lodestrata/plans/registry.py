"""All queries of the core with their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import feed_queries, hierarchy_queries, instant_queries, packed_queries, registry_queries

MODULES = [packed_queries, feed_queries, instant_queries, hierarchy_queries, registry_queries]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
