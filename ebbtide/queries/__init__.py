"""Registered queries over the star-schema tables, each next to the SQL it is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def registry() -> tuple[dict[str, Query], dict[str, str]]:
    """All queries and the SQL of those that have one."""
    from ebbtide.queries import evaluation, features, modelling, quality

    queries: dict[str, Query] = {}
    sql: dict[str, str] = {}
    for module in (features, quality, evaluation, modelling):
        queries.update(module.QUERIES)
        sql.update(module.SQL)
    return queries, sql
