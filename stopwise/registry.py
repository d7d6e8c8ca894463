"""All registered queries and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stopwise.plans import queries, queries_checks, queries_marts  # noqa: F401  (they register)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def run(build):
        return lambda spark, sf_dir: queries.portable(build(queries.Context(spark, sf_dir)))

    return {name: run(build) for name, build in queries.BUILDERS.items()}


def all_sql() -> dict[str, str]:
    return dict(queries.SQL)
