"""All queries of the engine, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .queries import alignment, checks, episodes, running, scalars, vectors

Query = Callable[[SparkSession, str], DataFrame]
_MODULES = (alignment, episodes, checks, vectors, running, scalars)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.tolerance_stats(spark, sf_dir)


def queries() -> dict[str, Query]:
    return {name: query for module in _MODULES for name, (query, _) in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, (_, sql) in module.QUERIES.items() if sql is not None}
