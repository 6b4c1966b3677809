"""Named queries over the test tables, with their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltstone.plans import extraction_queries, lifecycle_queries, refresh_queries, snapshot_queries, text_queries

_MODULES = (snapshot_queries, refresh_queries, text_queries, extraction_queries, lifecycle_queries)


def all_queries() -> dict:
    return {name: call for module in _MODULES for name, call in module.queries().items()}


def all_oracle_sql() -> dict:
    return {name: sql for module in _MODULES for name, sql in module.oracle_sql().items()}


def flagship(spark: SparkSession, base: str) -> DataFrame:
    return snapshot_queries.p1_found(spark, base)
