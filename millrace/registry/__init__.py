"""Queries over the given tables, each with equivalent SQL where SQL can express it.

The tables stand in for the inputs the operators are made for; the mapping is stated per query.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with its SQL if it has one."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = function
        if sql:
            SQL[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load_all() -> tuple[dict[str, Query], dict[str, str]]:
    """Import every registry module and return all queries and SQL texts."""
    from millrace.registry import (  # noqa: F401
        complaints,
        documents,
        features,
        files,
        incremental,
        models,
        quality,
        recommend,
        streams,
    )

    return QUERIES, SQL
