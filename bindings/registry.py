"""Collects the queries and the SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import apply_runtime_defaults

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def _with_defaults(function: Query) -> Query:
    """Runs a query under the settings the plans are written for, whoever made the session."""

    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(apply_runtime_defaults(spark), sf_dir)

    return run


def query(key: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under ``key``, with the SQL of its check if SQL can express it."""

    def add(function: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = _with_defaults(function)
        if oracle is not None:
            ORACLE_SQL[key] = oracle
        return function

    return add
