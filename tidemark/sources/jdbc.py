"""Database tables through JDBC."""

from __future__ import annotations

import decimal
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources import retry


@dataclass(frozen=True)
class Connection:
    """One endpoint. Credentials are handed in by the caller."""

    url: str
    driver: str
    user: str = ""
    password: str = field(default="", repr=False)
    fetch_size: int = 10_000

    def options(self) -> dict[str, str]:
        named = {"url": self.url, "driver": self.driver, "user": self.user, "password": self.password}
        return {name: value for name, value in named.items() if value} | {"fetchsize": str(self.fetch_size)}


@dataclass(frozen=True)
class Split:
    """Reads a table with several tasks, by ranges of an evenly spread number or date column."""

    column: str
    lower: str
    upper: str
    partitions: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": self.lower,
            "upperBound": self.upper,
            "numPartitions": str(self.partitions),
        }


def read_table(spark: SparkSession, source: Connection, table: str, split: Split | None = None) -> DataFrame:
    options = source.options() | {"dbtable": table} | (split.options() if split else {})
    return spark.read.format("jdbc").options(**options).load()


def quantile_statement(table: str, column: str, partitions: int) -> str:
    """The least key of each of ``partitions`` equal parts of a table, found by the database: a row for each part."""
    tiles = f"SELECT {column} AS split_key, NTILE({partitions}) OVER (ORDER BY {column}) AS part FROM {table} WHERE {column} IS NOT NULL"
    return f"SELECT part, MIN(split_key) AS split_key FROM ({tiles}) tiles GROUP BY part"


def _literal(value: object) -> str:
    if isinstance(value, bool):
        raise ValueError("a key with two values splits nothing")
    if isinstance(value, (int, float, decimal.Decimal)):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def range_predicates(column: str, firsts: Sequence[object]) -> list[str]:
    """Conditions that hold for every row exactly once: ranges that begin with ``firsts``, and rows without a key.

    Parts that begin with the same key, which fills more than one of them, become one range.
    """
    bounds = sorted({first for first in firsts if first is not None})[1:]
    edges = [None, *bounds, None]
    parts = []
    for low, high in zip(edges, edges[1:]):
        sides = [f"{column} >= {_literal(low)}"] * (low is not None) + [f"{column} < {_literal(high)}"] * (high is not None)
        parts.append(" AND ".join(sides) or f"{column} IS NOT NULL")
    return [*parts, f"{column} IS NULL"]


def read_balanced(spark: SparkSession, source: Connection, table: str, column: str, partitions: int) -> DataFrame:
    """A table read by ``partitions`` tasks with about equally many rows each, wherever its keys lie.

    The database is asked once for the quantiles of ``column`` (numbers, dates or text in its own order), which an index
    on it answers. Unlike a :class:`Split` it needs no bounds and no even spread.
    """
    firsts = [row.split_key for row in read_query(spark, source, quantile_statement(table, column, partitions)).collect()]
    options = source.options()
    return spark.read.jdbc(options.pop("url"), table, predicates=range_predicates(column, firsts), properties=options)


def read_query(spark: SparkSession, source: Connection, sql: str, split: Split | None = None) -> DataFrame:
    """Result of a statement the database runs; with a split the statement becomes a derived table."""
    if split:
        return read_table(spark, source, f"({sql}) pushed", split)
    return spark.read.format("jdbc").options(**source.options(), query=sql).load()


def wait_for(spark: SparkSession, source: Connection, probe_table: str, sleep: float = retry.CONNECT_WAIT) -> DataFrame:
    """The probe table as soon as the database answers."""
    return retry.with_retry(lambda: read_table(spark, source, probe_table), retry.CONNECT_ATTEMPTS, sleep)


def overwrite_table(
    df: DataFrame, target: Connection, table: str, connections: int | None = None, sleep: float = retry.WRITE_WAIT
) -> None:
    """Replaces the rows of a table, keeping its definition; a deadlock is retried, other errors are raised.

    Every task writes through a connection of its own. ``connections`` bounds them for a database that needs it: rows
    are then dealt to so many tasks behind the last stage, which itself keeps its parallelism.
    """
    if connections:
        df = df.repartition(connections)
    options = target.options() | {
        "dbtable": table,
        "truncate": "true",
        "batchsize": "10000",
    }
    save: Callable[[], None] = df.write.mode("overwrite").format("jdbc").options(**options).save
    retry.with_retry(save, retry.WRITE_ATTEMPTS, sleep, retry.is_deadlock)
