"""Unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stack(*frames: DataFrame) -> DataFrame:
    """UNION ALL by column name; a column a frame lacks becomes null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def stack_distinct(*frames: DataFrame) -> DataFrame:
    """UNION: one distinct over all branches, so a single shuffle."""
    return stack(*frames).distinct()


def add_typed_nulls(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Null columns of the given types."""
    return df.withColumns({name: F.lit(None).cast(kind) for name, kind in columns.items()})
