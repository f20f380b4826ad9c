"""Aggregations beyond a single ``groupBy().agg()``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sum_where(condition: Column, value: Column | int = 1) -> Column:
    """Sum of ``value`` over the rows that meet the condition, 0 when none does."""
    return F.sum(F.when(condition, value).otherwise(F.lit(0)))


def weighted_sum(value: Column, weight: Column) -> Column:
    """Sum of ``value * weight``, a missing value counting as 0."""
    return F.sum(F.coalesce(value, F.lit(0)) * weight)


def sums_by_label(value: Column, label: Column, labels: dict[str, str]) -> list[Column]:
    """One sum per label (a pivot with known values); rows with another label add 0."""
    return [F.sum(F.when(label == text, value).otherwise(F.lit(0))).alias(name) for name, text in labels.items()]


def joined_text(
    df: DataFrame,
    keys: Sequence[str],
    text: str,
    order: str,
    part: str = "part",
    width: int = 256,
    sep: str = " ",
) -> DataFrame:
    """Texts of each key joined in ``order``, whole, as numbered parts.

    A part covers ``width`` consecutive values of the unique integer column ``order``. Reading the parts of a key in
    sequence gives the complete text; no task ever holds more than one part of one key.
    """
    numbered = df.where(F.col(text).isNotNull()).withColumn(part, F.floor(F.col(order) / F.lit(width)))
    joined = _ordered_listagg(text, sep, order)
    return numbered.groupBy(*keys, part).agg(joined.alias(text), F.count("*").alias("texts"))


def _ordered_listagg(text: str, sep: str, order: str) -> Column:
    escaped = sep.replace("\\", "\\\\").replace("'", "\\'")
    return F.expr(f"listagg(`{text}`, '{escaped}') within group (order by `{order}`)")


def totals_row(df: DataFrame, fields: Sequence[str], label_column: str, label: str = "Total") -> DataFrame:
    """One row with the sums of ``fields`` and ``label`` in ``label_column``."""
    sums = [F.sum(F.col(f"`{field}`")).alias(field) for field in fields]
    return df.agg(*sums).withColumn(label_column, F.lit(label))


def numeric_sums(df: DataFrame) -> DataFrame:
    """Sum of every numeric column."""
    numeric = ("tinyint", "smallint", "int", "bigint", "float", "double")
    names = [n for n, t in df.dtypes if t in numeric or t.startswith("decimal")]
    return df.agg(*[F.sum(F.col(f"`{n}`")).alias(n) for n in names])


def counts_with_total(df: DataFrame, by: str, total: str = "Total", count: str = "row_count") -> DataFrame:
    """Row count per value of ``by`` and a last row with the overall count."""
    return (
        df.rollup(by)
        .agg(F.grouping_id().alias("_level"), F.count("*").alias(count))
        .select(F.when(F.col("_level") == 1, total).otherwise(F.col(by)).alias(by), count)
    )
