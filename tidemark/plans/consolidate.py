"""Consolidation of many workbooks with the same layout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import nulls
from tidemark.operators import aggregates, sets

# Ranks left out, ranks reported separately, summed columns and the closing texts.
EXCLUDED_RANKS = ["Unknown", "Intern (CS)"]
SENIOR_RANKS = ["Executive Director", "Manager"]
TOTAL_FIELDS = ["Charged Hours", "NSR", "ANSR"]
TOTAL_LABEL = "Total"
TRAILER = "Consolidation done"
HIGHLIGHTED = ("Activity Code Description", "General")


def consolidated(rows: DataFrame) -> DataFrame:
    """Rows of all files without the excluded ranks; a missing rank stays."""
    kept = rows
    for rank in EXCLUDED_RANKS:
        kept = kept.where(nulls.differs_keeping_null(F.col("Rank"), rank))
    return kept


def highlighted(rows: DataFrame) -> DataFrame:
    """Rows of the activity that is marked for review."""
    column, value = HIGHLIGHTED
    return rows.where(F.col(f"`{column}`") == value)


def senior(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("Rank").isin(SENIOR_RANKS))


def with_closing_rows(rows: DataFrame) -> DataFrame:
    """The rows, one totals row and the trailer, told apart by ``row_kind``.

    The label of a closing row stands in the first column.
    """
    first = rows.columns[0]
    rows = rows.withColumn(first, F.col(f"`{first}`").cast("string"))
    total = aggregates.totals_row(rows, TOTAL_FIELDS, first, TOTAL_LABEL)
    trailer = rows.sparkSession.range(1).select(F.lit(TRAILER).alias(first))
    return sets.stack(
        rows.withColumn("row_kind", F.lit("data")),
        total.withColumn("row_kind", F.lit("total")),
        trailer.withColumn("row_kind", F.lit("trailer")),
    )


def consolidation(rows: DataFrame) -> dict[str, DataFrame]:
    """The named datasets of the output workbook."""
    kept = consolidated(rows)
    return {"Consolidated files": with_closing_rows(kept), "Senior Rank": senior(kept)}
