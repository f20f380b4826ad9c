"""Row cleaning and previews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drop_empty_rows(df: DataFrame) -> DataFrame:
    """Removes rows in which every column is null."""
    return df.na.drop(how="all")


def repeat_rows(df: DataFrame, times: Column, key: Sequence[str], most: int = 1 << 20) -> DataFrame:
    """Every row as often as ``times`` says.

    A row with a very large count is first cut into pieces of at most ``most`` copies, and the pieces are dealt over the
    tasks, so that no task writes out a large share of the result. The number of tasks is set: before the rows are
    repeated they look small, and adaptive execution would merge them into a few tasks.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = F.sequence(F.lit(0).cast("long"), F.expr(f"(_times - 1) div {most}"))
    dealt = (
        df.withColumn("_times", times.cast("long"))
        .where(F.col("_times") > 0)
        .withColumn("_piece", F.explode(pieces))
        .repartition(tasks, *[F.col(f"`{k}`") for k in key], "_piece")
    )
    copies = F.least(F.lit(most), F.col("_times") - F.col("_piece") * most)
    return dealt.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), copies))).drop(
        "_times", "_piece", "_copy"
    )


def preview(df: DataFrame, n: int = 10, order: Sequence[Column | str] = ()) -> DataFrame:
    """First ``n`` rows; repeatable when an order is given."""
    return (df.orderBy(*order) if order else df).limit(n)


def last_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """Last ``n`` rows of an order, ascending."""
    tail = df.orderBy(*[F.col(c).desc() for c in order]).limit(n)
    return tail.orderBy(*order)
