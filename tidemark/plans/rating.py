"""Audience rating per minute and channel, reported on request."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import nulls
from tidemark.operators import aggregates

DAY = ["year", "month", "day"]
MINUTE = [*DAY, "hour", "minute"]
# Fixed value: text for a request that meets no data.
NO_DATA = "sin datos"


def _integers(df: DataFrame, columns: list[str]) -> DataFrame:
    """Numbers stored as text become integers, text that is no number becomes null."""
    return df.withColumns({c: F.col(c).cast("string").try_cast("int") for c in columns})


def requested_days(request: DataFrame) -> DataFrame:
    """The calendar days a request asks for. The range check also tells Spark that the set is worth pruning with."""
    days = _integers(request.select(*DAY), DAY).distinct()
    return days.where(F.col("month").between(1, 12) & F.col("day").between(1, 31))


def rating_by_minute(viewing: DataFrame, location: str | None = None) -> DataFrame:
    """Weighted viewers over the number of boxes; null when there are no boxes."""
    if location is not None:
        viewing = viewing.where(F.col("location") == location)
    boxes = viewing.groupBy(*MINUTE, "channel", "channel_number").agg(
        aggregates.weighted_sum(F.col("mac_addr_channel"), F.col("location_weight")).alias("viewers"),
        # a location may report its number of boxes more than once
        F.max("deco_count").alias("boxes"),
    )
    rating = nulls.safe_ratio(F.col("viewers"), F.col("boxes"), digits=3)
    return _integers(boxes, MINUTE).select(*MINUTE, "channel", "channel_number", rating.alias("rating"))


def rating_report(
    request: DataFrame, viewing: DataFrame, location: str | None = None, carry: Sequence[str] = ()
) -> DataFrame:
    """The requested minutes and channels with their rating; what has no data keeps a default.

    Days nobody asked for are cut away before the aggregation by a semi join on the partition columns, which
    prunes the scan of a date-partitioned table at run time. ``carry`` names request columns to keep, for example the
    report a row belongs to.
    """
    asked = _integers(request.select(*carry, *MINUTE, "channel_number"), MINUTE)
    days = requested_days(request)
    on_asked_day = [viewing[c].cast("int") == days[c] for c in DAY]
    rated = rating_by_minute(viewing.join(days, on_asked_day, "left_semi"), location)
    return (
        asked.join(rated, [*MINUTE, "channel_number"], "left")
        .select(
            *carry,
            *MINUTE,
            nulls.null_default(F.col("channel_number"), NO_DATA).alias("channel_number"),
            nulls.null_default(F.col("channel"), NO_DATA).alias("channel"),
            F.round(nulls.null_default(F.col("rating"), 0.0).cast("float"), 3).alias("rating"),
        )
        .orderBy(*carry, *[F.col(c).asc() for c in MINUTE], F.col("rating").desc())
    )


def channel_list(viewing: DataFrame, run_date: dt.date) -> DataFrame:
    """Distinct channels of the day before the run."""
    day = run_date - dt.timedelta(days=1)
    of_day = viewing
    for name, value in zip(DAY, (day.year, day.month, day.day)):
        of_day = of_day.where(F.col(name).cast("int") == value)
    return of_day.select("channel", "channel_number").distinct().orderBy("channel", "channel_number")
