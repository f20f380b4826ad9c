"""Media planner: ratings by channel and title for a requested audience and period."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import dates, documents, nulls
from tidemark.operators import aggregates

# Names a request must carry, in this order, and how far back it may reach.
REQUEST_NAMES = ["date", "sex", "age_group", "social_class"]
REQUEST_DAYS = 30
# Rating column and the label it counts.
SOCIAL_CLASSES = {"rating_upper_class": "Alto", "rating_middle_class": "Medio", "rating_lower_class": "Bajo"}
WEEKDAYS = {
    f"rating_{name.lower()}": name
    for name in ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
}


def parse_requests(documents_df: DataFrame, column: str) -> DataFrame:
    """Request documents as rows: period (put in order), the three audience lists and the names as sent."""
    slicers = F.col("_slicers")
    first, second = (
        dates.from_iso(F.try_element_at(documents.slicer_values(slicers, "date"), F.lit(i))) for i in (1, 2)
    )
    kept = [c for c in documents_df.columns if c != column]
    return documents_df.withColumn("_slicers", documents.parse_slicers(F.col(column), "request")).select(
        *kept,
        documents.slicer_names(slicers).alias("names"),
        F.least(first, second).alias("start"),
        F.greatest(first, second).alias("end"),
        *[documents.slicer_values(slicers, n).alias(n) for n in ("sex", "age_group", "social_class")],
    )


def read_request(spark: SparkSession, text: str) -> DataFrame:
    """One request document."""
    return parse_requests(spark.range(1).select(F.lit(text).alias("document")), "document")


def check_request(request: DataFrame, now: dt.datetime) -> DataFrame:
    """Adds ``names_ok`` (exact names in order) and ``period_ok`` (within the last 30 days)."""
    names = F.array(*[F.lit(n) for n in REQUEST_NAMES])
    oldest = F.lit(now - dt.timedelta(days=REQUEST_DAYS))
    inside = (F.col("start") >= oldest) & (F.col("end") <= F.lit(now))
    return request.withColumns(
        {
            "names_ok": F.coalesce(F.col("names") == names, F.lit(False)),
            "period_ok": F.coalesce(inside, F.lit(False)),
        }
    )


@dataclass(frozen=True)
class Audience:
    """What a planner request selects; both days are included."""

    start: dt.date
    end: dt.date
    sex: list[str]
    age_group: list[str]
    social_class: list[str]

    @staticmethod
    def of(request: DataFrame) -> "Audience":
        """From the single row of :func:`read_request`."""
        row = request.select("start", "end", "sex", "age_group", "social_class").first()
        if row is None or None in tuple(row):
            raise ValueError("the request lacks a period or an audience list")
        return Audience(row.start.date(), row.end.date(), row.sex, row.age_group, row.social_class)


def accepted_audience(request: DataFrame, now: dt.datetime) -> Audience:
    """The audience of a request that passes :func:`check_request`; any other request is refused with its reason."""
    row = check_request(request, now).select("names_ok", "period_ok").first()
    if row is None or not row.names_ok:
        raise ValueError(f"a request has to carry {', '.join(REQUEST_NAMES)} in this order")
    if not row.period_ok:
        raise ValueError(f"the period has to lie within the last {REQUEST_DAYS} days")
    return Audience.of(request)


def audience_factors(sociodemographic: DataFrame, audience: Audience) -> DataFrame:
    """Summed probability per location and social class of the chosen audience."""
    chosen = sociodemographic
    for column in ("age_group", "social_class", "sex"):
        chosen = chosen.where(F.col(column).isin(getattr(audience, column)))
    return chosen.groupBy("id_location", "social_class").agg(F.sum("probability_factor").alias("probability_factor"))


def rating_by_title(main: DataFrame, factors: DataFrame, classes: dict[str, str] = SOCIAL_CLASSES) -> DataFrame:
    """Ratings of each showing, summed by channel and title, in total, by social class and by weekday.

    A location without factors keeps its showing with an unknown class: its rating is null, its class columns are 0.
    """
    showing = ["day", "channel", "epg_start", "epg_end", "epg_title"]
    per_location = main.select(
        dates.weekday_name(F.col("fecha")).alias("day"),
        "channel",
        F.col("timestamp_from").alias("epg_start"),
        F.col("timestamp_to").alias("epg_end"),
        "epg_title",
        "id_location",
        "cable_box_action",
        "cable_box_count",
    )
    factor = F.col("probability_factor")
    showings = (
        per_location.join(factors, "id_location", "left")
        .groupBy(*showing, "social_class")
        .agg(F.sum(F.col("cable_box_action") * factor).alias("actions"), F.sum(F.col("cable_box_count") * factor).alias("boxes"))
    )
    rating = F.col("rating")
    return (
        showings.withColumn("rating", nulls.safe_ratio(F.col("actions"), F.col("boxes"), scale=100))
        .groupBy("channel", "epg_title")
        .agg(
            F.min("epg_start").alias("epg_start"),
            F.min("epg_end").alias("epg_end"),
            F.sum(rating).alias("rating"),
            *aggregates.sums_by_label(rating, F.col("social_class"), classes),
            *aggregates.sums_by_label(rating, F.col("day"), WEEKDAYS),
        )
    )


def per_minute(ratings: DataFrame, classes: dict[str, str] = SOCIAL_CLASSES) -> DataFrame:
    """Ratings divided by the duration of the title in minutes; times without seconds."""
    duration = F.col("epg_duration")

    def normal(source: str, name: str) -> Column:
        return nulls.safe_ratio(F.col(source), duration, digits=2).alias(name)

    return (
        ratings.withColumn("epg_duration", dates.minutes_between(F.col("epg_start"), F.col("epg_end")))
        .select(
            "channel",
            "epg_title",
            dates.minute_text(F.col("epg_start")).alias("epg_start"),
            dates.minute_text(F.col("epg_end")).alias("epg_end"),
            "epg_duration",
            normal("rating", "rating_promedio"),
            *[normal(c, c) for c in (*classes, *WEEKDAYS)],
        )
        .orderBy("channel", "epg_title", "epg_start")
    )


def planner_report(
    main: DataFrame, sociodemographic: DataFrame, audience: Audience, classes: dict[str, str] = SOCIAL_CLASSES
) -> DataFrame:
    """The whole report; ``main`` is read once for all days, so a partition column prunes the scan."""
    days = main.where(F.col("fecha").cast("date").between(audience.start, audience.end))
    return per_minute(rating_by_title(days, audience_factors(sociodemographic, audience), classes), classes)
