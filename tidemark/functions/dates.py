"""Calendar helpers. The fiscal year starts in July."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
OPEN_END = "9999-12-31"


def fiscal_quarter(day: Column) -> Column:
    """``RFYnn-Qk``: half a year later the calendar shows the fiscal year and quarter."""
    shifted = F.add_months(day.cast("date"), 6)
    year = (F.year(shifted) - 2000).cast("string")
    return F.concat(F.lit("RFY"), year, F.lit("-Q"), F.quarter(shifted).cast("string"))


def fiscal_month(month: Column) -> Column:
    """1 for July up to 12 for June."""
    return (F.pmod(month + 5, F.lit(12)) + 1).cast("int")


def period_key(year: Column, month: Column) -> Column:
    """202401 for January 2024."""
    return (year * 100 + month).cast("int")


def period_of(day: Column) -> Column:
    return period_key(F.year(day), F.month(day))


def period_start(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(1))


def registered_month(day: Column) -> Column:
    return F.concat(F.lit("R"), F.date_format(day, "yyyy-MM"))


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def weekday_name(day: Column) -> Column:
    return F.date_format(day.cast("date"), "EEEE")


def minutes_between(start: Column, end: Column) -> Column:
    start, end = start.cast("timestamp"), end.cast("timestamp")
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(60_000_000.0)


def minute_text(moment: Column) -> Column:
    """Timestamp as text without the seconds."""
    return F.date_format(moment, "yyyy-MM-dd HH:mm")


def from_iso(text: Column) -> Column:
    return F.to_timestamp(text, ISO_TIMESTAMP)


def from_pattern(text: Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Patterned text to a timestamp through epoch seconds."""
    return F.unix_timestamp(text, pattern).cast("timestamp")


def excise(country: Column, year: Column) -> Column:
    """Excise factor: one country pays it, and its rate changed after a given year."""
    # Country, last year of the old rate, old rate, new rate.
    taxed_country, last_old_year, old_rate, new_rate = "13", 2022, 1.07, 1.08
    rate = F.when(year <= last_old_year, old_rate).when(year > last_old_year, new_rate)
    return F.coalesce(F.when(country.cast("string") == taxed_country, rate), F.lit(1.0))
