"""Null handling, guarded ratios and tolerant casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


DECIMAL = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def null_default(value: Column, default) -> Column:
    return F.coalesce(value, F.lit(default))


def differs_keeping_null(value: Column, other) -> Column:
    """``value != other`` where a null value counts as different (a plain ``!=`` would drop the row)."""
    return ~value.eqNullSafe(F.lit(other))


def is_number_between(text: Column, low: int, high: int) -> Column:
    """Range test on numbers stored as text; text that is no number is never inside."""
    return text.try_cast("int").between(low, high)


def safe_ratio(numerator: Column, denominator: Column, digits: int | None = None, scale: float = 1) -> Column:
    """``numerator / denominator * scale``; null when the denominator is 0 or null."""
    ratio = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    if scale != 1:
        ratio = ratio * F.lit(float(scale))
    return ratio if digits is None else F.round(ratio, digits)


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, 1).otherwise(0)


def as_number(text: Column) -> Column:
    """Text to double; anything but a plain decimal number (``nan``, ``5d``, words) becomes null."""
    trimmed = F.btrim(text, F.lit(" \t\n\r\f\v"))
    return F.when(trimmed.rlike(DECIMAL), trimmed.try_cast("double"))
