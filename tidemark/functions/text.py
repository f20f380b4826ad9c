"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Comments that carry no opinion.
NOISE_COMMENTS = ["na", "??", ".", "...", ""]
# Every kind of ASCII white space.
WHITE = " \t\n\r\f\v"


def full_name(first: Column, last: Column) -> Column:
    """``first last``; the first name alone when there is no last name; null without a first name."""
    return F.when(last.isNull(), first).otherwise(F.concat(first, F.lit(" "), last))


def key_of(*parts: Column, sep: str = "") -> Column:
    """Concatenated key; null as soon as one part is null, so such a key never matches."""
    pieces = []
    for part in parts:
        if pieces and sep:
            pieces.append(F.lit(sep))
        pieces.append(part.cast("string"))
    return F.concat(*pieces)


def key_with_blanks(*parts: Column, sep: str = "") -> Column:
    """Concatenated key in which a null part counts as empty text."""
    return key_of(*[F.coalesce(part.cast("string"), F.lit("")) for part in parts], sep=sep)


def is_noise(comment: Column) -> Column:
    return F.lower(F.btrim(comment, F.lit(WHITE))).isin(NOISE_COMMENTS)


def file_stem(name: Column) -> Column:
    """File name without folder and without everything from the first dot on."""
    return F.regexp_replace(F.regexp_extract(name, "([^/]*)$", 1), "\\..*$", "")


def zero_padded(value: Column, width: int) -> Column:
    return F.lpad(value.cast("string"), width, "0")
