"""Addresses of both kinds as 128-bit numbers: two 64-bit halves, IPv4 as ``::ffff:a.b.c.d``."""

from __future__ import annotations

import ipaddress
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

GROUPS = "(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4})*)"
MAPPED = 0xFFFF << 32
HALF = (1 << 64) - 1


def ip_to_long(text: Column) -> Column:
    """Dotted IPv4 text to its number; null for anything else."""
    octet = [F.split_part(text, F.lit("."), F.lit(i + 1)).try_cast("long") for i in range(4)]
    number = octet[0] * (1 << 24) + octet[1] * (1 << 16) + octet[2] * (1 << 8) + octet[3]
    valid = text.rlike(r"^[0-9]{1,3}([.][0-9]{1,3}){3}$")
    for value in octet:
        valid = valid & (value <= 255)
    return F.when(valid, number)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def ip_to_halves(text: Column) -> Column:
    """``high, low`` of an address of either kind, null for anything else. A zone behind ``%`` does not count."""
    nothing = F.lit(None).cast("struct<high:bigint,low:bigint>")

    def halves(high: Column, low: Column) -> Column:
        return F.struct(high.cast("long").alias("high"), low.cast("long").alias("low"))

    def number(groups: Column, first: int) -> Column:
        joined = F.array_join(F.transform(F.slice(groups, first, 4), lambda g: F.lpad(g, 4, "0")), "")
        # to a signed number: half of the digits at a time
        return F.shiftleft(F.conv(F.left(joined, F.lit(8)), 16, 10).cast("long"), 32).bitwiseOR(
            F.conv(F.right(joined, F.lit(8)), 16, 10).cast("long")
        )

    def written_out(plain: Column) -> Column:
        """The last two groups may be written as an IPv4 address."""

        def replaced(tail: Column) -> Column:
            last = ip_to_long(tail)
            groups = F.concat(F.hex(F.shiftright(last, 16)), F.lit(":"), F.hex(last.bitwiseAND(0xFFFF)))
            return F.when(tail == "", plain).otherwise(F.concat(F.left(plain, F.char_length(plain) - F.char_length(tail)), groups))

        return _let(F.regexp_extract(plain, r":([0-9]{1,3}(?:[.][0-9]{1,3}){3})$", 1), replaced)

    def six(whole: Column) -> Column:
        def sides(left: Column, right: Column) -> Column:
            missing = 8 - F.size(left) - F.size(right)
            full = F.concat(left, F.array_repeat(F.lit("0"), F.greatest(missing, F.lit(0))), right)
            fits = F.when(F.contains(whole, F.lit("::")), missing > 0).otherwise(missing == 0)
            return F.when(fits, _let(full, lambda groups: halves(number(groups, 1), number(groups, 5))))

        def side(i: int) -> Column:
            return F.filter(F.split(F.split_part(whole, F.lit("::"), F.lit(i)), ":"), lambda g: g != "")

        valid = whole.rlike(f"^{GROUPS}$|^{GROUPS}?::{GROUPS}?$")
        return F.when(valid, _let(side(1), lambda left: _let(side(2), lambda right: sides(left, right))))

    def either(plain: Column) -> Column:
        four = ip_to_long(plain)
        return F.when(four.isNotNull(), halves(F.lit(0), four.bitwiseOR(F.lit(MAPPED)))).when(
            F.contains(plain, F.lit(":")), _let(written_out(plain), six)
        )

    return F.coalesce(_let(F.split_part(text, F.lit("%"), F.lit(1)), either), nothing)


def _prefixes(start: int, end: int) -> Iterator[tuple[int, int]]:
    """The fewest networks, as first address and length, that make up a range of addresses."""
    while start <= end:
        free = (start & -start).bit_length() - 1 if start else 128
        free = min(free, (end - start + 1).bit_length() - 1)
        yield start, 128 - free
        start += 1 << free


def networks_of(blocks: DataFrame, start: str = "start_ip", end: str = "end_ip") -> DataFrame:
    """Ranges of addresses as networks: ``length, high, low`` and the other columns of ``blocks``.

    The ends are included; they are texts of either kind, or numbers of IPv4 addresses. A range becomes at most 254
    networks. Ranges without a valid end, or whose ends are of two kinds or in the wrong order, are left out.
    """
    values = [c for c in blocks.columns if c not in (start, end)]
    given = blocks.select(F.col(start).cast("string").alias(start), F.col(end).cast("string").alias(end), *values)
    added = [T.StructField("length", T.IntegerType()), T.StructField("high", T.LongType()), T.StructField("low", T.LongType())]
    schema = T.StructType([*added, *[blocks.schema[v] for v in values]])

    def number(text: str) -> tuple[int, int]:
        found = ipaddress.ip_address(int(text) if text.isdecimal() else text.split("%")[0])
        return found.version, int(found) | (MAPPED if found.version == 4 else 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, cut = [], []
            for i, ends in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                try:
                    (kind, first), (other, last) = map(number, ends)
                except (ValueError, AttributeError):
                    continue
                for address, length in _prefixes(first, last) if kind == other else ():
                    rows.append(i)
                    halves = (address >> 64, address & HALF)
                    cut.append((length, *(h - (1 << 64) if h >> 63 else h for h in halves)))
            if cut:
                kept = [batch.column(2 + n).take(pa.array(rows)) for n in range(len(values))]
                numbers = [pa.array(c, t) for c, t in zip(zip(*cut), (pa.int32(), pa.int64(), pa.int64()))]
                yield pa.RecordBatch.from_arrays([*numbers, *kept], names=schema.names)

    return given.mapInArrow(run, schema)
