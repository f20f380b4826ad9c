"""Window functions that stay balanced when one key holds a large share of the rows.

A plain ``row_number`` or ``lag`` sorts all rows of a key in one task. Here the rows of every frequent key are cut into
chunks along the order, each chunk is sorted on its own, and one small marker row per chunk carries what the chunk
needs to know of the others. Markers travel in the same shuffle as the rows, so there is no second join, and null keys
behave as in a plain window. All other keys form a single chunk and need no marker. Whether a key counts as frequent
only decides how the work is split, never the result.

The input is read more than once, so it should be a scan or a written table rather than a long plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import joins

# A key counts as frequent when it holds at least this fraction (one in SHARE) of all rows.
SHARE = 1000


def _cut_frequent_keys(df: DataFrame, keys: Sequence[str], chunk: dict[str, Column], share: int) -> DataFrame:
    """Adds ``_frequent`` and the chunk columns, which stay null for all other keys."""
    # at most ``share`` rows
    found = joins.frequent_keys(df, keys, share)
    frequent = F.broadcast(found.select(*[F.col(k).alias(f"_key_{k}") for k in keys], "_count"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    is_frequent = F.col("_count").isNotNull()
    parts = {name: F.when(is_frequent, value) for name, value in chunk.items()}
    return df.join(frequent, same, "left").select(
        *df.columns, is_frequent.alias("_frequent"), *[value.alias(name) for name, value in parts.items()]
    )


def number_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    chunk: Sequence[Column],
    number: str = "rn",
    size: str | None = None,
    share: int = SHARE,
) -> DataFrame:
    """``row_number`` over ``keys`` in ``order``, optionally with the group size.

    ``chunk`` holds coarse versions of the order, ascending along it (nulls last): rows of an earlier chunk must all come
    before the rows of a later one.
    """
    parts = {f"_chunk{i}": value for i, value in enumerate(chunk)}
    rows = _cut_frequent_keys(df, keys, parts, share)
    counted = rows.where("_frequent").groupBy(*keys, *parts).agg(F.count("*").alias("_rows"))
    in_group = Window.partitionBy(*keys)
    along = in_group.orderBy(*[F.col(p).asc_nulls_last() for p in parts])
    markers = counted.select(
        *keys,
        *parts,
        (F.sum("_rows").over(along) - F.col("_rows")).alias("_before"),
        F.sum("_rows").over(in_group).alias("_size"),
        F.lit(0).alias("_is_row"),
    )
    together = rows.withColumn("_is_row", F.lit(1)).unionByName(markers, allowMissingColumns=True)
    whole = Window.partitionBy(*keys, *parts)
    local = whole.orderBy("_is_row", *order)
    # the marker comes first in its chunk, so a running maximum hands its values to every row
    position = F.sum("_is_row").over(local.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    numbered = together.withColumns(
        {
            "_number": position + F.coalesce(F.max("_before").over(local), F.lit(0)),
            "_total": F.coalesce(F.max("_size").over(local), F.sum("_is_row").over(whole)),
        }
    )
    columns = [*df.columns, F.col("_number").cast("int").alias(number)]
    if size:
        columns.append(F.col("_total").alias(size))
    return numbered.where(F.col("_is_row") == 1).select(*columns)


def previous_within(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    values: dict[str, str],
    width: int = 1 << 20,
    share: int = SHARE,
) -> DataFrame:
    """``lag`` over ``keys`` along the unique integer column ``order``; ``values`` maps source to output column.

    A chunk spans ``width`` consecutive order values and so holds at most that many rows.
    """
    rows = _cut_frequent_keys(df, keys, {"_chunk": F.expr(f"`{order}` div {width}")}, share)
    last = rows.where("_frequent").groupBy(*keys, "_chunk").agg(
        F.max(order).alias(order), *[F.max_by(value, order).alias(value) for value in values]
    )
    next_chunk = F.lead("_chunk").over(Window.partitionBy(*keys).orderBy("_chunk"))
    markers = last.withColumn("_chunk", next_chunk).where(F.col("_chunk").isNotNull())
    along = Window.partitionBy(*keys, "_chunk").orderBy(order)
    lagged = {out: F.lag(source).over(along) for source, out in values.items()}
    return (
        rows.withColumn("_is_row", F.lit(True))
        .unionByName(markers.withColumn("_is_row", F.lit(False)), allowMissingColumns=True)
        .withColumns(lagged)
        .where("_is_row")
        .select(*df.columns, *values.values())
    )


def with_group_size(
    df: DataFrame, keys: Sequence[str], spread_by: Sequence[str], size: str, salts: int = 64, share: int = SHARE
) -> DataFrame:
    """``count(*)`` over ``keys``: counted with partial results, then brought back to the rows.

    Only the counts of frequent keys are copied, once for each of ``salts`` tasks, to which their rows are dealt by a hash
    of ``spread_by``. Null keys form a group, as in a window.
    """
    of_key = [F.col(k).alias(f"_key_{k}") for k in keys]
    counts = df.groupBy(*of_key).agg(F.count("*").alias(size))
    rows = df.agg(F.count("*")).scalar()
    is_frequent = F.col(size) * share >= rows
    copies = F.explode(F.when(is_frequent, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0))))
    counts = counts.withColumn("_salt", copies)
    dealt = _cut_frequent_keys(df, keys, {"_deal": F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")}, share)
    same = F.coalesce("_deal", F.lit(0)) == F.col("_salt")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    return dealt.join(counts, same).select(*df.columns, size)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key. Catalyst keeps only the best row per key before the shuffle, so hot keys are cheap."""
    return keep_top(df, keys, order, 1)


def keep_top(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each key."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rank") <= n).drop("_rank")
