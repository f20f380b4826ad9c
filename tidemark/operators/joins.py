"""Joins that need more than ``DataFrame.join``.

Plain lookups use ``DataFrame.join`` directly: Spark broadcasts a side only when its measured size is under
``spark.sql.autoBroadcastJoinThreshold``, sorts and merges otherwise, and AQE splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 16


def salted_join(
    many: DataFrame,
    few: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    how: str = "inner",
    salts: int = SALTS,
    tasks: int | None = None,
) -> DataFrame:
    """Equi join on low-cardinality keys, where each key matches many rows on both sides.

    The rows of a key on the ``many`` side are dealt to ``salts`` tasks by a hash of ``spread_by``; the ``few`` side is
    repeated once per salt. Every pair still meets exactly once. ``how`` is ``inner`` or ``left``. ``tasks`` fixes the
    number of tasks, for rows so few that adaptive execution would merge them although their pairs are many.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"salted_join supports inner and left, not {how}")
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    dealt = many.withColumn("_salt", salt)
    if tasks:
        dealt = dealt.repartition(tasks, *on, "_salt")
    repeated = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(repeated, [*on, "_salt"], how).drop("_salt")


def left_join_many(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """LEFT join to a side with any number of rows per key.

    Adaptive execution splits a skewed right side in an inner join but not in a left one, so the rows with a partner
    and those without are found separately; the latter need the distinct keys only.
    """
    keys = right.select(*on).distinct()
    without = left.join(keys, list(on), "left_anti")
    return left.join(right, list(on)).unionByName(without, allowMissingColumns=True)


def frequent(counts: DataFrame, count: str, share: int = 1000) -> DataFrame:
    """Keys that hold at least one ``share``-th of everything counted: never more than ``share`` rows.

    That bound is what allows broadcasting them.
    """
    total = counts.agg(F.sum(count)).scalar()
    return counts.where(F.col(count) * share >= total)


def frequent_keys(df: DataFrame, keys: Sequence[str], share: int = 1000) -> DataFrame:
    """``keys, _count``: the keys that hold at least one ``share``-th of the rows, never more than ``share`` of them.

    Candidates come from a mergeable summary of frequent items: each task keeps at most 8 ``share`` counters, and only
    these summaries are exchanged. A key of that size cannot be missing from it, as its error is below half a
    ``share``-th (for up to 50,000). Only rows of candidates are then counted exactly, by key.
    """
    tracked = min(1_000_000, 8 * max(share, 16))
    hashed = df.select(*keys, F.xxhash64(*keys).alias("_hash"))
    found = hashed.agg(F.expr(f"approx_top_k(_hash, {min(2 * share, 100_000, tracked)}, {tracked})").alias("_top"))
    candidates = found.select(F.explode("_top").alias("_item")).select(F.col("_item.item").alias("_hash"))
    counts = hashed.join(F.broadcast(candidates), "_hash").groupBy(*keys).agg(F.count("*").alias("_count"))
    rows = df.agg(F.count("*")).scalar()
    return counts.where(F.col("_count") * share >= rows)


def hot_key_lookup(
    many: DataFrame, few: DataFrame, hot: DataFrame, on: Sequence[str], spread_by: Sequence[str], salts: int = 64
) -> DataFrame:
    """Inner lookup in ``few``, unique per key and too large to repeat, with ``hot`` its rows for the frequent keys.

    ``hot`` must be bounded, as :func:`frequent` is; it is broadcast. Rows with such a key have their answer before the
    shuffle and travel under salted keys; all other rows meet ``few`` in a plain equi join.
    """
    values = [c for c in few.columns if c not in on]
    known = hot.select(*on, F.struct(*values).alias("_hot"))
    # always 0, but not a literal: a literal would be folded and the salt would no longer be part of the shuffle key.
    # Being visibly never null, it adds no filter that would keep Spark from reusing the shuffle below ``few``.
    zero = F.coalesce(F.pmod(F.xxhash64(*on), F.lit(1)).cast("int"), F.lit(0))
    rest = few.select(*on, F.struct(*values).alias("_cold"), zero.alias("_salt"))
    spread = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int") + 1
    answered = many.join(F.broadcast(known), list(on), "left").withColumn(
        "_salt", F.when(F.col("_hot").isNotNull(), spread).otherwise(F.lit(0))
    )
    found = F.coalesce("_hot", "_cold")
    return (
        answered.join(rest, [*on, "_salt"], "left")
        .where(found.isNotNull())
        .select(*many.columns, *[found[v].alias(v) for v in values])
    )


def lookup_distinct(
    df: DataFrame,
    key: str,
    answer: Callable[[DataFrame], DataFrame],
    spread_by: Sequence[str],
    counted: DataFrame | None = None,
    salts: int = 64,
) -> DataFrame:
    """LEFT lookup whose answers are made once for each different ``key``, not for each row.

    ``answer`` gets ``key, _count`` with a row for each key and returns ``key`` and its values: for all keys with the
    count beside them, or without it for some. The keys are those of ``counted``, ``df`` if not given: what ``df`` was made
    from saves making it twice. Null keys have no answer. Answers of frequent keys are broadcast (see :func:`frequent`),
    and their rows and those without a key are spread by ``spread_by``, as in :func:`hot_key_lookup`.
    """
    counts = (df if counted is None else counted).where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_count"))
    answers = answer(counts)
    values = [c for c in answers.columns if c not in (key, "_count")]
    # both sides are grouped by key already
    few = answers if "_count" in answers.columns else counts.join(answers, key, "left")
    packed = F.struct(*[F.col(f"`{v}`") for v in values])
    hot = F.broadcast(frequent(few, "_count").select(key, packed.alias("_hot")))
    zero = F.coalesce(F.pmod(F.xxhash64(key), F.lit(1)).cast("int"), F.lit(0))
    rest = few.select(key, packed.alias("_cold"), zero.alias("_salt"))
    spread = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int") + 1
    settled = F.col("_hot").isNotNull() | F.col(key).isNull()
    answered = df.join(hot, key, "left").withColumn("_salt", F.when(settled, spread).otherwise(F.lit(0)))
    found = F.coalesce("_hot", "_cold")
    return answered.join(rest, [key, "_salt"], "left").select(*df.columns, *[found[v].alias(v) for v in values])


def prefix_lookup(
    df: DataFrame, networks: DataFrame, address: Column, key: str, spread_by: Sequence[str], counted: DataFrame | None = None
) -> DataFrame:
    """LEFT lookup of 128-bit addresses in networks: the longest prefix that contains the address wins.

    ``networks`` has ``length, high, low`` and values, unique by these three; bits behind the length are zero.
    ``address`` is the address in column ``key`` as ``high, low``. Each different address meets its prefix of every length
    that occurs in one equi join, so a popular client costs no more than others there; adaptive execution copies a
    network only if so many addresses lie in it that its partition is skewed. The answers come back to the rows by
    :func:`lookup_distinct`.
    """
    values = [c for c in networks.columns if c not in ("length", "high", "low")]
    # 129 lengths at most
    lengths = networks.agg(F.collect_set("length")).scalar()

    def prefix(length: Column) -> Column:
        def masked(half: str, bits: Column) -> Column:
            mask = F.when(bits >= 64, F.lit(-1).cast("long")).when(bits <= 0, F.lit(0).cast("long"))
            mask = mask.otherwise(F.call_function("shiftleft", F.lit(-1).cast("long"), 64 - bits))
            return F.col(f"_at.{half}").bitwiseAND(mask).alias(half)

        return F.struct(length.alias("length"), masked("high", length), masked("low", length - 64))

    def places(distinct: DataFrame) -> DataFrame:
        cut = distinct.select(key, address.alias("_at"), lengths.alias("_lengths"))
        cut = cut.select(key, F.explode(F.transform("_lengths", prefix)).alias("_prefix")).select(key, "_prefix.*")
        within = networks.select("length", "high", "low", F.struct("length", *values).alias("_network"))
        found = cut.join(within, ["length", "high", "low"]).groupBy(key)
        found = found.agg(F.max_by("_network", "_network.length").alias("_network"))
        return found.select(key, *[F.col("_network")[v].alias(v) for v in values])

    return lookup_distinct(df, key, places, spread_by, counted)
