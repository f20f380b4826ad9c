"""Balanced operators against the plain ones, with one key holding a third of all rows."""

from __future__ import annotations

import ipaddress
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions import network
from tidemark.operators import joins, windows
from tidemark.operators import rows as row_ops


@pytest.fixture(scope="module")
def skewed(spark):
    """600 rows: a third under key 1, a few without key, the rest spread over 40 keys."""
    key = F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 50 != 7, F.col("id") % 40 + 2)
    return spark.range(600).select(
        key.alias("k"),
        ((F.col("id") * 37) % 600).alias("seq"),
        F.when(F.col("id") % 11 != 0, F.col("id") % 9).cast("int").alias("quantity"),
        F.when(F.col("id") % 4 != 0, F.concat(F.lit("v"), F.col("id"))).alias("v"),
    )


@pytest.mark.parametrize("share", [1, 20, 100_000])
def test_lag_equals_plain_window(skewed, rows, share):
    plain = skewed.withColumns(
        {c: F.lag(s).over(Window.partitionBy("k").orderBy("seq")) for s, c in {"v": "pv", "quantity": "pq"}.items()}
    )
    cut = windows.previous_within(skewed, ["k"], "seq", {"v": "pv", "quantity": "pq"}, width=16, share=share)
    assert cut.columns == plain.columns
    assert rows(cut) == rows(plain)


@pytest.mark.parametrize("share", [1, 20, 100_000])
def test_row_number_equals_plain_window(skewed, rows, share):
    order = [F.col("quantity").desc_nulls_last(), F.col("seq").asc()]
    group = Window.partitionBy("k")
    plain = skewed.withColumns(
        {"rn": F.row_number().over(group.orderBy(*order)), "n": F.count("*").over(group)}
    )
    chunk = [-F.col("quantity"), F.floor(F.col("seq") / 50)]
    cut = windows.number_within(skewed, ["k"], order, chunk, "rn", "n", share=share)
    assert rows(cut) == rows(plain)


def test_no_chunk_is_larger_than_its_width(skewed):
    cut = windows._cut_frequent_keys(skewed, ["k"], {"_chunk": F.floor(F.col("seq") / 16)}, share=20)
    sizes = cut.where("_frequent").groupBy("k", "_chunk").count()
    assert sizes.agg(F.max("count")).first()[0] <= 16
    assert cut.where("k = 1").select("_frequent").distinct().collect() == [(True,)]


def test_group_size_counts_null_keys(skewed, rows):
    plain = skewed.withColumn("n", F.count("*").over(Window.partitionBy("k")))
    assert rows(windows.with_group_size(skewed, ["k"], ["seq"], "n")) == rows(plain)


def test_keep_top_orders_within_the_key(spark, rows):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("a", 2), ("b", 9)], "k string, v int")
    assert rows(windows.keep_top(df, ["k"], [F.col("v").desc()], 2)) == [("a", 2), ("a", 3), ("b", 9)]
    assert rows(windows.keep_first(df, ["k"], [F.col("v").asc()])) == [("a", 1), ("b", 9)]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join(skewed, spark, rows, how):
    few = spark.createDataFrame([(1, "x"), (1, "y"), (5, "z")], "k bigint, w string")
    plain = skewed.join(few, "k", how)
    salted = joins.salted_join(skewed, few, ["k"], ["seq"], how)
    assert rows(salted, "k", "seq", "w") == rows(plain, "k", "seq", "w")


def test_left_join_many_equals_left_join(skewed, spark, rows):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (999, "c"), (None, "d")], "k bigint, name string")
    right = skewed.select("k", "seq")
    found = joins.left_join_many(left, right, ["k"])
    assert rows(found, "k", "name", "seq") == rows(left.join(right, "k", "left"), "k", "name", "seq")


def test_salted_join_refuses_other_kinds(skewed):
    with pytest.raises(ValueError):
        joins.salted_join(skewed, skewed, ["k"], ["seq"], "full")


def test_salt_spreads_a_hot_key(skewed):
    salt = F.pmod(F.xxhash64("seq"), F.lit(joins.SALTS))
    assert skewed.where("k = 1").select(salt).distinct().count() == joins.SALTS


def test_hot_key_lookup_equals_plain_join(skewed, rows):
    few = skewed.where("k is not null").groupBy("k").agg(F.count("*").alias("n"))
    hot = joins.frequent(few, "n", share=10)
    assert [r.k for r in hot.collect()] == [1]
    found = joins.hot_key_lookup(skewed, few, hot, ["k"], ["seq"])
    assert rows(found, "k", "seq", "n") == rows(skewed.join(few, "k"), "k", "seq", "n")


def test_salt_of_hot_key_lookup_stays_in_the_shuffle_key(skewed, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = skewed.where("k is not null").groupBy("k").agg(F.count("*").alias("n"))
        found = joins.hot_key_lookup(skewed, few, joins.frequent(few, "n", 10), ["k"], ["seq"])
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    merges = [line for line in plan.splitlines() if "SortMergeJoin" in line]
    assert merges and all("_salt" in line for line in merges)


def test_frequent_is_bounded(spark):
    counts = spark.range(500).select("id", F.lit(1).alias("n"))
    assert joins.frequent(counts, "n", share=10).count() == 0
    assert joins.frequent(counts, "n", share=500).count() == 500


def brute_place(address, ranges):
    """The name of the smallest range that holds the address."""
    try:
        asked = ipaddress.ip_address(address.split("%")[0])
    except (ValueError, AttributeError):
        return None
    holding = []
    for start, end, name in ranges:
        ends = [ipaddress.ip_address(int(x) if x.isdecimal() else x) for x in (start, end)]
        if ends[0].version == asked.version and ends[0] <= asked <= ends[1]:
            holding.append((int(ends[1]) - int(ends[0]), name))
    return min(holding)[1] if holding else None


def test_prefix_lookup_of_both_kinds_of_addresses(spark, rows):
    ranges = [
        ("0", "9", "a"), ("10", "65535", "b"), ("65536", "200000", "c"), ("4294967290", "4294967295", "z"),
        ("2001:db8::", "2001:db8::ffff", "d"), ("2001:db8::1:0", "2001:db8:ffff::5", "e"), ("8000::", "ffff:ffff::", "high"),
        ("::", "::ff", "low"), ("10.0.0.0", "10.255.255.255", "ten"), ("10.1.0.0", "10.1.255.255", "inner"),
    ]
    blocks = spark.createDataFrame(
        [*ranges, ("9", "1", "turned"), ("x", "5", "bad"), ("1.0.0.0", "::5", "mixed"), (None, "1", "none")],
        "start_ip string, end_ip string, name string",
    )
    asked = ["0.0.0.0", "0.0.0.9", "0.0.0.10", "0.1.0.0", "0.3.13.64", "0.3.13.65", "255.255.255.249", "255.255.255.250",
             "10.0.0.1", "10.1.0.1", "10.2.0.0", "2001:db8::", "2001:DB8:0:0:0:0:0:ffff", "2001:db8::1:0", "2001:db8:ffff::5",
             "2001:db8:ffff::6", "2001:db8:1234:5678:9abc:def0:1234:5678", "::", "::1", "::ff", "::100", "8000::1", "ffff:ffff::1",
             "::ffff:1.2.3.4", "fe80::1%eth0", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "1:2:3:4:5:6:1.2.3.4", "", "-", "1.2.3", "1:2:3",
             "1::2::3", ":::", "12345::", "256.1.1.1", "1:2:3:4:5:6:7:8:9", "g::", None]
    df = spark.createDataFrame([(v, n) for n, v in enumerate([*asked, *["10.1.2.3"] * 40])], "v string, n int")
    networks = network.networks_of(blocks)
    found = joins.prefix_lookup(df, networks, network.ip_to_halves(F.col("v")), "v", ["n"])
    # a mapped address is the IPv4 address
    expected = {v: brute_place("1.2.3.4" if v == "::ffff:1.2.3.4" else v, ranges) for v in asked}
    assert {r["v"]: r["name"] for r in found.where("n < 39").collect()} == expected
    assert found.where("name = 'inner'").count() == 41
    none = joins.prefix_lookup(df, networks.limit(0), network.ip_to_halves(F.col("v")), "v", ["n"])
    assert none.where("name IS NULL").count() == len(asked) + 40


def test_ranges_become_the_fewest_networks(spark):
    rng = random.Random(6)
    ranges = [(rng.getrandbits(128), rng.getrandbits(128)) for _ in range(50)] + [(0, 2**128 - 1), (5, 5), (2**127, 2**128 - 1)]
    for first, last in (tuple(sorted(r)) for r in ranges):
        cut = list(network._prefixes(first, last))
        plain = ipaddress.summarize_address_range(ipaddress.IPv6Address(first), ipaddress.IPv6Address(last))
        assert cut == [(int(n.network_address), n.prefixlen) for n in plain]


def test_prefix_lookup_is_an_equi_join(spark):
    networks = spark.createDataFrame([(96, 0, 0, "a")], "length int, high long, low long, name string")
    df = spark.range(5).select(F.col("id").cast("string").alias("v"))
    found = joins.prefix_lookup(df, networks, network.ip_to_halves(F.col("v")), "v", ["v"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_frequent_keys_are_found_without_grouping_all_rows(spark, rows):
    keys = F.when(F.col("id") % 3 == 0, F.lit(-1)).when(F.col("id") % 7 == 0, None).otherwise(F.col("id"))
    df = spark.range(60_000).repartition(6).select(keys.alias("k"), (F.col("id") % 2).alias("part"))
    exact = df.groupBy("k", "part").count().where("count * 50 >= 60000")
    found = joins.frequent_keys(df, ["k", "part"], share=50)
    assert rows(found) == rows(exact) and found.count() == 4
    plan = joins.frequent_keys(df, ["k", "part"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_approx_top_k" in plan and plan.count("hashpartitioning") == 1
    assert joins.frequent_keys(df.limit(0), ["k"]).count() == 0


def test_repeated_rows_are_dealt_in_pieces(spark, rows):
    df = spark.createDataFrame([("a", 25), ("b", 1), ("c", 0), ("d", None)], "k string, n int")
    repeated = row_ops.repeat_rows(df, F.col("n"), ["k"], most=4)
    assert rows(repeated.groupBy("k", "n").count()) == [("a", 25, 25), ("b", 1, 1)]
    per_task = repeated.where("k = 'a'").groupBy(F.spark_partition_id()).count()
    assert per_task.count() > 1
