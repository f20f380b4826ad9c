"""Single table operators over the test tables, each with its SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bindings.registry import query
from bindings.reports import REQUEST
from bindings.staging import staging, table, with_staging
from tidemark.functions import agents, dates, documents, nulls, text
from tidemark.operators import aggregates, joins, rows, sets, windows
from tidemark.plans import planner

RUN_DATE = dt.date(2001, 8, 2)

# ---------------------------------------------------------------- projections, filters, predicates


@query(
    "p01_projection",
    """SELECT o_orderdate AS ordered_on, o_orderkey AS order_id, 'web' AS origin, CAST(NULL AS VARCHAR) AS remark,
    o_totalprice * 0.9e0 AS net_price FROM orders""",
)
def _projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rename, reorder, constant, typed null and derived column."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").alias("ordered_on"),
        F.col("o_orderkey").alias("order_id"),
        F.lit("web").alias("origin"),
        (F.col("o_totalprice") * 0.9).alias("net_price"),
    )
    return sets.add_typed_nulls(orders, {"remark": "string"})


@query("p02_star_plus", "SELECT c.*, c_acctbal * 2 AS doubled FROM customer c")
def _star_plus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").alias("c").select("c.*", (F.col("c.c_acctbal") * 2).alias("doubled"))


@query(
    "p06_drop_empty_rows",
    """SELECT low, segment, 'file' AS origin FROM (SELECT CASE WHEN c_acctbal < 2000 THEN c_acctbal END AS low,
    CASE WHEN c_mktsegment = 'BUILDING' THEN c_mktsegment END AS segment FROM customer)
    WHERE low IS NOT NULL OR segment IS NOT NULL""",
)
def _drop_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Empty rows go before the constant is added."""
    sparse = table(spark, sf_dir, "customer").select(
        F.when(F.col("c_acctbal") < 2000, F.col("c_acctbal")).alias("low"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_mktsegment")).alias("segment"),
    )
    return rows.drop_empty_rows(sparse).withColumn("origin", F.lit("file"))


@query(
    "p07_filters",
    """SELECT * FROM orders WHERE o_orderstatus <> 'P' AND o_totalprice > 1000
    AND MONTH(o_orderdate) BETWEEN 4 AND 9 AND o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
    AND o_orderpriority LIKE '%E%' AND o_orderpriority NOT LIKE '%DIUM' AND o_orderdate IS NOT NULL""",
)
def _filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority = F.col("o_orderpriority")
    return table(spark, sf_dir, "orders").where(
        (F.col("o_orderstatus") != "P")
        & (F.col("o_totalprice") > 1000)
        & F.month("o_orderdate").between(4, 9)
        & priority.isin("1-URGENT", "2-HIGH", "3-MEDIUM")
        & priority.like("%E%")
        & ~priority.like("%DIUM")
        & F.col("o_orderdate").isNotNull()
    )


@query(
    "p08_not_equal_keeping_null",
    with_staging(["workbook"], """SELECT * FROM st_workbook WHERE "Rank" IS DISTINCT FROM 'Unknown'"""),
)
def _ne_keep_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging(spark, sf_dir, "workbook").where(nulls.differs_keeping_null(F.col("Rank"), "Unknown"))


@query(
    "p09_between_on_text",
    with_staging(
        ["weblog"], """SELECT * FROM st_weblog WHERE TRY_CAST("HttpStatus" AS INT) BETWEEN 200 AND 299"""
    ),
)
def _between_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging(spark, sf_dir, "weblog").where(nulls.is_number_between(F.col("HttpStatus"), 200, 299))


@query(
    "p12_lists_of_request",
    with_staging(
        ["sociodemographic"],
        """SELECT * FROM st_sociodemographic WHERE age_group IN ('MACHINERY', 'BUILDING', 'FURNITURE')
        AND social_class IN ('Medio', 'Alto') AND sex IN ('1')""",
    ),
)
def _lists_of_request(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Membership in the three lists of a request, by semi joins on the lists."""
    request = planner.read_request(spark, REQUEST)
    chosen = staging(spark, sf_dir, "sociodemographic")
    for name in ("age_group", "social_class", "sex"):
        chosen = chosen.join(request.select(F.explode(name).alias(name)), name, "left_semi")
    return chosen


@query(
    "p17_case_forms",
    """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'mid' ELSE 'high' END AS band,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'B' WHEN 'MACHINERY' THEN 'M' END AS code,
    COALESCE(CASE WHEN c_acctbal >= 0 THEN c_acctbal END, 0) AS balance,
    c_acctbal / NULLIF(c_nationkey, 0) AS per_nation, GREATEST(c_acctbal, 100) AS top,
    LEAST(c_acctbal, 100) AS low FROM customer""",
)
def _case_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance, segment = F.col("c_acctbal"), F.col("c_mktsegment")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(balance < 0, "debt").when(balance < 5000, "mid").otherwise("high").alias("band"),
        F.when(segment == "BUILDING", "B").when(segment == "MACHINERY", "M").alias("code"),
        nulls.null_default(F.when(balance >= 0, balance), 0).alias("balance"),
        nulls.safe_ratio(balance, F.col("c_nationkey")).alias("per_nation"),
        F.greatest(balance, F.lit(100)).alias("top"),
        F.least(balance, F.lit(100)).alias("low"),
    )


# ---------------------------------------------------------------- joins


@query(
    "j01_star_of_lookups",
    """SELECT o_orderkey, c_name, n_name, r_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def _star(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer, nation, region = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation", "region"))
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select("o_orderkey", "c_name", "n_name", "r_name")
    )


@query(
    "j02_inner_join",
    """SELECT l_orderkey, l_linenumber, l_partkey, o_orderdate, o_custkey FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey""",
)
def _inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        "l_orderkey", "l_linenumber", "l_partkey", "o_orderdate", "o_custkey"
    )


MONTHLY = """SELECT CAST(user_id AS BIGINT) AS user_id, event_type, CAST(YEAR(ts) AS INT) AS y, CAST(MONTH(ts) AS INT) AS m,
    CAST(DAY(ts) AS INT) AS d, MAX(value) AS best FROM events GROUP BY ALL"""


@query(
    "j03_composite_key",
    f"""SELECT e.event_id, e.value, b.best FROM events e LEFT JOIN (SELECT * FROM ({MONTHLY}) WHERE best > 50) b
    ON e.user_id = b.user_id AND e.event_type = b.event_type AND YEAR(e.ts) = b.y AND MONTH(e.ts) = b.m
    AND DAY(e.ts) = b.d""",
)
def _composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = {"y": F.year("ts"), "m": F.month("ts"), "d": F.dayofmonth("ts")}
    events = table(spark, sf_dir, "events").withColumns(day)
    key = ["user_id", "event_type", "y", "m", "d"]
    best = events.groupBy(*key).agg(F.max("value").alias("best")).where(F.col("best") > 50)
    return events.join(best, key, "left").select("event_id", "value", "best")


@query(
    "j05_left_condition_in_on",
    """SELECT s_suppkey, s_nationkey, n_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
    AND s_acctbal > 4000""",
)
def _left_condition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Left rows that fail the condition stay, without a partner."""
    matches = (F.col("s_nationkey") == F.col("n_nationkey")) & (F.col("s_acctbal") > 4000)
    return (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), matches, "left")
        .select("s_suppkey", "s_nationkey", "n_name")
    )


@query(
    "j06_right_condition_in_on",
    """SELECT o_orderkey, l_partkey, l_linenumber FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
    AND l_returnflag IN ('A', 'N') AND l_quantity > 40""",
)
def _right_condition(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").where(
        F.col("l_returnflag").isin("A", "N") & (F.col("l_quantity") > 40)
    )
    lines = lines.withColumnRenamed("l_orderkey", "o_orderkey")
    return joins.left_join_many(table(spark, sf_dir, "orders"), lines, ["o_orderkey"]).select(
        "o_orderkey", "l_partkey", "l_linenumber"
    )


@query(
    "j08_concatenated_key",
    """SELECT c_custkey, s_suppkey FROM customer JOIN supplier ON CASE WHEN c_acctbal > 0 THEN c_mktsegment END ||
    CAST(c_nationkey AS VARCHAR) || CAST(c_custkey AS VARCHAR) = 'BUILDING' || CAST(s_nationkey AS VARCHAR) ||
    CAST(s_suppkey AS VARCHAR)""",
)
def _concatenated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key with a missing part matches nothing."""
    segment = F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment"))
    left = table(spark, sf_dir, "customer").select(
        "c_custkey", text.key_of(segment, F.col("c_nationkey"), F.col("c_custkey")).alias("k")
    )
    right = table(spark, sf_dir, "supplier").select(
        "s_suppkey", text.key_of(F.lit("BUILDING"), F.col("s_nationkey"), F.col("s_suppkey")).alias("k")
    )
    return left.join(right, "k").select("c_custkey", "s_suppkey")


@query(
    "j09_join_on_cast",
    with_staging(
        ["rating_request"],
        """SELECT q.year, q.minute, COUNT(*) AS rows FROM st_rating_request q JOIN (SELECT DISTINCT
        CAST(MINUTE(ts) AS INT) AS m FROM events) e ON TRY_CAST(q.minute AS INT) = e.m GROUP BY ALL""",
    ),
)
def _join_on_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text keys are cast first; text that is no number meets nothing instead of failing."""
    minutes = table(spark, sf_dir, "events").select(F.minute("ts").alias("m")).distinct()
    asked = staging(spark, sf_dir, "rating_request").withColumn("m", F.col("minute").try_cast("int"))
    return asked.join(minutes, "m").groupBy("year", "minute").agg(F.count("*").alias("rows"))


@query(
    "j11_join_to_aggregate",
    """SELECT c_custkey, n, total FROM customer LEFT JOIN (SELECT o_custkey, COUNT(*) AS n, ROUND(SUM(o_totalprice), 2)
    AS total FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) ON c_custkey = o_custkey""",
)
def _join_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_customer = (
        table(spark, sf_dir, "orders")
        .where(F.col("o_orderstatus") == "F")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    )
    return table(spark, sf_dir, "customer").join(per_customer, "c_custkey", "left").select("c_custkey", "n", "total")


@query(
    "j12_join_to_distinct",
    """SELECT p_partkey, s.l_partkey IS NOT NULL AS returned FROM part LEFT JOIN (SELECT DISTINCT l_partkey FROM lineitem
    WHERE l_returnflag = 'R' AND l_quantity > 45) s ON p_partkey = s.l_partkey""",
)
def _join_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    returned = (
        table(spark, sf_dir, "lineitem")
        .where((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45))
        .select("l_partkey")
        .distinct()
    )
    return (
        table(spark, sf_dir, "part")
        .join(returned, F.col("p_partkey") == F.col("l_partkey"), "left")
        .select("p_partkey", F.col("l_partkey").isNotNull().alias("returned"))
    )


@query(
    "j13_exists_as_value",
    """SELECT o_orderkey, CAST(CASE WHEN o_orderstatus = 'F' OR EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey
    AND l_quantity > 49) THEN 1 ELSE 0 END AS INT) AS big FROM orders""",
)
def _exists_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' OR EXISTS (SELECT 1 FROM {lines} WHERE l_orderkey = o_orderkey
        AND l_quantity > 49) THEN 1 ELSE 0 END AS big FROM {orders}""",
        lines=table(spark, sf_dir, "lineitem"),
        orders=table(spark, sf_dir, "orders"),
    )


@query(
    "j14_scalar_max",
    """SELECT c_custkey, LAST_DAY((SELECT CAST(MAX(o_orderdate) AS DATE) FROM orders WHERE o_custkey = c_custkey
    AND o_orderstatus = 'F')) AS last_month_end FROM customer""",
)
def _scalar_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        """SELECT c_custkey, LAST_DAY((SELECT MAX(o_orderdate) FROM {orders} WHERE o_custkey = c_custkey
        AND o_orderstatus = 'F')) AS last_month_end FROM {customer}""",
        customer=table(spark, sf_dir, "customer"),
        orders=table(spark, sf_dir, "orders"),
    )


@query(
    "j17_anti_join",
    "SELECT o_orderkey, CAST(NULL AS BIGINT) AS partkey FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey "
    "WHERE l_orderkey IS NULL",
)
def _anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    missing = table(spark, sf_dir, "orders").select("o_orderkey").join(lines, "o_orderkey", "left_anti")
    return sets.add_typed_nulls(missing, {"partkey": "bigint"})


@query(
    "j19_fan_out",
    """SELECT n_name, c_mktsegment, ROUND(SUM(c_acctbal * f), 4) AS weighted, COUNT(*) AS rows FROM customer
    LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN (SELECT s_nationkey, (s_suppkey + 1) / 7e0 AS f FROM supplier) s ON n_nationkey = s_nationkey
    GROUP BY ALL""",
)
def _fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every match of a customer counts; customers of one nation are spread over several tasks."""
    factors = table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("n_nationkey"), ((F.col("s_suppkey") + 1) / 7.0).alias("f")
    )
    placed = (
        table(spark, sf_dir, "customer")
        .withColumnRenamed("c_nationkey", "n_nationkey")
        .join(table(spark, sf_dir, "nation"), "n_nationkey", "left")
    )
    # the weight of a nation is summed once instead of meeting every customer
    weights = factors.groupBy("n_nationkey").agg(F.sum("f").alias("f"), F.count("*").alias("times"))
    return (
        placed.join(weights, "n_nationkey", "left")
        .groupBy("n_name", "c_mktsegment")
        .agg(
            F.round(F.sum(F.col("c_acctbal") * F.col("f")), 4).alias("weighted"),
            F.sum(F.coalesce("times", F.lit(1))).alias("rows"),
        )
    )


@query(
    "j21_salted_join",
    """SELECT c_custkey, o_orderpriority FROM customer JOIN (SELECT DISTINCT o_custkey % 25 AS k, o_orderpriority
    FROM orders) o ON c_nationkey = k""",
)
def _salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Low-cardinality key on both sides, dealt to several tasks per key."""
    lists = (
        table(spark, sf_dir, "orders")
        .select((F.col("o_custkey") % 25).cast("int").alias("c_nationkey"), "o_orderpriority")
        .distinct()
    )
    return joins.salted_join(table(spark, sf_dir, "customer"), lists, ["c_nationkey"], ["c_custkey"]).select(
        "c_custkey", "o_orderpriority"
    )


# ---------------------------------------------------------------- aggregations


@query(
    "a01_grouped_aggregates",
    """SELECT l_returnflag, l_linestatus, CAST(SUM(l_quantity) AS DOUBLE) AS sum_qty, MIN(l_extendedprice) AS min_price,
    MAX(l_shipdate) AS last_ship, COUNT(*) AS n, COUNT(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1, 2""",
)
def _grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.sum("l_quantity").alias("sum_qty"),
            F.min("l_extendedprice").alias("min_price"),
            F.max("l_shipdate").alias("last_ship"),
            F.count("*").alias("n"),
            F.count_distinct("l_partkey").alias("parts"),
        )
    )


@query(
    "a05_conditional_sums",
    """SELECT l_suppkey, COUNT(*) AS n, CAST(SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS returned,
    SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS returned_qty FROM lineitem GROUP BY 1""",
)
def _conditional(spark: SparkSession, sf_dir: str) -> DataFrame:
    returned = F.col("l_returnflag") == "R"
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey")
        .agg(
            F.count("*").alias("n"),
            aggregates.sum_where(returned).alias("returned"),
            aggregates.sum_where(returned, F.col("l_quantity")).alias("returned_qty"),
        )
    )


@query(
    "a06_weighted_ratio",
    """SELECT event_type, CAST(DAY(ts) AS INT) AS day, ROUND(SUM(COALESCE(CASE WHEN value > 1 THEN value END, 0) *
    (user_id % 4 + 1)) / NULLIF(MAX(user_id % 7) - 6, 0), 3) AS rating FROM events GROUP BY 1, 2""",
)
def _weighted_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    value, user = F.col("value"), F.col("user_id")
    return (
        table(spark, sf_dir, "events")
        .groupBy("event_type", F.dayofmonth("ts").alias("day"))
        .agg(
            aggregates.weighted_sum(F.when(value > 1, value), user % 4 + 1).alias("top"),
            (F.max(user % 7) - 6).alias("bottom"),
        )
        .select("event_type", "day", nulls.safe_ratio(F.col("top"), F.col("bottom"), digits=3).alias("rating"))
    )


@query("a08_distinct", "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def _distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag").distinct()


@query(
    "a11_group_by_expression",
    """SELECT c_mktsegment || CAST(c_nationkey AS VARCHAR) AS key, c_acctbal < 0 AS debt, COUNT(*) AS n,
    ROUND(AVG(c_acctbal), 4) AS mean FROM customer GROUP BY 1, 2""",
)
def _group_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .groupBy(
            text.key_of(F.col("c_mktsegment"), F.col("c_nationkey")).alias("key"), (F.col("c_acctbal") < 0).alias("debt")
        )
        .agg(F.count("*").alias("n"), F.round(F.avg("c_acctbal"), 4).alias("mean"))
    )


@query(
    "a12_joined_text",
    """SELECT role, CAST(FLOOR(conv_id / 256) AS BIGINT) AS part, STRING_AGG(text, ' ' ORDER BY conv_id, turn) AS text,
    COUNT(*) AS texts FROM (SELECT conv_id * 1000 + turn AS id, * FROM conversations) GROUP BY 1, 2""",
)
def _joined_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = table(spark, sf_dir, "conversations").withColumn("id", F.col("conv_id") * 1000 + F.col("turn"))
    return aggregates.joined_text(said, ["role"], "text", "id", width=256_000)


@query(
    "a14_totals_row",
    """SELECT s_name, s_acctbal FROM supplier UNION ALL SELECT 'Total', ROUND(SUM(s_acctbal), 2) FROM supplier""",
)
def _totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier").select("s_name", "s_acctbal")
    total = aggregates.totals_row(suppliers, ["s_acctbal"], "s_name")
    return sets.stack(suppliers, total.withColumn("s_acctbal", F.round("s_acctbal", 2)))


@query(
    "a16_two_levels",
    """SELECT o_custkey, ROUND(SUM(share), 4) AS shares FROM (SELECT o_custkey, o_orderstatus,
    SUM(o_totalprice) / NULLIF(MAX(o_totalprice), 0) AS share FROM orders GROUP BY 1, 2) GROUP BY 1""",
)
def _two_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_status = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey", "o_orderstatus")
        .agg(nulls.safe_ratio(F.sum("o_totalprice"), F.max("o_totalprice")).alias("share"))
    )
    return per_status.groupBy("o_custkey").agg(F.round(F.sum("share"), 4).alias("shares"))


WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


@query(
    "a17_weekday_pivot",
    f"""SELECT user_id, {", ".join(f"ROUND(SUM(CASE DAYNAME(ts) WHEN '{d}' THEN value ELSE 0 END), 2) AS {d.lower()}"
    for d in WEEKDAYS)} FROM events GROUP BY 1""",
)
def _weekday_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {d.lower(): d for d in WEEKDAYS}
    sums = aggregates.sums_by_label(F.col("value"), dates.weekday_name(F.col("ts")), names)
    pivoted = table(spark, sf_dir, "events").groupBy("user_id").agg(*sums)
    return pivoted.withColumns({n: F.round(n, 2) for n in names})


@query(
    "a19_latest_per_key",
    """SELECT user_id, event_type, MAX(ts) AS last_at, MIN(event_id) AS first_id FROM events GROUP BY 1, 2""",
)
def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .groupBy("user_id", "event_type")
        .agg(F.max("ts").alias("last_at"), F.min("event_id").alias("first_id"))
    )


# ---------------------------------------------------------------- windows, sorting, sets

LINE_ORDER = "l_quantity DESC, l_partkey, l_linenumber, l_suppkey, l_shipdate, l_extendedprice"


@query(
    "w01_row_number",
    f"""SELECT l_suppkey, l_orderkey, l_partkey, l_quantity, CAST(ROW_NUMBER() OVER (PARTITION BY l_suppkey ORDER BY
    {LINE_ORDER}) AS INT) AS rn, COUNT(*) OVER (PARTITION BY l_suppkey) AS lines FROM lineitem""",
)
def _row_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers all lines of a supplier, in chunks of one quantity and 64 part keys."""
    order: list[Column] = [F.col("l_quantity").desc_nulls_last()]
    order += [F.col(c) for c in ("l_partkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_extendedprice")]
    chunk = [-F.col("l_quantity"), F.floor(F.col("l_partkey") / 64)]
    numbered = windows.number_within(table(spark, sf_dir, "lineitem"), ["l_suppkey"], order, chunk, "rn", "lines")
    return numbered.select("l_suppkey", "l_orderkey", "l_partkey", "l_quantity", "rn", "lines")


@query(
    "w02_first_per_key",
    """SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY
    o_orderdate DESC, o_orderkey) AS n FROM orders) WHERE n = 1""",
)
def _first_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.col("o_orderdate").desc(), F.col("o_orderkey")]
    return windows.keep_first(table(spark, sf_dir, "orders"), ["o_custkey"], order).select(
        "o_custkey", "o_orderkey", "o_orderdate"
    )


@query(
    "w03_count_over",
    """SELECT o_orderkey, COUNT(*) OVER (PARTITION BY o_custkey, o_orderstatus) > 1 AS repeated FROM orders""",
)
def _count_over(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    sized = windows.with_group_size(orders, ["o_custkey", "o_orderstatus"], ["o_orderkey"], "n")
    return sized.select("o_orderkey", (F.col("n") > 1).alias("repeated"))


@query(
    "w04_lag_and_gap",
    """SELECT event_type, event_id, LAG(ts) OVER w AS previous_ts, LAG(value) OVER w AS previous_value,
    CAST(DATE_DIFF('day', LAG(ts) OVER w, ts) AS INT) AS gap FROM events
    WINDOW w AS (PARTITION BY event_type ORDER BY event_id)""",
)
def _lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few, very large groups: each is cut into chunks of 512 event ids."""
    events = table(spark, sf_dir, "events").select("event_type", "event_id", "ts", "value")
    values = {"ts": "previous_ts", "value": "previous_value"}
    lagged = windows.previous_within(events, ["event_type"], "event_id", values, width=512)
    gap = dates.days_between(F.col("previous_ts"), F.col("ts")).alias("gap")
    return lagged.select("event_type", "event_id", "previous_ts", "previous_value", gap)


@query(
    "o03_topk",
    """SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders
    ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey LIMIT 25""",
)
def _topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.col("o_orderpriority").asc(), F.col("o_totalprice").desc(), F.col("o_orderkey")]
    return rows.preview(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice"), 25, order
    )


@query("k13_last_rows", "SELECT * FROM supplier ORDER BY s_suppkey DESC LIMIT 5")
def _last_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.last_rows(table(spark, sf_dir, "supplier"), 5, ["s_suppkey"])


@query(
    "o04_top_per_group",
    """SELECT c_mktsegment, c_custkey, c_acctbal FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY c_mktsegment
    ORDER BY c_acctbal DESC, c_custkey) AS n FROM customer) WHERE n <= 3""",
)
def _top_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.col("c_acctbal").desc(), F.col("c_custkey")]
    return windows.keep_top(table(spark, sf_dir, "customer"), ["c_mktsegment"], order, 3).select(
        "c_mktsegment", "c_custkey", "c_acctbal"
    )


@query(
    "u01_union_distinct",
    """SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier UNION SELECT n_nationkey
    FROM nation""",
)
def _union_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = [("customer", "c_nationkey"), ("supplier", "s_nationkey"), ("nation", "n_nationkey")]
    return sets.stack_distinct(*[table(spark, sf_dir, t).select(F.col(c).alias("nation")) for t, c in named])


@query(
    "u02_union_all",
    """SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier""",
)
def _union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"))
    return sets.stack(customers, suppliers)


@query(
    "u04_by_name",
    """SELECT l_orderkey, l_quantity, CAST(NULL AS DOUBLE) AS l_tax FROM lineitem WHERE l_returnflag = 'A'
    UNION ALL SELECT l_orderkey, NULL, l_tax FROM lineitem WHERE l_returnflag <> 'A'""",
)
def _by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return sets.stack(
        lines.where(F.col("l_returnflag") == "A").select("l_orderkey", "l_quantity"),
        lines.where(F.col("l_returnflag") != "A").select("l_tax", "l_orderkey"),
    )


# ---------------------------------------------------------------- scalar functions


@query(
    "f_string",
    """SELECT c_custkey, c_mktsegment || '-' || CASE WHEN c_acctbal > 0 THEN c_name END AS joined,
    CONCAT(c_mktsegment, '-', CASE WHEN c_acctbal > 0 THEN c_name END) AS joined_blank, LEFT(c_name, 7) AS start,
    SUBSTRING(c_name, 1, 10) AS ten, SPLIT_PART(c_name, '#', 2) AS number, LOWER(TRIM(c_mktsegment)) IN ('building', 'na')
    AS noise, LPAD(CAST(c_nationkey AS VARCHAR), 4, '0') AS padded, REPLACE(c_name, '#', '/') AS replaced,
    REGEXP_REPLACE(c_name, '#.*$', '') AS stem, CASE WHEN c_nationkey < 5 THEN c_mktsegment ELSE c_mktsegment || ' ' || c_name
    END AS full_name FROM customer""",
)
def _strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, segment = F.col("c_name"), F.col("c_mktsegment")
    known = F.when(F.col("c_acctbal") > 0, name)
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        text.key_of(segment, known, sep="-").alias("joined"),
        text.key_with_blanks(segment, known, sep="-").alias("joined_blank"),
        F.left(name, F.lit(7)).alias("start"),
        F.substring(name, 1, 10).alias("ten"),
        F.split(name, "#").getItem(1).alias("number"),
        F.lower(F.trim(segment)).isin("building", "na").alias("noise"),
        text.zero_padded(F.col("c_nationkey"), 4).alias("padded"),
        F.replace(name, F.lit("#"), F.lit("/")).alias("replaced"),
        F.regexp_replace(name, "#.*$", "").alias("stem"),
        text.full_name(segment, F.when(F.col("c_nationkey") >= 5, name)).alias("full_name"),
    )


@query(
    "f_date",
    """SELECT o_orderkey, CAST(YEAR(o_orderdate) AS INT) AS y, CAST(MONTH(o_orderdate) AS INT) AS m,
    CAST(DATE_DIFF('day', o_orderdate, DATE '2001-08-02') AS INT) AS age, LAST_DAY(CAST(o_orderdate AS DATE)) AS month_end,
    CAST(o_orderdate AS DATE) AS day, MAKE_DATE(YEAR(o_orderdate), MONTH(o_orderdate), 1) AS month_start,
    CAST(CASE WHEN MONTH(o_orderdate) > 6 THEN MONTH(o_orderdate) - 6 ELSE MONTH(o_orderdate) + 6 END AS INT)
    AS fiscal_month, CAST(YEAR(o_orderdate) * 100 + MONTH(o_orderdate) AS INT) AS period, DAYNAME(o_orderdate) AS weekday,
    STRFTIME(o_orderdate, '%Y-%m-%d %H:%M') AS minute_text, DATE '2001-08-01' AS yesterday, DATE '2001-07-03' AS month_ago
    FROM orders""",
)
def _date_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate")
    today = F.lit(RUN_DATE)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.year(day).alias("y"),
        F.month(day).alias("m"),
        dates.days_between(day, today).alias("age"),
        F.last_day(day.cast("date")).alias("month_end"),
        F.to_date(day).alias("day"),
        dates.period_start(F.year(day), F.month(day)).alias("month_start"),
        dates.fiscal_month(F.month(day)).alias("fiscal_month"),
        dates.period_of(day).alias("period"),
        dates.weekday_name(day).alias("weekday"),
        dates.minute_text(day).alias("minute_text"),
        F.date_sub(today, 1).alias("yesterday"),
        F.date_sub(today, 30).alias("month_ago"),
    )


@query(
    "f16_fiscal_quarter",
    """SELECT o_orderkey, 'RFY' || CAST(YEAR(d) - CASE WHEN MONTH(d) >= 7 THEN 1999 ELSE 2000 END AS VARCHAR) || '-Q' ||
    CASE WHEN MONTH(d) IN (7, 8, 9) THEN '1' WHEN MONTH(d) IN (10, 11, 12) THEN '2' WHEN MONTH(d) IN (1, 2, 3) THEN '3'
    ELSE '4' END AS quarter, 'R' || STRFTIME(d, '%Y-%m') AS month
    FROM (SELECT o_orderkey, o_orderdate + INTERVAL 24 YEAR AS d FROM orders)""",
)
def _fiscal_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    later = F.expr("o_orderdate + INTERVAL '24' YEAR")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", dates.fiscal_quarter(later).alias("quarter"), dates.registered_month(later).alias("month")
    )


@query(
    "f20_timestamps",
    """SELECT event_id, DATE_DIFF('microsecond', TIMESTAMP '2024-01-01', ts) / 60000000e0 AS minutes,
    DATE_TRUNC('second', ts) AS parsed, ts AS iso FROM events""",
)
def _timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    return table(spark, sf_dir, "events").select(
        "event_id",
        dates.minutes_between(start, ts).alias("minutes"),
        dates.from_pattern(F.date_format(ts, "yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz").alias("parsed"),
        dates.from_iso(F.date_format(ts, dates.ISO_TIMESTAMP)).cast("timestamp_ntz").alias("iso"),
    )


@query(
    "f_math_null_cast",
    """SELECT p_partkey, p_retailprice + p_size AS added, p_retailprice - p_size AS less, p_retailprice * p_size AS times,
    p_retailprice / NULLIF(p_size - 1, 0) AS divided, ROUND(p_retailprice / 7, 3) AS rounded, COALESCE(NULLIF(p_size, 10), -1)
    AS ten_hidden, CAST(CAST(p_size AS VARCHAR) AS INT) AS again, CAST(p_size AS FLOAT) AS as_float,
    TRY_CAST(CASE WHEN p_size < 20 THEN p_name ELSE CAST(p_retailprice AS VARCHAR) END AS DOUBLE) AS number FROM part""",
)
def _math(spark: SparkSession, sf_dir: str) -> DataFrame:
    price, size = F.col("p_retailprice"), F.col("p_size")
    mixed = F.when(size < 20, F.col("p_name")).otherwise(price.cast("string"))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        (price + size).alias("added"),
        (price - size).alias("less"),
        (price * size).alias("times"),
        nulls.safe_ratio(price, size - 1).alias("divided"),
        F.round(price / 7, 3).alias("rounded"),
        F.coalesce(F.nullif(size, F.lit(10)), F.lit(-1)).alias("ten_hidden"),
        size.cast("string").try_cast("int").alias("again"),
        size.cast("float").alias("as_float"),
        nulls.as_number(mixed).alias("number"),
    )


@query(
    "f_json_array",
    """SELECT event_id, CAST(REGEXP_EXTRACT(props, '[0-9]+') AS INT) AS k, '{"event_type":"' || event_type || '","user_id":' ||
    CAST(user_id AS VARCHAR) || '}' AS json, event_type IN ('click', 'view') AS listed,
    event_type || ',' || CAST(user_id AS VARCHAR) AS joined FROM events""",
)
def _json(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = F.array("event_type", F.col("user_id").cast("string"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.from_json("props", "k int")["k"].alias("k"),
        F.to_json(F.struct("event_type", "user_id")).alias("json"),
        F.array_contains(F.array(F.lit("click"), F.lit("view")), F.col("event_type")).alias("listed"),
        F.array_join(parts, ",").alias("joined"),
    )


@query(
    "f28_slicer_values",
    """SELECT c_custkey, c_mktsegment AS first_value, CAST(2 AS INT) AS n, CAST(NULL AS INT) AS missing FROM customer""",
)
def _slicers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named value lists out of a JSON document."""
    document = F.concat(
        F.lit('{"parameters": [{"name": "segment", "type": "list", "values": ["'),
        F.col("c_mktsegment"),
        F.lit('", "ANY"]}]}'),
    )
    slicers = documents.parse_slicers(document, "parameters")
    values = documents.slicer_values(slicers, "segment")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        values[0].alias("first_value"),
        F.size(values).alias("n"),
        F.array_size(documents.slicer_values(slicers, "sex")).alias("missing"),
    )


@query(
    "x01_user_agents",
    with_staging(
        ["weblog"],
        """SELECT "UserAgent" AS agent, MIN(CASE WHEN "UserAgent" LIKE '%Windows%' THEN 'Windows' WHEN "UserAgent" LIKE '%iP%'
        THEN 'iOS' WHEN "UserAgent" LIKE '%Android%' THEN 'Android' WHEN "UserAgent" LIKE '%Macintosh%' THEN 'Mac OS X'
        WHEN "UserAgent" LIKE '%Ubuntu%' THEN 'Ubuntu' ELSE 'Other' END) AS os,
        MIN("UserAgent" LIKE '%iPhone%' OR "UserAgent" LIKE '%Android%Mobile%') AS mobile, COUNT(*) AS hits
        FROM st_weblog GROUP BY 1""",
    ),
)
def _agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    agent = F.col("UserAgent")
    return (
        staging(spark, sf_dir, "weblog")
        .select(agent.alias("agent"), agents.agent_os(agent).alias("os"), agents.agent_is_mobile(agent).alias("mobile"))
        .groupBy("agent", "os", "mobile")
        .agg(F.count("*").alias("hits"))
    )
