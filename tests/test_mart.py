"""Small hand-made cases for the tables of the sales mart."""

from __future__ import annotations

import random
import re

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.plans import access, dimensions, orders, promotions, recommendation, tracking
from tidemark.plans.mart import mart_tables, refresh

ORDER = (
    "id bigint, client_order_number string, chain_id bigint, business bigint, user_id bigint, distributor_id bigint, "
    "country_id string, status string, original_created_at timestamp_ntz, created_at timestamp_ntz, "
    "updated_at timestamp_ntz, observation string, updated_by string, customer bigint, day_of_preference string, "
    "delivery_cost double"
)
LINE = (
    "line_number int, id bigint, product_id bigint, current_quantity double, current_unit_price double, "
    "delivery_date date, invoice_number string, status string, cancellation_id int, updated_at date, updated_by string, "
    "`order` bigint, uom string, observation string, created_at date, payment_date date, invoice_date date, "
    "discount double, taxes double, presentation string, presentation_quantity int, cost_per_unit double"
)
PROMO = "promo_id bigint, product_id bigint, quantity int"


def names(ddl: str) -> list[str]:
    return [part.strip().split(" ")[0].strip("`") for part in ddl.split(",")]


def make(spark, ddl, dicts):
    columns = names(ddl)
    return spark.createDataFrame([tuple(d.get(c) for c in columns) for d in dicts], ddl)


def day(y, m, d):
    return dt.datetime(y, m, d)


@pytest.fixture(scope="module")
def order(spark):
    base = {"chain_id": 1, "business": 10, "user_id": 5, "country_id": "13", "status": "open"}
    return make(
        spark,
        ORDER,
        [
            base | {"id": 1, "created_at": day(2022, 5, 10)},
            # a later id with an earlier date: the gap is negative
            base | {"id": 2, "created_at": day(2022, 5, 1), "status": "cancelled"},
            base | {"id": 3, "created_at": day(2023, 1, 1), "user_id": 6, "business": 11},
            base | {"id": 4, "created_at": None, "user_id": None, "business": 12, "status": None},
        ],
    )


def line(**values):
    base = {"current_quantity": 2.0, "current_unit_price": 10.0, "discount": 1.0, "taxes": 0.5, "status": "open"}
    return base | {"line_number": 1, "uom": "EA", "created_at": dt.date(2022, 6, 1), "cost_per_unit": 6.0} | values


@pytest.fixture(scope="module")
def order_line(spark):
    return make(
        spark,
        LINE,
        [
            line(id=11, order=1, product_id=100),
            line(id=12, order=1, product_id=101, status="cancelled", cancellation_id=9),
            line(id=13, order=1, product_id=102, status="returned"),
            line(id=21, order=2, product_id=100, status="cancelled", cancellation_id=8),
            line(id=31, order=3, product_id=500, created_at=dt.date(2023, 2, 1)),
            line(id=32, order=3, product_id=501),
            line(id=33, order=3, product_id=502, status="cancelled", cancellation_id=7),
            line(id=99, order=77, product_id=100),
        ],
    )


def test_fact_order(spark, order, order_line, rows):
    user = spark.createDataFrame([(5, 70), (6, None)], "id bigint, sales_rep bigint")
    rate = spark.createDataFrame([("13", 2022, 5, 4.0)], "id_country string, calendar_year int, calendar_month int, rate double")
    rep = spark.createDataFrame([(31, 1), (30, 1), (29, 2)], "id bigint, chain_id bigint")
    pairs = spark.createDataFrame([(31, 11), (30, 11), (29, 11)], "sales_rep_id bigint, business_id bigint")
    fact = orders.fact_order(order, user, rate, rep, pairs, order_line)
    assert rows(fact, "id", "valid", "rate", "sales_rep_id", "cancellation_status", "total_lines", "total_amount") == [
        (1, 1, 4.0, 70, "Partial", 3, 19.0),
        (2, 0, 4.0, 70, "Total", 1, 0.0),
        # no rep of the user: the lowest id of that chain and business
        (3, 1, None, 30, "Partial", 3, 38.0),
        (4, 1, None, None, None, None, None),
    ]
    assert rows(fact, "id", "key_rate", "business_chain", "days_from_last_order") == [
        (1, "13|202205", "10-1", None),
        (2, "13|202205", "10-1", -9),
        (3, "13|202301", "11-1", None),
        (4, None, "12-1", None),
    ]


@pytest.fixture(scope="module")
def lines(spark, order, order_line):
    promo = make(
        spark,
        PROMO,
        [
            {"promo_id": 500, "product_id": 100, "quantity": 3},
            {"promo_id": 500, "product_id": 101, "quantity": 3},
            {"promo_id": 500, "product_id": 999, "quantity": 8},
            {"promo_id": 501, "product_id": 102, "quantity": 0},
            {"promo_id": 502, "product_id": 100, "quantity": 1},
        ],
    )
    product = spark.createDataFrame([(100,), (101,), (102,)], "id bigint")
    return orders.fact_order_line(order_line, order, promo, product)


def test_lines_of_promotions_are_expanded(lines, rows):
    found = lines.where(F.col("id").isin(31, 32, 33))
    assert rows(
        found, "id_surrogate", "product_id", "product_flag", "promo_type", "promo_row", "current_quantity",
        "current_unit_price", "line_amount", "cost_per_unit", "uom",
    ) == [
        ("31", 500, "Promo Product", None, None, 2.0, 10.0, 19.0, 6.0, "EA"),
        # equal quantities: the lower product id comes first and carries the amounts; 999 is no known product
        ("31/1", 100, "Promo Normal Product", "Mixed Bundle", 1, 6.0, 10.0 / 3, 19.0, 2.0, "EA"),
        ("31/2", 101, "Promo Normal Product", "Mixed Bundle", 2, 6.0, None, None, None, None),
        ("32", 501, "Promo Product", None, None, 2.0, 10.0, 19.0, 6.0, "EA"),
        # quantity 0 keeps prices at 0 and does not divide
        ("32/1", 102, "Promo Normal Product", "Discount", 1, 0.0, 0.0, 19.0, 0.0, "EA"),
        ("33", 502, "Promo Product", None, None, 2.0, 10.0, 0.0, 6.0, "EA"),
        ("33/1", 100, "Promo Normal Product", "Discount", 1, 2.0, 10.0, 0.0, 6.0, "EA"),
    ]


def test_line_states_and_excise(lines, rows):
    original = lines.where("line_transformed = 0")
    assert rows(
        original, "id", "valid", "line_amount", "cancelled_amount", "cancelled_quantity", "cancellation_id", "excise"
    ) == [
        (11, 1, 19.0, 0.0, 0.0, None, 1.07),
        (12, 0, 0.0, 19.0, 2.0, 9, 1.07),
        (13, 0, 0.0, 0.0, 0.0, None, 1.07),
        (21, 0, 0.0, 19.0, 2.0, 8, 1.07),
        (31, 1, 19.0, 0.0, 0.0, None, 1.08),
        (32, 1, 19.0, 0.0, 0.0, None, 1.07),
        (33, 0, 0.0, 19.0, 2.0, 7, 1.07),
    ]


def test_amounts_survive_the_expansion(lines):
    """The components of a line sum up to the line."""
    sums = {
        r.line_transformed: (r.a, r.c)
        for r in lines.where(F.col("id").isin(31, 32, 33))
        .groupBy("line_transformed")
        .agg(F.sum("line_amount").alias("a"), F.sum("cancelled_amount").alias("c"))
        .collect()
    }
    assert sums[0] == sums[1] == (38.0, 19.0)


def test_whole_lines_are_read_once(spark, order, tmp_path, rows):
    equal = line(order=3, product_id=500)
    made = [equal | {"id": 41}, equal | {"id": 42}, line(id=43, order=3), line(id=44, product_id=500), line(id=45, order=2, product_id=9)]
    make(spark, LINE, made).write.parquet(f"{tmp_path}/lines")
    promo = make(spark, PROMO, [{"promo_id": 500, "product_id": 100, "quantity": 3}, {"product_id": 100, "quantity": 1}])
    product = spark.createDataFrame([(100,)], "id bigint")
    twice = order.unionByName(order.where("id = 2").withColumn("country_id", F.lit("7")))
    found = orders.fact_order_line(spark.read.parquet(f"{tmp_path}/lines"), twice, promo, product)
    assert rows(found, "id_surrogate", "country_id", "product_id", "product_flag") == [
        ("41", "13", 500, "Promo Product"), ("41/1", "13", 100, "Promo Normal Product"),
        ("42", "13", 500, "Promo Product"), ("42/1", "13", 100, "Promo Normal Product"),
        ("43", "13", None, "Normal Product"), ("45", "13", 9, "Normal Product"), ("45", "7", 9, "Normal Product"),
    ]
    plan = found._jdf.queryExecution().executedPlan().toString()
    reads = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    assert sum("invoice_number" in columns for columns in reads) == 1 < len(reads)


def test_promo_types(spark, rows):
    promo = make(
        spark,
        PROMO,
        [
            {"promo_id": 1, "product_id": 9, "quantity": 1},
            {"promo_id": 2, "product_id": 9, "quantity": 3},
            {"promo_id": 3, "product_id": 9, "quantity": 1},
            {"promo_id": 3, "product_id": 8, "quantity": 1},
            {"promo_id": 3, "product_id": 7, "quantity": None},
        ],
    )
    assert rows(promotions.dim_promo_product(promo), "promo_id", "product_id", "promo_type", "rn") == [
        (1, 9, "Discount", 1),
        (2, 9, "Multi Buy", 1),
        (3, 7, "Mixed Bundle", 3),
        (3, 8, "Mixed Bundle", 1),
        (3, 9, "Mixed Bundle", 2),
    ]


def test_promo_by_business_merges_before_it_fills_nulls(spark, rows):
    business = spark.createDataFrame([(1, 5, None), (2, None, 6)], "id int, channel_id int, sub_channel_id int")
    named = spark.createDataFrame([(1, 50), (1, 50), (1, None), (1, 0)], "business_id int, product_id int")
    channel = spark.createDataFrame([(5, 50), (5, 51)], "channel_id int, product_id int")
    sub = spark.createDataFrame([(6, 60)], "subchannel_id int, product_id int")
    assert rows(promotions.promo_by_business(business, named, channel, sub)) == [
        (1, 5, 0, 0), (1, 5, 0, 0), (1, 5, 0, 50), (1, 5, 0, 51), (2, 0, 6, 60),
    ]


def test_promo_by_business_needs_no_distinct_over_its_result(spark, rows):
    business = spark.createDataFrame(
        [(1, 5, 6), (1, 5, 6), (2, 5, None), (3, None, 6), (4, None, None), (None, 5, 6)],
        "id int, channel_id int, sub_channel_id int",
    )
    named = spark.createDataFrame(
        [(1, 50), (1, 52), (1, 52), (2, None), (3, None), (4, 7), (None, 9)], "business_id int, product_id int"
    )
    channel = spark.createDataFrame([(5, 50), (5, 50), (5, None), (None, 3)], "channel_id int, product_id int")
    sub = spark.createDataFrame([(6, 50), (6, 60)], "subchannel_id int, product_id int")
    made = promotions.promo_by_business(business, named, channel, sub)
    assert rows(made) == sorted([
        *[(1, 5, 6, p) for p in (0, 50, 52, 60)], (2, 5, 0, 0), (2, 5, 0, 50), (3, 0, 6, 0), (3, 0, 6, 50), (3, 0, 6, 60),
        (4, 0, 0, 7), *[(None, 5, 6, p) for p in (0, 50, 60)],
    ], key=str)
    above_union = made._jdf.queryExecution().optimizedPlan().toString().split("Union")[0]
    assert "Aggregate" not in above_union


def test_dim_business(spark, rows):
    business = spark.createDataFrame(
        [
            (1, "a", 1, "13", 1, dt.date(2023, 8, 1), dt.date(2024, 1, 1)),
            (2, "b", 13, "12", 0, dt.date(2023, 2, 1), None),
            (3, "c", None, "13", 0, dt.date(2022, 5, 1), None),
            (4, "d", 99, "13", 7, None, None),
        ],
        "id bigint, name string, channel_id int, country_id string, active int, created_at date, last_order_date date",
    )
    for column in ("sub_channel_id", "image_level_id", "city_id", "position_id", "reporting"):
        business = business.withColumn(column, F.lit(None).cast("int"))
    for column in ("updated_at", "first_order_date"):
        business = business.withColumn(column, F.lit(None).cast("date"))
    business = business.withColumn("invitation_code", F.lit("i"))
    order = spark.createDataFrame(
        [(2, day(2024, 2, 10)), (2, day(2024, 1, 10)), (4, None)], "business bigint, created_at timestamp_ntz"
    )
    lookup = "id int, name string, description string, state string"
    channel = spark.createDataFrame([(1, "one", "x", "s"), (13, "net", "y", "s"), (99, "odd", "z", "s")], lookup)
    empty = spark.createDataFrame([], lookup)
    typed = spark.createDataFrame(
        [(1, 1, "A"), (1, 1, "B"), (1, None, "C"), (2, 1, "D")],
        "business_id bigint, business_type int, business_type_description string",
    )
    dim = dimensions.dim_business(business, order, empty, channel, empty, empty, typed, dt.date(2024, 3, 1))
    assert rows(dim, "id", "business_status", "channel_group", "channel_group_order", "business_type") == [
        (1, "Active", "Tradi Off.Trade", 2, "B"),
        # typed, but in another country
        (2, "Inactive", "Online sellers", 4, None),
        (3, "Inactive", None, None, None),
        (4, None, "OTHERS", 5, None),
    ]
    assert rows(dim, "id", "registered_month", "registered_qtr", "days_since_reg", "days_since_last_order") == [
        (1, "R2023-08", "RFY24-Q1", 213, 60),
        (2, "R2023-02", "RFY23-Q3", 394, None),
        (3, "R2022-05", "RFY22-Q4", 670, None),
        (4, None, None, None, None),
    ]
    assert rows(dim, "id", "active_new", "active_end_date") == [
        (1, 1, dt.date(9999, 12, 31)),
        (2, 1, dt.date(2024, 2, 29)),
        # never ordered and not active
        (3, 0, None),
        (4, 1, None),
    ]


def test_sales_rep_language(spark, rows):
    rep = spark.createDataFrame(
        [(1, "A", "Z"), (2, "B", None), (3, "C", "Y")], "id int, name string, last_name string"
    ).withColumns({"email": F.lit("e"), "chain_id": F.lit(1)})
    pairs = spark.createDataFrame([(1, 8), (1, 7), (2, 8)], "sales_rep_id int, business_id int")
    business = spark.createDataFrame([(7, 57), (8, 1)], "id int, country_id int")
    country = spark.createDataFrame([(57, "Colombia"), (1, "Peru")], "id int, name string")
    dim = dimensions.dim_sales_rep(rep, pairs, business, country)
    assert rows(dim, "id", "sales_rep", "language") == [(1, "A Z", "es-ES"), (2, "B", "en-US"), (3, "C Y", "en-US")]


def test_business_chain_user_fans_out_per_rep(spark, rows):
    user = spark.createDataFrame([(1, 2, 5, 1, "r"), (None, 2, 6, 1, "r")], "business int, chain int, user int, status int, role string")
    pairs = spark.createDataFrame([(8, 1), (9, 1)], "sales_rep_id int, business_id int")
    rep = spark.createDataFrame([(8, 2, "e8", "N", None), (9, 2, "e9", "M", "L")], "id int, chain_id int, email string, name string, last_name string")
    dim = dimensions.dim_business_chain_user(user, pairs, rep)
    assert rows(dim, "user_id", "business_chain", "sales_rep_id", "sales_rep") == [
        (5, "1-2", 8, "N"), (5, "1-2", 9, "M L"), (6, "-2", None, None),
    ]


def test_nps_bands(spark, rows):
    nps = spark.createDataFrame([(i,) for i in (0, 1, 6, 7, 8, 9, 10)], "score int").withColumns(
        {c: F.lit(1) for c in ("survey_start_date", "survey_end_date", "chain_id", "business_id", "date", "country_id", "order_id", "comment")}
    )
    chain = spark.createDataFrame([(1, "w")], "id int, name string")
    assert rows(orders.fact_nps_result(nps, chain), "score", "category") == [
        (1, "Detractor"), (10, "Promoter"), (6, "Detractor"), (7, "Passive"), (8, "Passive"), (9, "Promoter"),
    ]


def test_notification_counts_only_later_events(spark, rows):
    key = "country int, chain int, business_id int, user_id int, promotion_id int"
    at = [day(2024, 1, d) for d in range(0 + 1, 10)]
    notes = spark.createDataFrame(
        [(1, 1, 1, u, 7, 0, at[0], at[0], at[2]) for u in (1, 2, 3)] + [(1, 1, 1, 4, 7, 0, at[0], at[0], None)],
        key + ", configuration_id int, created_at timestamp_ntz, sent_at timestamp_ntz, opened_at timestamp_ntz",
    )
    header = "id int, country_id int, user_id int, business int, chain_id int, created_at timestamp_ntz"
    # user 1: cart after opening, order after it; 2: cart before opening; 3: order before cart; 4: never opened
    cart = spark.createDataFrame(
        [(1, 1, 1, 1, 1, at[3]), (2, 1, 2, 1, 1, at[1]), (3, 1, 3, 1, 1, at[6]), (4, 1, 4, 1, 1, at[6])], header
    )
    order = spark.createDataFrame([(1, 1, 1, 1, 1, at[5]), (2, 1, 2, 1, 1, at[5]), (3, 1, 3, 1, 1, at[4])], header)
    cart_line = spark.createDataFrame([(i, 7) for i in (1, 2, 3, 4)] + [(1, None)], "cart int, product int")
    order_line = spark.createDataFrame([(7, i) for i in (1, 2, 3)], "product_id int, `order` int")
    product = spark.createDataFrame([(7, "p")], "id int, name string")
    fact = tracking.fact_notification_tracking(notes, product, cart, cart_line, order, order_line)
    assert rows(fact, "user_id", "product", "add_to_cart_at", "bought_at") == [
        (1, "p", at[3], at[5]), (2, "p", None, None), (3, "p", at[6], None), (4, "p", None, None),
    ]


def test_members_of_a_user(spark, rows):
    user = spark.createDataFrame(
        [(1, "a@x", "ADMIN", "A"), (2, "b@x", "COUNTRY_ADMIN", "B"), (3, "none", "ADMIN", "A"), (4, "d@x", "REP", "A")],
        "user_id int, email string, role string, country_id string",
    )
    member = spark.createDataFrame([(10, "A"), (11, "B"), (12, None)], "id int, country_id string")
    listed = spark.createDataFrame([(4, 11), (4, 11), (3, 10), (9, 10)], "sys_user int, member int")
    found = access.sys_users_member(listed, user, member)
    assert rows(found, "sys_user", "member", "country_id") == [
        (1, 10, "A"), (1, 11, "B"), (1, 12, None), (2, 11, "B"), (3, 10, "A"), (4, 11, "A"),
    ]
    brand = spark.createDataFrame([(100, 11), (101, 10)], "id int, member int")
    product = spark.createDataFrame([(100, 5), (100, 5), (100, 6), (101, None)], "brand_id int, product_category_id int")
    categories = access.sysuser_product_category(listed, user, member, brand, product)
    assert rows(categories.where("sys_user in (2, 3)"), "sys_user", "product_category_id") == [(2, 5), (2, 6), (3, None)]


LINES = "`order` int, product_id int, product_flag string, valid int"


def test_funnel_labels(spark, rows):
    baskets = {
        # order: (recommended, ordered)
        1: ([1, 2], [(1, "Normal Product", 1), (2, "Promo Product", 1)]),
        2: ([1], [(1, "Normal Product", 1), (2, "Normal Product", 1)]),
        3: ([1, 2], [(1, "Normal Product", 1)]),
        4: ([1, 2], [(1, "Normal Product", 1), (3, "Normal Product", 1)]),
        # an invalid line is neither a purchase nor recommended
        5: ([1], [(1, "Normal Product", 0)]),
        # a line of an expanded promotion adds to the order
        6: ([1], [(1, "Promo Product", 1), (9, "Promo Normal Product", 1)]),
        # no lines at all
        7: ([1], []),
    }
    tracking_rows = [(o * 10, o) for o in baskets] + [(80, None), (90, 9)]
    tracked = spark.createDataFrame(tracking_rows, "id int, orderId int")
    found = spark.createDataFrame(
        [(o * 10, p) for o, (recommended, _) in baskets.items() for p in recommended] + [(80, 1), (10, None)],
        "fastOrderTrackingId int, productId int",
    )
    order_line = spark.createDataFrame([(o, *x) for o, (_, ordered) in baskets.items() for x in ordered], LINES)
    order = spark.createDataFrame([(1, day(2024, 1, 1), 1)], "id int, created_at timestamp_ntz, valid int")
    table = recommendation.fast_order_tracking(tracked, found, order, order_line)
    assert {r.id: (r.RecommendationFunnel1, r.RecommendationFunnel2) for r in table.collect()} == {
        10: ("PURCHASE", "PERFECT_MATCH"),
        20: ("PURCHASE", "ADD"),
        30: ("PURCHASE", "DROP"),
        40: ("PURCHASE", "PARTIAL_MATCH"),
        50: ("PURCHASE", "PARTIAL_MATCH"),
        60: ("PURCHASE", "ADD"),
        70: ("PURCHASE", "DROP"),
        80: ("NO PURCHASE", None),
        90: ("PURCHASE", None),
    }
    assert rows(table.where("id = 10"), "order_valid") == [(1,)]
    flags = recommendation.found_line(found, tracked, order_line)
    assert rows(flags.where("fastOrderTrackingId in (30, 50, 80)")) == [
        (30, 1, "PURCHASE"), (30, 2, "NOT PURCHASE"), (50, 1, "NOT PURCHASE"), (80, 1, "NOT PURCHASE"),
    ]


def test_hours(spark, rows):
    hours = dimensions.dim_hours_order(spark)
    assert hours.count() == 24
    assert rows(hours.where("Hourid in (0, 8, 12, 13, 18, 19, 23)")) == [
        (0, "00 to 01", "OOO", 1),
        (12, "12 to 13", "MORNING", 2),
        (13, "13 to 14", "AFTERNOON", 3),
        (18, "18 to 19", "AFTERNOON", 3),
        (19, "19 to 20", "OOO", 1),
        (23, "23 to 24", "OOO", 1),
        (8, "08 to 09", "MORNING", 2),
    ]


def test_refresh_writes_every_table_in_order(spark, tmp_path):
    from bindings.staging import staging

    folder = str(tmp_path)
    sf_dir = "/root/testdata/sf0.001"
    wanted = [
        "Fact_Order", "Fact_Order_Line", "Fast_Order_Tracking", "Fast_Order_Tracking_Found_line",
        "Dim_Sys_Users_Member", "Dim_SysUser_ProductCategory", "Dim_Brand",
    ]
    done = refresh(
        lambda name: staging(spark, sf_dir, name),
        lambda name: spark.read.parquet(f"{folder}/{name}"),
        lambda df, name: df.write.mode("overwrite").parquet(f"{folder}/{name}"),
        dt.date(2025, 12, 31),
        wanted,
    )
    assert sorted(done) == sorted(wanted)
    assert done.index("Fact_Order_Line") < done.index("Fast_Order_Tracking")
    funnel = spark.read.parquet(f"{folder}/Fast_Order_Tracking")
    assert funnel.count() == staging(spark, sf_dir, "fast_order_tracking").count()


def test_every_mart_table_is_declared_after_its_inputs():
    tables = mart_tables(dt.date(2024, 1, 1))
    assert len(tables) == 40
    seen = set()
    for name, table in tables.items():
        assert all(i in seen for i in table.inputs if i in tables), name
        seen.add(name)


def test_scopes_give_what_users_times_members_give(spark, rows):
    rng = random.Random(4)
    members = spark.createDataFrame([(n, None if n == 9 else str(n % 4)) for n in range(12)], "id int, country_id string")
    roles = ["ADMIN", "GLOBAL_REPORT", "COUNTRY_ADMIN", "COUNTRY_MANAGER_ADMIN", "REP", None]
    users = [(n, rng.choice(roles), rng.choice(["a@b", "none"]), rng.choice(["0", "1", "9", None])) for n in range(40)]
    users += [(3, "COUNTRY_ADMIN", "x@y", "2"), (4, "ADMIN", "x@y", None)]  # several roles
    sys_user = spark.createDataFrame(users, "user_id int, role string, email string, country_id string")
    listed = spark.createDataFrame([(rng.randint(0, 45), rng.randint(0, 14)) for _ in range(60)], "sys_user int, member int")
    facts = spark.createDataFrame([(rng.randint(0, 16), n) for n in range(200)], "member int, amount long")

    expanded = access.sys_users_member(listed, sys_user, members).select("sys_user", "member").distinct()
    plain = expanded.join(facts, "member").groupBy("sys_user").agg(F.sum("amount").alias("amount"))
    scopes = access.user_scopes(listed, sys_user, members)
    assert rows(access.totals_by_user(facts, scopes, members, "amount")) == rows(plain)
    assert scopes.count() == scopes.distinct().count() < expanded.count()

    known = expanded.where("member < 12")
    for user in (0, 3, 4, 17, 44):
        assert rows(access.members_of(F.lit(user), scopes, members)) == rows(known.where(F.col("sys_user") == user).select("member"))
    for member in (0, 9, 11):
        assert rows(access.users_of(F.lit(member), scopes, members)) == rows(known.where(F.col("member") == member).select("sys_user"))
