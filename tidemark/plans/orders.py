"""Order facts: orders, order lines, rates, targets and survey scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import dates, nulls, text
from tidemark.operators import aggregates, joins, windows
from tidemark.plans.promotions import promo_components

# Statuses and labels shared with the consumers of the mart.
INVALID_ORDER = ["cancelled", "not_approved"]
INVALID_LINE = ["cancelled", "not_approved", "returned"]
CANCELLED = "cancelled"
PARTIAL, TOTAL = "Partial", "Total"
NORMAL_PRODUCT, PROMO_PRODUCT, PROMO_COMPONENT = "Normal Product", "Promo Product", "Promo Normal Product"
NPS_BANDS = [(6, "Detractor"), (8, "Passive")]
NPS_BEST = "Promoter"


def _status_in(statuses: list[str]) -> Column:
    return F.coalesce(F.col("status").isin(statuses), F.lit(False))


def _line_value() -> Column:
    return F.col("current_quantity") * F.col("current_unit_price") - F.col("discount")


def fact_rate(rate: DataFrame) -> DataFrame:
    period = dates.period_key(F.col("calendar_year"), F.col("calendar_month"))
    return rate.select(
        F.col("id_country").alias("country_id"),
        "calendar_year",
        "calendar_month",
        "rate",
        text.key_of(F.col("id_country"), period, sep="|").alias("key_rate"),
    )


def line_totals(order_line: DataFrame) -> DataFrame:
    """Per order: lines, cancelled lines, value of the valid and of the cancelled lines."""
    cancelled = F.col("status") == CANCELLED
    return order_line.groupBy(F.col("order").alias("id")).agg(
        F.count("*").alias("total_lines"),
        aggregates.sum_where(cancelled).alias("total_cancelled_lines"),
        aggregates.sum_where(~_status_in(INVALID_LINE), _line_value()).alias("total_amount"),
        aggregates.sum_where(cancelled, _line_value()).alias("cancelled_amount"),
    )


def first_sales_rep(sales_rep: DataFrame, sales_rep_business: DataFrame) -> DataFrame:
    """Lowest sales rep id per chain and business."""
    reps = sales_rep.select(F.col("id").alias("sales_rep_id"), "chain_id")
    return (
        sales_rep_business.select("sales_rep_id", "business_id")
        .join(reps, "sales_rep_id")
        .groupBy("chain_id", "business_id")
        .agg(F.min("sales_rep_id").alias("_first_rep"))
    )


def order_validity(order: DataFrame) -> DataFrame:
    """Order id, time and validity: what the order fact says about an order without looking anything up."""
    return order.select("id", "created_at", _valid_order().alias("valid"))


def _valid_order() -> Column:
    return F.when(_status_in(INVALID_ORDER), 0).otherwise(1)


def fact_order(order, user, rate, sales_rep, sales_rep_business, order_line, width: int = 1 << 20) -> DataFrame:
    """Orders with validity, monthly rate, sales rep, line totals and the gap to the previous order.

    The previous order of a chain and business goes by order id, so a gap can be negative.
    """
    created = F.col("created_at")
    chained = windows.previous_within(
        order.withColumnRenamed("business", "business_id"),
        ["chain_id", "business_id"],
        "id",
        {"created_at": "previous_chain_business_order_date"},
        width,
    )
    users = user.select(F.col("id").alias("user_id"), F.col("sales_rep").alias("user_sales_rep_id"))
    # the rate key is country|yyyymm; the join runs on its three parts
    rates = rate.select(
        F.col("id_country").cast("string").alias("_country"),
        F.col("calendar_year").alias("_year"),
        F.col("calendar_month").alias("_month"),
        "rate",
    )
    same_period = (
        (F.col("country_id").cast("string") == F.col("_country"))
        & (F.year(created) == F.col("_year"))
        & (F.month(created) == F.col("_month"))
    )
    lines, cancelled = F.col("total_lines"), F.col("total_cancelled_lines")
    previous = F.col("previous_chain_business_order_date")
    return (
        chained.join(users, "user_id", "left")
        .join(rates, same_period, "left")
        .join(first_sales_rep(sales_rep, sales_rep_business), ["chain_id", "business_id"], "left")
        .join(line_totals(order_line), "id", "left")
        .select(
            "id", "client_order_number", "chain_id", "business_id", "user_id", "user_sales_rep_id",
            "distributor_id", "country_id", "status",
            _valid_order().alias("valid"),
            "original_created_at", "created_at", "updated_at", "observation", "updated_by", "customer",
            "day_of_preference", "delivery_cost",
            text.key_of(F.col("country_id"), dates.period_of(created), sep="|").alias("key_rate"),
            "rate",
            F.coalesce("user_sales_rep_id", "_first_rep").alias("sales_rep_id"),
            text.key_of(F.col("business_id"), F.col("chain_id"), sep="-").alias("business_chain"),
            "total_lines",
            F.round("total_amount", 2).alias("total_amount"),
            F.when(cancelled > 0, F.when(cancelled == lines, TOTAL).otherwise(PARTIAL)).alias("cancellation_status"),
            "total_cancelled_lines", "cancelled_amount",
            "previous_chain_business_order_date",
            dates.days_between(previous, created).alias("days_from_last_order"),
        )
    )


def _expansions(promo_product: DataFrame, product: DataFrame) -> DataFrame:
    """What an ordered promotion turns into: itself once, and once per component that is a known product."""
    known = promo_product.select("promo_id", "product_id", "quantity").join(
        product.select(F.col("id").alias("product_id")), "product_id"
    )
    components = promo_components(known).select(
        "promo_id",
        F.lit(1).alias("_transformed"),
        F.col("product_id").alias("_component"),
        F.col("quantity").alias("_units"),
        F.col("rn").alias("_rn"),
        F.col("promo_type").alias("_promo_type"),
    )
    itself = promo_product.select("promo_id").distinct().withColumn("_transformed", F.lit(0))
    return components.unionByName(itself, allowMissingColumns=True)


def _sold(order_line, order, promo_product, product) -> DataFrame:
    """What each product of an order turns into, with the country of the order: keys and looked-up values only.

    A product that is no promotion meets nothing and passes once, a promotion meets itself and each of its components.
    Products with and without a match are found apart, so that a promotion which is sold very often, or has very many
    components, can be split. Products travel in a struct, which is never null: so both sides ask for the same rows, and
    these are shuffled once.
    """
    orders = order.select(F.col("id").alias("order"), F.col("country_id").alias("_order_country"))
    expansions = _expansions(promo_product, product).where(F.col("promo_id").isNotNull())
    expansions = expansions.withColumn("_sold", F.struct(F.col("promo_id").alias("product_id")))
    pairs = order_line.select("order", "product_id").distinct().join(orders, "order")
    pairs = pairs.select("order", "_order_country", F.struct("product_id").alias("_sold"))
    found = joins.left_join_many(pairs, expansions.withColumnRenamed("promo_id", "_promo"), ["_sold"])
    return found.withColumnRenamed("order", "_order").withColumn("_sold", F.col("_sold.product_id"))


def fact_order_line(order_line, order, promo_product, product) -> DataFrame:
    """Order lines as sold, plus one line per component of every promotion sold.

    Orders and promotions are looked up for the different products of an order, so whole lines are shuffled once: to meet
    what their order and product turn into.
    """
    cancelled = F.col("status") == CANCELLED
    invalid = _status_in(INVALID_LINE)
    quantity, value = F.col("current_quantity"), _line_value()
    same = (F.col("order") == F.col("_order")) & F.col("product_id").eqNullSafe(F.col("_sold"))
    expanded = (
        order_line.join(_sold(order_line, order, promo_product, product), same)
        .withColumn("country_id", F.col("_order_country"))
        .withColumns(
            {
                "excise": dates.excise(F.col("country_id"), F.year("created_at")),
                "valid": F.when(invalid, 0).otherwise(1),
                "current_quantity_final": F.when(invalid, F.lit(0)).otherwise(quantity),
                "line_amount": F.when(invalid, F.lit(0)).otherwise(value),
                "cancelled_quantity": F.when(cancelled, quantity).otherwise(F.lit(0)),
                "cancelled_amount": F.when(cancelled, value).otherwise(F.lit(0)),
                "cancellation_id": F.when(cancelled, F.col("cancellation_id")),
            }
        )
    )

    is_component = F.coalesce(F.col("_transformed") == 1, F.lit(False))
    units, position = F.col("_units"), F.col("_rn")

    def times_units(column: str) -> Column:
        return F.when(is_component, units * F.col(column)).otherwise(F.col(column)).alias(column)

    def on_first(column: str) -> Column:
        """Amounts of a promotion sit on its first component, so that sums stay right."""
        return F.when(~is_component | (position == 1), F.col(column)).alias(column)

    def per_unit(column: str) -> Column:
        spread = F.when(units == 0, F.lit(0)).when(position == 1, F.try_divide(F.col(column), units))
        return F.when(is_component, spread).otherwise(F.col(column)).alias(column)

    def component_only(value: Column, name: str) -> Column:
        return F.when(is_component, value).alias(name)

    plain_id = F.col("id").cast("string")
    return expanded.select(
        "line_number",
        F.when(is_component, text.key_of(plain_id, position, sep="/")).otherwise(plain_id).alias("id_surrogate"),
        F.when(is_component, F.col("_component")).otherwise(F.col("product_id")).alias("product_id"),
        times_units("current_quantity"),
        per_unit("current_unit_price"),
        "delivery_date", "invoice_number", "status", "excise", "valid",
        times_units("current_quantity_final"),
        on_first("line_amount"),
        times_units("cancelled_quantity"),
        on_first("cancelled_amount"),
        "cancellation_id", "updated_at", "updated_by", "order", "country_id",
        on_first("uom"),
        "id", "observation", "created_at", "payment_date", "invoice_date",
        on_first("discount"),
        on_first("taxes"),
        "presentation", "presentation_quantity",
        per_unit("cost_per_unit"),
        nulls.flag(is_component).alias("line_transformed"),
        F.when(is_component, PROMO_COMPONENT)
        .when(F.col("_promo").isNotNull(), PROMO_PRODUCT)
        .otherwise(NORMAL_PRODUCT)
        .alias("product_flag"),
        component_only(position, "promo_row"),
        component_only(F.col("_promo"), "promo_id"),
        component_only(F.col("_component"), "promo_product_id"),
        component_only(F.col("_promo_type"), "promo_type"),
    )


def fact_target(target: DataFrame, rate: DataFrame) -> DataFrame:
    """Monthly targets in local currency and converted, with fiscal month and excise."""
    year, month = F.col("calendar_year"), F.col("calendar_month")
    key = ["id_country", "calendar_year", "calendar_month"]
    period = dates.period_key(year, month)
    return target.join(rate.select(*key, "rate"), key, "left").select(
        F.col("id_country").alias("country_id"),
        "calendar_year",
        "calendar_month",
        "target",
        text.key_of(F.col("id_country"), period, sep="|").alias("key_rate"),
        dates.fiscal_month(month).alias("order_month"),
        dates.period_start(year, month).alias("Fecha"),
        "rate",
        (F.col("target") * F.col("rate")).alias("target_euros"),
        period.alias("Year_Month"),
        dates.excise(F.col("id_country"), year).alias("excise"),
    )


def nps_category(score: Column) -> Column:
    bands = F.when(score <= NPS_BANDS[0][0], NPS_BANDS[0][1])
    for limit, name in NPS_BANDS[1:]:
        bands = bands.when(score <= limit, name)
    return bands.otherwise(NPS_BEST)


def fact_nps_result(nps: DataFrame, chain: DataFrame, above: int = 0) -> DataFrame:
    """Survey answers with their category and the chain name; scores up to ``above`` are left out."""
    chains = chain.select(F.col("id").alias("chain_id"), F.col("name").alias("WHS_name"))
    return (
        nps.where(F.col("score") > above)
        .join(chains, "chain_id", "left")
        .select(
            "survey_start_date", "survey_end_date", "chain_id", "business_id", "score",
            nps_category(F.col("score")).alias("category"),
            "date", "country_id", "order_id", "comment", "WHS_name",
        )
    )
