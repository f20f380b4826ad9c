"""The sales mart as a whole: every table with the tables it is made from, refreshed in that order."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame

from tidemark.plans import access, copies, dimensions, orders, promotions, recommendation, tracking


@dataclass(frozen=True)
class Table:
    """How one mart table is made. Inputs are staging tables, or mart tables written before."""

    make: Callable[..., DataFrame]
    inputs: tuple[str, ...]


def _table(make: Callable[..., DataFrame], *inputs: str) -> Table:
    return Table(make, inputs)


def mart_tables(as_of: dt.date) -> dict[str, Table]:
    """All tables made from others, each after the mart tables it needs. ``as_of`` is the day of the refresh."""
    dims, facts = dimensions, orders
    business_inputs = ("business", "order", "image_level", "channel", "sub_channel", "city", "chain_business")
    order_inputs = ("order", "user", "rate", "sales_rep", "sales_rep_business", "order_line")
    product_inputs = (
        "product", "product_type", "tier", "segment", "sub_brand", "product_category", "super_category",
    )
    derived = {
        "Dim_Product": _table(dims.dim_product, *product_inputs),
        "Dim_Business": _table(partial(dims.dim_business, as_of=as_of), *business_inputs),
        "Dim_User": _table(dims.dim_user, "user", "position"),
        "Dim_Sales_Rep": _table(dims.dim_sales_rep, "sales_rep", "sales_rep_business", "business", "country"),
        "Dim_Chain": _table(dims.dim_chain, "chain"),
        "Dim_Sales_Rep_Business": _table(dims.dim_sales_rep_business, "sales_rep_business", "sales_rep"),
        "Dim_Business_Chain_User": _table(
            dims.dim_business_chain_user, "business_user", "sales_rep_business", "sales_rep"
        ),
        "Dim_Chain_Business": _table(dims.dim_chain_business, "chain_business", "business", "channel"),
        "Dim_Country": _table(dims.dim_country, "country"),
        "Dim_Promo_by_Business": _table(
            promotions.promo_by_business, "business", "promo_business", "promo_channel", "promo_subchannel"
        ),
        "Dim_Promo_Product": _table(promotions.dim_promo_product, "promo_product"),
        "Fact_Order": _table(facts.fact_order, *order_inputs),
        "Fact_Order_Line": _table(facts.fact_order_line, "order_line", "order", "promo_product", "product"),
        "Dim_Hours_Order": _table(lambda any_table: dims.dim_hours_order(any_table.sparkSession), "country"),
        "Fact_NPS_Result": _table(facts.fact_nps_result, "nps", "chain"),
        "Fact_Rate": _table(facts.fact_rate, "rate"),
        "Fact_Target": _table(facts.fact_target, "target", "rate"),
        "Fact_Notification_Tracking": _table(
            tracking.fact_notification_tracking,
            "notification", "product", "cart", "cart_line", "order", "order_line",
        ),
        "Dim_Sys_Users_Chain": _table(access.sys_users_chain, "sys_user_chain", "sys_user"),
        "Dim_Sys_Users_Member": _table(access.sys_users_member, "user_member", "sys_user", "member"),
        "Dim_SysUser_ProductCategory": _table(
            access.sysuser_product_category, "user_member", "sys_user", "member", "brand", "product"
        ),
        "Dim_Product_Category": _table(dims.dim_product_category, "product_category"),
        "Dim_Member_Business": _table(access.member_business, "member_chain", "chain_business"),
        "Fast_Order_Tracking_Found_line": _table(
            recommendation.found_line, "found_line", "fast_order_tracking", "Fact_Order_Line"
        ),
        "Fast_Order_Tracking": _table(
            recommendation.fast_order_tracking, "fast_order_tracking", "found_line", "Fact_Order", "Fact_Order_Line"
        ),
    }
    copied = {target: _table(copies.copy_table, source) for target, source in copies.COPIES.items()}
    return {**copied, **derived}


def refresh(
    read_staging: Callable[[str], DataFrame],
    read_mart: Callable[[str], DataFrame],
    write_mart: Callable[[DataFrame, str], None],
    as_of: dt.date,
    targets: Iterable[str] | None = None,
) -> list[str]:
    """Makes and writes the tables, all or the named ones. A table made from mart tables reads them as written."""
    tables = mart_tables(as_of)
    wanted = list(tables) if targets is None else [name for name in tables if name in set(targets)]
    for name in wanted:
        table = tables[name]
        inputs = [read_mart(i) if i in tables else read_staging(i) for i in table.inputs]
        write_mart(table.make(*inputs), name)
    return wanted
