"""Notifications that led to a cart and an order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = ["country", "chain", "business", "user_id", "promotion_id"]


def _last_event(header: DataFrame, line: DataFrame, line_header: str, line_product: str, name: str) -> DataFrame:
    """Latest header timestamp per country, chain, business, user and product."""
    lines = line.select(F.col(line_header).alias("id"), F.col(line_product).alias("promotion_id"))
    headers = header.select(
        "id",
        F.col("country_id").alias("country"),
        F.col("chain_id").alias("chain"),
        "business",
        "user_id",
        "created_at",
    )
    return (
        lines.where(F.col("promotion_id").isNotNull())
        .join(headers, "id")
        .groupBy(*KEY)
        .agg(F.max("created_at").alias(name))
    )


def _if_later(moment: str, than: Column) -> Column:
    return F.when(F.col(moment) > than, F.col(moment))


def fact_notification_tracking(notification, product, cart, cart_line, order, order_line) -> DataFrame:
    """Each notification with its cart time, if later than the opening, and its order time, if later than that.

    Only the latest cart and the latest order of the same user, business and product count.
    """
    products = product.select(F.col("id").alias("promotion_id"), F.col("name").alias("product"))
    notes = notification.withColumnsRenamed({"business_id": "business"}).join(products, "promotion_id", "left")
    carted = _last_event(cart, cart_line, "cart", "product", "_cart_at")
    ordered = _last_event(order, order_line, "order", "product_id", "_order_at")
    return (
        notes.join(carted, KEY, "left")
        .join(ordered, KEY, "left")
        .withColumn("add_to_cart_at", _if_later("_cart_at", F.col("opened_at")))
        .select(
            "country", "business", "chain", "user_id", "promotion_id", "product", "configuration_id",
            "created_at", "sent_at", "opened_at", "add_to_cart_at",
            _if_later("_order_at", F.col("add_to_cart_at")).alias("bought_at"),
        )
    )
