"""Recommended baskets against what was ordered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import nulls
from tidemark.plans.orders import NORMAL_PRODUCT, PROMO_PRODUCT

# Labels shared with the consumers of the mart.
PURCHASE, NOT_PURCHASE, NO_PURCHASE = "PURCHASE", "NOT PURCHASE", "NO PURCHASE"
PERFECT, ADD, DROP, PARTIAL = "PERFECT_MATCH", "ADD", "DROP", "PARTIAL_MATCH"


def _counts_as_purchase() -> Column:
    as_sold = F.col("product_flag").isin([NORMAL_PRODUCT, PROMO_PRODUCT]) & (F.col("valid") == 1)
    return F.coalesce(as_sold, F.lit(False))


def found_line(found: DataFrame, tracking: DataFrame, order_line: DataFrame) -> DataFrame:
    """Recommended products of known trackings, each with a flag: bought in the order of the tracking or not."""
    trackings = tracking.select(F.col("id").alias("fastOrderTrackingId"), F.col("orderId").alias("order"))
    bought = (
        order_line.where(_counts_as_purchase())
        .select("order", F.col("product_id").alias("productId"))
        .join(trackings, "order")
        .select("fastOrderTrackingId", "productId")
        .distinct()
        .withColumn("_bought", F.lit(True))
    )
    return (
        found.where(F.col("productId").isNotNull())
        .join(trackings.select("fastOrderTrackingId"), "fastOrderTrackingId", "left_semi")
        .join(bought, ["fastOrderTrackingId", "productId"], "left")
        .select(
            *found.columns, F.when(F.col("_bought"), PURCHASE).otherwise(NOT_PURCHASE).alias("product_purchase")
        )
    )


def basket_difference(tracking: DataFrame, found: DataFrame, order_line: DataFrame) -> DataFrame:
    """Per order: recommendations that were not bought, and lines that were not recommended.

    Both sides are counted per order, tracking and product in one aggregation instead of being joined to each other. A
    line that is invalid or stems from an expanded promotion never matches, so it counts as not recommended.
    """
    trackings = tracking.where(F.col("orderId").isNotNull()).select(
        F.col("id").alias("tracking_id"), F.col("orderId").alias("order")
    )
    recommended = found.select(
        F.col("fastOrderTrackingId").alias("tracking_id"),
        F.col("productId").alias("product"),
        F.lit(1).alias("recommended"),
        F.lit(0).alias("matching"),
        F.lit(0).alias("other"),
    ).join(trackings, "tracking_id")
    counts = _counts_as_purchase()
    ordered = order_line.select(
        "order",
        F.col("product_id").alias("product"),
        F.lit(0).alias("recommended"),
        nulls.flag(counts).alias("matching"),
        nulls.flag(~counts).alias("other"),
    ).join(trackings, "order")
    per_product = (
        recommended.unionByName(ordered)
        .groupBy("order", "tracking_id", "product")
        .agg(*[F.sum(c).alias(c) for c in ("recommended", "matching", "other")])
    )
    known = F.col("product").isNotNull()
    not_bought = F.when(known & (F.col("matching") == 0), F.col("recommended")).otherwise(F.lit(0))
    not_recommended = F.when(
        known, F.col("other") + F.when(F.col("recommended") == 0, F.col("matching")).otherwise(F.lit(0))
    ).otherwise(F.lit(0))
    return per_product.groupBy("order").agg(
        F.sum(not_bought).alias("not_bought"), F.sum(not_recommended).alias("not_recommended")
    )


def fast_order_tracking(tracking, found, order, order_line) -> DataFrame:
    """Trackings with the two funnel labels and the order they led to."""
    dropped, added = F.col("not_bought"), F.col("not_recommended")
    label = (
        F.when(dropped.isNull(), F.lit(None).cast("string"))
        .when((dropped == 0) & (added == 0), PERFECT)
        .when(dropped == 0, ADD)
        .when(added == 0, DROP)
        .otherwise(PARTIAL)
    )
    orders = order.select(
        F.col("id").alias("orderId"),
        F.col("created_at").alias("order_created_at"),
        F.col("valid").alias("order_valid"),
    )
    difference = basket_difference(tracking, found, order_line).withColumnRenamed("order", "orderId")
    return (
        tracking.join(orders, "orderId", "left")
        .join(difference, "orderId", "left")
        .select(
            *tracking.columns,
            F.when(F.col("orderId").isNull(), NO_PURCHASE).otherwise(PURCHASE).alias("RecommendationFunnel1"),
            label.alias("RecommendationFunnel2"),
            "order_created_at",
            "order_valid",
        )
    )


def hits_of_property(hits: DataFrame, property_id: str, hosts: list[str]) -> DataFrame:
    """Web hits of one property on the given hosts, marked as enabled."""
    wanted = (F.col("WEB_PROPERTY_ID") == property_id) & F.col("HITS_PAGE_HOSTNAME").isin(hosts)
    return hits.where(wanted).withColumn("Enabled", F.lit(1))
