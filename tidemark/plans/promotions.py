"""Promotions: which business may buy which promotion, and what a promotion consists of."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import nulls
from tidemark.operators import joins, sets, windows

# Promotion types.
MIXED_BUNDLE, MULTI_BUY, DISCOUNT = "Mixed Bundle", "Multi Buy", "Discount"


def promo_by_business(business, promo_business, promo_channel, promo_subchannel) -> DataFrame:
    """Promotions of a business by name, by its channel and by its sub-channel, without duplicates.

    What a channel and a sub-channel give together is made distinct for each place, a pair of them, and not for each
    business: no distinct has to hold the result. A place may hold a large share of all businesses, so businesses are
    spread by id while the promotion lists, already distinct, are repeated per salt.
    """
    shops = business.select(F.col("id").alias("business_id"), "channel_id", "sub_channel_id").distinct()
    by_channel = promo_channel.select("channel_id", "product_id").distinct()
    by_subchannel = promo_subchannel.select(F.col("subchannel_id").alias("sub_channel_id"), "product_id").distinct()
    places = shops.select("channel_id", "sub_channel_id").distinct()
    of_place = sets.stack_distinct(places.join(by_channel, "channel_id"), places.join(by_subchannel, "sub_channel_id"))
    # structs are equal if their fields are, also where these are null, as in a distinct
    place = F.struct("channel_id", "sub_channel_id").alias("_place")
    listed = of_place.select(place, "product_id")
    # before they meet their promotions, businesses look small and would be merged into a few tasks
    tasks = int(business.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    named = shops.join(promo_business.select("business_id", "product_id").distinct(), "business_id")
    offer = F.struct("channel_id", "sub_channel_id", "product_id").alias("_offer")
    found = sets.stack(
        named.withColumn("_offer", offer).join(of_place.select(offer), "_offer", "left_anti").drop("_offer"),
        joins.salted_join(shops.withColumn("_place", place), listed, ["_place"], ["business_id"], tasks=tasks).drop("_place"),
    )
    return found.select(
        "business_id",
        *[nulls.null_default(F.col(c), 0).alias(c) for c in ("channel_id", "sub_channel_id", "product_id")],
    )


def _promo_type(components: Column, quantity: Column) -> Column:
    return F.when(components > 1, MIXED_BUNDLE).when(quantity > 1, MULTI_BUY).otherwise(DISCOUNT)


def promo_components(promo_product: DataFrame, width: int = 1 << 16) -> DataFrame:
    """Components of each promotion, largest quantity first, with the promotion type.

    Equal quantities are ordered by product id. One promotion may own any number of rows: they are numbered in chunks
    of one quantity and ``width`` product ids.
    """
    quantity, product = F.col("quantity"), F.col("product_id")
    numbered = windows.number_within(
        promo_product,
        ["promo_id"],
        order=[quantity.desc_nulls_last(), product.asc_nulls_last()],
        chunk=[-quantity, F.floor(product / F.lit(width))],
        number="rn",
        size="_components",
    )
    return numbered.withColumn("promo_type", _promo_type(F.col("_components"), quantity)).drop("_components")


def dim_promo_product(promo_product: DataFrame) -> DataFrame:
    return promo_components(promo_product).select(*promo_product.columns, "promo_type", "rn")
