"""Tables that go into the mart unchanged: one operator and a registry."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Mart table and the staging table it copies.
COPIES = {
    "Dim_Brand": "brand",
    "Dim_Product_Chain": "product_chain",
    "Dim_Member": "member",
    "Dim_Distribution": "distribution",
    "Dim_Member_chain": "member_chain",
    "Dim_Promo_Channel": "promo_channel",
    "Dim_Promo_SubChannel": "promo_subchannel",
    "Dim_Promo_Image_Level": "promo_image_level",
    "Dim_Promo_Business": "promo_business",
    "Dim_Promo_Business_Type": "promo_business_type",
    "Fact_Analytics_Search": "analytics_search",
    "Dim_Sys_Users": "sys_user",
    "Fact_Stock": "stock_level",
    "Dim_Cancellation_Reason": "cancellation_reason",
    "Fast_Order_Tracking_Not_Found_line": "not_found_line",
}


def copy_table(source: DataFrame) -> DataFrame:
    return source.select("*")
