"""Dimensions of the sales mart. Every function takes staging DataFrames and returns one mart table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import dates, nulls, text
from tidemark.operators import joins

# Codes and labels shared with the consumers of the mart.
NINE_LITRE_CASE = "9LC"
NINE_LITRE_FACTOR = 0.11111111
PRODUCT_TYPES = {1: "Product", 2: "Promotion"}
BUSINESS_STATUS = {-1: "Pending", 0: "Inactive", 1: "Active", 2: "Rejected", 3: "Closed"}
CHANNEL_GROUPS = [
    ("On Trade", [2, 9, 10, 11, 14, 16, 17, 18, 20, 21, 23, 24]),
    ("Tradi Off.Trade", [1, 12, 15, 19, 22]),
    ("Tier-2 WHS", [4, 25]),
    ("Online sellers", [13]),
]
OTHER_CHANNELS = "OTHERS"
TYPED_BUSINESS_COUNTRY = "13"
SPANISH_COUNTRIES = ["Colombia", "España", "Mexico"]
SPANISH, ENGLISH = "es-ES", "en-US"
COUNTRY_CODES = {"Mexico": "MX", "Singapore": "SG"}
MILLIONS_COUNTRY = "Colombia"


def _label(code: Column, labels: dict) -> Column:
    """Code to label, null for an unknown code."""
    result = F.lit(None).cast("string")
    for value, name in labels.items():
        result = F.when(code == value, name).otherwise(result)
    return result


def _prefixed(df: DataFrame, key: str, key_as: str, columns: dict[str, str]) -> DataFrame:
    """A lookup table cut down to its key and the renamed columns needed from it."""
    return df.select(F.col(key).alias(key_as), *[F.col(c).alias(name) for c, name in columns.items()])


def dim_product(product, product_type, tier, segment, sub_brand, product_category, super_category) -> DataFrame:
    """Products with the names of all their lookups."""
    categories = _prefixed(
        product_category,
        "id",
        "category_id",
        {"name": "category_name", "active": "category_acive", "super_category_id": "super_category_id"},
    )
    supers = super_category.select(
        F.col("id").alias("super_category_id"),
        F.col("name").alias("super_category_name"),
        F.col("active").alias("super_category_active"),
        F.when(F.col("include_in_lc_reports") == 1, "Y").otherwise("N").alias("super_category_9LC_calculation"),
    )
    types = _prefixed(
        product_type, "id", "product_type", {"name": "product_type_name", "active": "product_type_active"}
    )
    segments = _prefixed(
        segment, "id", "segment_id", {"name": "segment_name", "description": "segment_description"}
    )
    joined = (
        product.withColumnRenamed("product_category_id", "category_id")
        .join(types, "product_type", "left")
        .join(_prefixed(tier, "id", "tier_iid", {"name": "tier_name"}), "tier_iid", "left")
        .join(segments, "segment_id", "left")
        .join(sub_brand.select("sub_brand_id", "sub_brand_name"), "sub_brand_id", "left")
        .join(categories, "category_id", "left")
        .join(supers, "super_category_id", "left")
    )
    measure = F.col("volume_measure")
    return joined.select(
        "id", "name", "active", "sku", "ean", "product_type", "product_type_name", "product_type_active",
        "volume", "volume_measure",
        F.when(measure == NINE_LITRE_CASE, NINE_LITRE_FACTOR).otherwise(1.0).alias("factor"),
        "country_id", "tier_iid", "tier_name", "type",
        _label(F.col("type"), PRODUCT_TYPES).alias("type_name"),
        "brand_id", "sub_brand_id", "sub_brand_name", "segment_id", "segment_name", "segment_description",
        "manufacturer", "history", "quantity_per_case", "primary_UOM", "secondary_UOM", "content",
        "start_date", "end_date", "category_id", "category_name",
        text.key_of(F.col("category_name"), measure, sep=" - ").alias("category_measure"),
        "category_acive", "super_category_id", "super_category_name", "super_category_active",
        "super_category_9LC_calculation", "image_url",
    )


def channel_groups(channel: DataFrame) -> DataFrame:
    """Channel id with its reporting group and the position of that group."""
    name, position = F.lit(OTHER_CHANNELS), F.lit(len(CHANNEL_GROUPS) + 1)
    for order, (group, ids) in enumerate(CHANNEL_GROUPS, start=1):
        member = F.col("id").isin(ids)
        name, position = F.when(member, group).otherwise(name), F.when(member, order).otherwise(position)
    return channel.select(
        F.col("id").alias("channel_id"), name.alias("channel_group"), position.alias("channel_group_order")
    )


def with_active_period(business: DataFrame, order: DataFrame) -> DataFrame:
    """When a business was active: open-ended while active, else to the end of the month of its last order."""
    ordered = order.groupBy(F.col("business").alias("id")).agg(
        F.max("created_at").alias("_last_order"), F.lit(1).alias("_has_orders")
    )
    active = F.col("active") == 1
    was_active = active | F.col("_has_orders").isNotNull()
    end = F.when(active, F.lit(dates.OPEN_END).cast("date")).when(
        was_active, F.last_day(F.col("_last_order").cast("date"))
    )
    return (
        business.join(ordered, "id", "left")
        .withColumns(
            {
                "active_new": nulls.flag(was_active),
                "active_start_date": F.col("created_at").cast("date"),
                "active_end_date": end,
            }
        )
        .drop("_last_order", "_has_orders")
    )


def dim_business(
    business, order, image_level, channel, sub_channel, city, chain_business, as_of: dt.date
) -> DataFrame:
    """Businesses with channel, city, status, active period and days since registration and last order."""
    channels = _prefixed(
        channel, "id", "channel_id", {"name": "channel_name", "description": "channel_description"}
    )
    subs = _prefixed(
        sub_channel, "id", "sub_channel_id", {"name": "sub_channel_name", "description": "sub_channel_description"}
    )
    cities = _prefixed(city, "id", "city_id", {"name": "city_name", "state": "state"})
    typed = (
        chain_business.where(F.col("business_type").isNotNull())
        .groupBy(F.col("business_id").alias("_typed_id"))
        .agg(F.max("business_type_description").alias("business_type"))
    )
    # the type is looked up for one country only; businesses elsewhere stay, without a type
    typed_here = (F.col("id") == F.col("_typed_id")) & (
        F.col("country_id").cast("string") == TYPED_BUSINESS_COUNTRY
    )
    today = F.lit(as_of)
    return (
        with_active_period(business, order)
        .join(_prefixed(image_level, "id", "image_level_id", {"name": "image_level_name"}), "image_level_id", "left")
        .join(channels, "channel_id", "left")
        .join(channel_groups(channel), "channel_id", "left")
        .join(subs, "sub_channel_id", "left")
        .join(cities, "city_id", "left")
        .join(typed, typed_here, "left")
        .select(
            "id", "name", "channel_id", "channel_name", "channel_description",
            "sub_channel_id", "sub_channel_name", "sub_channel_description",
            "channel_group", "channel_group_order", "image_level_id", "image_level_name",
            "city_id", "city_name", "state", "country_id", "position_id", "active",
            _label(F.col("active"), BUSINESS_STATUS).alias("business_status"),
            "reporting", "created_at", "updated_at", "first_order_date", "last_order_date",
            "business_type", "invitation_code",
            dates.registered_month(F.col("created_at")).alias("registered_month"),
            dates.fiscal_quarter(F.col("created_at")).alias("registered_qtr"),
            dates.days_between(F.col("created_at"), today).alias("days_since_reg"),
            dates.days_between(F.col("last_order_date"), today).alias("days_since_last_order"),
            "active_new", "active_start_date", "active_end_date",
        )
    )


def dim_user(user: DataFrame, position: DataFrame) -> DataFrame:
    return user.join(
        _prefixed(position, "id", "position_id", {"name": "position_name"}), "position_id", "left"
    ).select(
        "id", "position_id", "position_name", "country_id", F.col("sales_rep").alias("sales_rep_id"),
        "email", "phone", "push_notification", "email_notification", "sms_notification",
        "whatsapp_notification", "created_at", "registration_date", "last_login_date",
    )


def country_language(country_name: Column) -> Column:
    return F.when(country_name.isin(SPANISH_COUNTRIES), SPANISH).otherwise(ENGLISH)


def dim_sales_rep(sales_rep, sales_rep_business, business, country) -> DataFrame:
    """Sales reps with full name and the language of the country of their lowest business id."""
    first_business = sales_rep_business.groupBy(F.col("sales_rep_id").alias("id")).agg(
        F.min("business_id").alias("_business")
    )
    countries = country.select(
        F.col("id").cast("string").alias("_country"), country_language(F.col("name")).alias("language")
    )
    homes = (
        first_business.join(
            business.select(F.col("id").alias("_business"), F.col("country_id").cast("string").alias("_country")), "_business"
        )
        .join(countries, "_country")
        .select("id", "language")
    )
    return sales_rep.join(homes, "id", "left").select(
        "id", "email", "chain_id", "name", "last_name",
        text.full_name(F.col("name"), F.col("last_name")).alias("sales_rep"),
        nulls.null_default(F.col("language"), ENGLISH).alias("language"),
    )


def dim_chain(chain: DataFrame) -> DataFrame:
    return chain.select(
        "id", "name", "active", "country_id", "prospects", "chain_tier", "chain_tier_description", "created_at"
    )


def dim_sales_rep_business(sales_rep_business: DataFrame, sales_rep: DataFrame) -> DataFrame:
    reps = sales_rep.select(F.col("id").alias("sales_rep_id"), "chain_id")
    return sales_rep_business.join(reps, "sales_rep_id", "left").select(
        "sales_rep_id",
        "business_id",
        "chain_id",
        text.key_of(F.col("business_id"), F.col("chain_id"), sep="-").alias("business_chain"),
    )


def dim_business_chain_user(business_user: DataFrame, sales_rep_business: DataFrame, sales_rep: DataFrame) -> DataFrame:
    """Users of a business and chain, one row per sales rep of that pair."""
    reps = sales_rep.select(
        F.col("id").alias("sales_rep_id"),
        F.col("email").alias("sales_rep_email"),
        text.full_name(F.col("name"), F.col("last_name")).alias("sales_rep"),
    )
    pairs = dim_sales_rep_business(sales_rep_business, sales_rep).select("business_chain", "sales_rep_id")
    users = business_user.select(
        F.col("business").alias("business_id"),
        F.col("chain").alias("chain_id"),
        F.col("user").alias("user_id"),
        "status",
        "role",
        text.key_with_blanks(F.col("business"), F.col("chain"), sep="-").alias("business_chain"),
    )
    return joins.left_join_many(users, pairs, ["business_chain"]).join(reps, "sales_rep_id", "left").select(
        "business_id", "chain_id", "user_id", "status", "role", "business_chain",
        "sales_rep_id", "sales_rep_email", "sales_rep",
    )


def dim_chain_business(chain_business: DataFrame, business: DataFrame, channel: DataFrame) -> DataFrame:
    code = nulls.null_default(F.col("customer_chain_code"), "0")
    businesses = business.select(
        F.col("id").alias("business_id"),
        F.col("name").alias("business_name"),
        F.col("channel_id").alias("business_channel_id"),
    )
    channels = _prefixed(
        channel,
        "id",
        "business_channel_id",
        {"name": "business_channel_name", "description": "business_channel_description"},
    )
    return (
        chain_business.join(businesses, "business_id", "left")
        .join(channels, "business_channel_id", "left")
        .select(
            "chain_id", "business_id", "business_type",
            code.alias("business_chain_code"), "business_type_description", "business_name",
            text.key_of(code, F.col("business_name"), sep="-").alias("business_code_name"),
            text.key_of(F.col("chain_id"), F.col("business_id"), sep="|").alias("chain_business"),
            "business_channel_id", "business_channel_name", "business_channel_description",
        )
    )


def dim_country(country: DataFrame) -> DataFrame:
    name = F.col("name")
    in_millions = name == MILLIONS_COUNTRY
    return country.select(
        "id", "name", "active", "app_logo", "currency_code", "nps_min", "nps_max", "nps_yellow", "nps_green",
        _label(name, COUNTRY_CODES).alias("country_code_GA"),
        country_language(name).alias("language"),
        F.when(in_millions, "M").otherwise("K").alias("Unit_Measure_GMV"),
        F.when(in_millions, 1_000_000).otherwise(1_000).alias("Local_Currency_Divisor"),
    )


def dim_hours_order(spark) -> DataFrame:
    """The 24 hours with their part of the day."""
    hour = F.col("Hourid")
    # First and last hour, name and position of the parts of the day.
    parts = [(8, 12, "MORNING", 2), (13, 18, "AFTERNOON", 3)]
    name, position = F.lit("OOO"), F.lit(1)
    for first, last, part, order in parts:
        name = F.when(hour.between(first, last), part).otherwise(name)
        position = F.when(hour.between(first, last), order).otherwise(position)
    return spark.range(24).select(F.col("id").cast("int").alias("Hourid")).select(
        "Hourid",
        F.concat(text.zero_padded(hour, 2), F.lit(" to "), text.zero_padded(hour + 1, 2)).alias("HourRange"),
        name.alias("HourDescription"),
        position.alias("HourDescriptionOrder"),
    )


def dim_product_category(product_category: DataFrame) -> DataFrame:
    return product_category.select("id", "name")
