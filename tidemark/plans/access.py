"""Row-level access: which report user sees which chain, member and product category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import joins, sets

# Roles that see everything, or everything of their country.
GLOBAL_ROLES = ["ADMIN", "GLOBAL_REPORT"]
COUNTRY_ROLES = ["COUNTRY_ADMIN", "COUNTRY_MANAGER_ADMIN"]
EVERYWHERE = "*"


def sys_users_chain(user_chain: DataFrame, sys_user: DataFrame) -> DataFrame:
    users = sys_user.select("user_id", F.col("email").alias("sys_user_email"))
    return user_chain.join(users, "user_id").select(
        F.col("user_id").alias("sys_user"), "chain", "sys_user_email", "country"
    )


def _listed(user_member: DataFrame, sys_user: DataFrame) -> DataFrame:
    """Members a user is listed for, with the user's address and country."""
    users = sys_user.select("user_id", F.col("email").alias("sys_user_email"), "country_id")
    return (
        user_member.select(F.col("sys_user").alias("user_id"), "member")
        .join(users, "user_id")
        .withColumnRenamed("user_id", "sys_user")
    )


def _holders(sys_user: DataFrame) -> DataFrame:
    """Users whose role opens a scope: everything, or everything of their country."""
    opened = F.when(F.col("role").isin(GLOBAL_ROLES), F.lit(EVERYWHERE)).when(
        F.col("role").isin(COUNTRY_ROLES), F.col("country_id").cast("string")
    )
    return (
        sys_user.where(F.col("email").like("%@%"))
        .select(F.col("user_id").alias("sys_user"), F.col("email").alias("sys_user_email"), opened.alias("scope"))
        .where(F.col("scope").isNotNull())
    )


def _scopes() -> Column:
    """The scopes a member belongs to."""
    return F.explode(F.array(F.lit(EVERYWHERE), F.col("country_id").cast("string")))


def sys_users_member(user_member: DataFrame, sys_user: DataFrame, member: DataFrame) -> DataFrame:
    """Members a user sees: the listed ones, and those that come with the role.

    A role opens a scope, every member belongs to the global scope and to that of its country. The scopes meet in an
    equi join, spread by user, so the global scope is never handled by one task. The table names every member that a user
    of a global role sees: users times members is its meaning.
    """
    members = member.select(F.col("id").alias("member"), "country_id", _scopes().alias("scope"))
    by_role = joins.salted_join(_holders(sys_user), members, ["scope"], ["sys_user"])
    columns = ["sys_user", "member", "sys_user_email", "country_id"]
    return sets.stack_distinct(_listed(user_member, sys_user).select(*columns), by_role.select(*columns))


def user_scopes(user_member: DataFrame, sys_user: DataFrame, member: DataFrame) -> DataFrame:
    """``sys_user, scope``: the scopes that make up what a user sees, none inside another.

    A scope is everything, a country, or one member. Who sees everything needs no other scope, and a listed member of a
    country that is seen whole needs none of its own. This is the access of :func:`sys_users_member` without a row for
    each user and member: a few rows for each user.
    """
    held = _holders(sys_user).select("sys_user", "scope").distinct()
    everywhere = held.where(F.col("scope") == EVERYWHERE)
    countries = held.where(F.col("scope") != EVERYWHERE).join(everywhere, "sys_user", "left_anti")
    countries = countries.select("sys_user", _country(F.col("scope")).alias("scope"))
    known = member.select(
        F.col("id").alias("member"), F.lit(EVERYWHERE).alias("_all"), _country(F.col("country_id").cast("string")).alias("_of")
    )
    listed = (
        user_member.select("sys_user", "member")
        .join(sys_user.select(F.col("user_id").alias("sys_user")), "sys_user", "left_semi")
        .distinct()
        .join(known, "member", "left")
    )
    # members that are listed only, and not in the table of members, are in no wider scope
    for wide, column in ((everywhere, "_all"), (countries, "_of")):
        listed = listed.join(wide.withColumnRenamed("scope", column), ["sys_user", column], "left_anti")
    single = listed.select("sys_user", _single(F.col("member")).alias("scope"))
    return everywhere.unionByName(countries).unionByName(single)


def _country(country: Column) -> Column:
    return F.concat(F.lit("country "), country)


def _single(member: Column) -> Column:
    return F.concat(F.lit("member "), member.cast("string"))


def member_scopes(members: DataFrame, member: DataFrame) -> DataFrame:
    """``members`` (a column ``member`` and others), once for each scope they belong to: three at most.

    A member that the ``member`` table lacks belongs to no scope but its own.
    """
    known = member.select(F.col("id").alias("member"), F.col("country_id").cast("string").alias("_country"), F.lit(EVERYWHERE).alias("_all"))
    scopes = F.filter(F.array("_all", _country(F.col("_country")), _single(F.col("member"))), lambda s: s.isNotNull())
    return members.join(known, "member", "left").select(*members.columns, F.explode(scopes).alias("scope"))


def totals_by_user(facts: DataFrame, scopes: DataFrame, member: DataFrame, *totals: str) -> DataFrame:
    """Sums of ``totals`` over all members a user sees, from ``facts`` by ``member``, without joining users to members.

    Facts are summed by member, then by scope; a user adds up the few scopes of :func:`user_scopes`, which do not overlap.
    """
    by_member = facts.groupBy("member").agg(*[F.sum(t).alias(t) for t in totals])
    by_scope = member_scopes(by_member, member).groupBy("scope").agg(*[F.sum(t).alias(t) for t in totals])
    return scopes.join(by_scope, "scope").groupBy("sys_user").agg(*[F.sum(t).alias(t) for t in totals])


def members_of(sys_user: Column, scopes: DataFrame, member: DataFrame) -> DataFrame:
    """The members of the ``member`` table that one user sees."""
    members = member_scopes(member.select(F.col("id").alias("member")), member)
    return members.join(scopes.where(F.col("sys_user") == sys_user).select("scope"), "scope").select("member").distinct()


def users_of(one: Column, scopes: DataFrame, member: DataFrame) -> DataFrame:
    """The users who see one member."""
    of_member = member_scopes(member.where(F.col("id") == one).select(F.col("id").alias("member")), member)
    return scopes.join(of_member.select("scope"), "scope").select("sys_user").distinct()


def sysuser_product_category(
    user_member: DataFrame, sys_user: DataFrame, member: DataFrame, brand: DataFrame, product: DataFrame
) -> DataFrame:
    """Product categories a user sees through the brands of the members.

    The categories of a member are made distinct first, then those of a scope. Users with a role meet the categories of
    their scope and never single members; only listed users go through members.
    """
    brands = brand.select(F.col("id").alias("brand_id"), "member")
    categories = (
        product.select("brand_id", "product_category_id")
        .distinct()
        .join(brands, "brand_id")
        .select("member", "product_category_id")
        .distinct()
    )
    columns = ["sys_user_email", "sys_user", "country_id", "product_category_id"]
    of_scope = (
        categories.join(member.select(F.col("id").alias("member"), "country_id"), "member")
        .select("country_id", "product_category_id")
        .distinct()
        .select("*", _scopes().alias("scope"))
    )
    by_role = joins.salted_join(_holders(sys_user), of_scope, ["scope"], ["sys_user"])
    listed = joins.salted_join(_listed(user_member, sys_user).distinct(), categories, ["member"], ["sys_user"])
    return sets.stack_distinct(by_role.select(*columns), listed.select(*columns))


def member_business(member_chain: DataFrame, chain_business: DataFrame) -> DataFrame:
    """Businesses a member reaches through its chains."""
    members = member_chain.select("member", "chain").distinct()
    businesses = chain_business.select(F.col("chain_id").alias("chain"), "business_id").distinct()
    return joins.salted_join(businesses, members, ["chain"], ["business_id"]).select("member", "business_id").distinct()
