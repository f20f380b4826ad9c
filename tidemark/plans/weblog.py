"""Web server logs: cleaning and enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import network, nulls
from tidemark.operators import joins
from tidemark.plans.agents import with_agent

# What stands in for a missing entry, and texts only header lines carry.
MISSING = "-"
HEADER_STATUSES = ["undefined", "cs(Referer)"]
REQUIRED = ["UriStem", "Port", "ClientIP", "UserAgent", "Referer", "HttpStatus"]
PAGE_TYPE = ".aspx"
BOT = "bot"
UNKNOWN_PLACE = " "
# What tells the requests of one client apart.
SPREAD_BY = ["Date", "Time", "ClientIP", "UriStem", "UriQuery", "TimeTaken"]
PLACE = ["Country", "Region", "Latitude", "Longitude"]


def is_page_view(ignore_bot_case: bool = False) -> Column:
    """Successful page requests by people."""
    agent = F.lower("UserAgent") if ignore_bot_case else F.col("UserAgent")
    keep = (
        ~F.col("HttpStatus").isin(HEADER_STATUSES)
        & (F.col("Method") == "GET")
        & nulls.is_number_between(F.col("HttpStatus"), 200, 299)
        & (F.col("TimeTaken").try_cast("int") > 0)
        & ~agent.contains(BOT)
        & F.col("UriStem").contains(PAGE_TYPE)
    )
    for column in REQUIRED:
        keep = keep & (F.col(column) != MISSING)
    return keep


def with_place(logs: DataFrame, blocks: DataFrame, counted: DataFrame | None = None) -> DataFrame:
    """Country, region and coordinates of the client; a blank where the address is unknown.

    ``blocks`` holds address ranges of both kinds, ``start_ip`` and ``end_ip`` as text or as numbers of IPv4 addresses,
    and the four place columns. Of networks inside each other the smallest counts. ``counted`` are rows with the same
    addresses, if ``logs`` are long in the making.
    """
    ranges = blocks.select("start_ip", "end_ip", *[F.col(c).cast("string").alias(c) for c in PLACE])
    networks = network.networks_of(ranges).dropDuplicates(["length", "high", "low"])
    address = network.ip_to_halves(F.col("ClientIP"))
    placed = joins.prefix_lookup(logs, networks, address, "ClientIP", SPREAD_BY, counted)
    return placed.withColumns({c: nulls.null_default(F.col(c), UNKNOWN_PLACE) for c in PLACE})


def enriched_log(logs: DataFrame, blocks: DataFrame, agents: DataFrame | None = None) -> DataFrame:
    """Page views with their agent's classes, from ``agents`` if that knows them, and the client's place."""
    views = logs.where(is_page_view())
    return with_place(with_agent(views, SPREAD_BY, agents), blocks, counted=views)
