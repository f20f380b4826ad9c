"""Account audit reports: account list, previous week, pivot, gap list and summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import nulls, text
from tidemark.operators import rows

ACCOUNT_ID, ACCOUNT_NAME, OWNER = "Account 18 ID", "Account Name", "Owner: Full Name"
DIRECTOR, MANAGER = "Area Sales Director", "Account Owner Manager"
AUDITED, EXCLUSIONS = "Audit Complete", "Exclusions"
REPORT_OWNER = "Account (EU): Owner Name"
PAIR = "concatenated_names"
# Columns of the gap list after name, audit flag and account.
GAP_COLUMNS = [
    "Region",
    "Territory: Territory Name",
    "Chain",
    "Taxonomy Level 1",
    "Visit Frequency: Visit Frequency Name",
    "Key Account Manager: Full Name",
    "Outlet Classification",
    "PRS Group Outlet Type (EU) name",
    "PRS Outlet Type (EU) name",
    "PRS Image Level Name",
    "PRS Volume Potential Name",
]


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def audits_with_date(audit: DataFrame) -> DataFrame:
    """Audits with the date part of their time stamp and the constant audit flag."""
    return audit.withColumns({"Date": F.substring(_c("Audit Datetime"), 1, 10), AUDITED: F.lit(1)})


def _roles(role_map: DataFrame) -> DataFrame:
    return role_map.select(
        _c("Account Owner/Sales Rep").alias(OWNER),
        _c(DIRECTOR),
        _c("Account Owner Manager/Sales Manager").alias(MANAGER),
    )


def weighted_accounts(accounts, role_map, audit, exclusion) -> DataFrame:
    """The account list with its repetitions counted instead of written out.

    ``_times`` says how often :func:`account_list` holds the row, ``_excluded`` how many of those are excluded. Audits are
    counted per account before anything is joined, so an account with very many audits stays one row.
    """
    audits = audit.groupBy(_c(ACCOUNT_ID).alias(ACCOUNT_ID)).agg(F.count("*").alias("_audits"))
    excluded = exclusion.groupBy(_c("Account Id").alias(ACCOUNT_ID)).agg(
        F.count("*").alias("_entries"), F.sum(nulls.flag(_c("Exclude") == 1)).alias("_marked")
    )
    repeated = F.coalesce("_audits", F.lit(1))
    return (
        accounts.join(_roles(role_map), OWNER, "left")
        .join(audits, ACCOUNT_ID, "left")
        .join(excluded, ACCOUNT_ID, "left")
        .withColumns(
            {
                AUDITED: nulls.flag(F.col("_audits").isNotNull()),
                "_times": repeated * F.coalesce("_entries", F.lit(1)),
                "_excluded": repeated * F.coalesce("_marked", F.lit(0)),
            }
        )
        .drop("_audits", "_entries", "_marked")
    )


def account_list(accounts, role_map, audit, exclusion) -> DataFrame:
    """Accounts with roles, audit flag and exclusion flag, one row per audit of the account.

    Only the number of audits matters, so they are counted before the join and the rows are repeated afterwards.
    """
    weighted = weighted_accounts(accounts, role_map, audit, exclusion)
    kinds = F.array(
        F.struct(F.lit(1).alias("flag"), F.col("_excluded").alias("n")),
        F.struct(F.lit(0).alias("flag"), (F.col("_times") - F.col("_excluded")).alias("n")),
    )
    counted = weighted.withColumn("_kind", F.explode(kinds)).withColumn(EXCLUSIONS, F.col("_kind.flag"))
    repeated = rows.repeat_rows(counted, F.col("_kind.n"), [ACCOUNT_ID, EXCLUSIONS])
    kept = [*accounts.columns, DIRECTOR, MANAGER, AUDITED, EXCLUSIONS]
    return repeated.select(*[_c(c) for c in kept])


def _by_rep(weighted: DataFrame, *measures: Column) -> DataFrame:
    return (
        weighted.groupBy(_c(DIRECTOR), _c(MANAGER), _c(OWNER).alias(REPORT_OWNER))
        .agg(*measures)
        .withColumn(PAIR, text.key_of(_c(MANAGER), _c(REPORT_OWNER)))
    )


def _times_where_known(name: str) -> Column:
    return F.sum(F.when(_c(name).isNotNull(), F.col("_times")).otherwise(F.lit(0)))


def _measures(weighted: DataFrame) -> DataFrame:
    """All counts of a sales rep, in one grouping of rows that are one for each account and rep.

    Accounts that are listed several times are brought together first, so that distinct ones are counted without a set.
    """
    account = _c(ACCOUNT_ID)
    once = weighted.groupBy(_c(DIRECTOR), _c(MANAGER), _c(OWNER), account).agg(
        F.when(account.isNotNull(), F.sum("_times")).alias("_rows"),
        _times_where_known(ACCOUNT_NAME).alias("_named"),
        F.sum(_c(AUDITED) * F.col("_times")).alias("_audits"),
    )
    return _by_rep(
        once,
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("Count of Account 18 ID"),
        F.count(account).alias("Distinct Count of Account 18 ID"),
        F.sum("_named").alias("Count of Account Name"),
        F.sum("_audits").alias("Sum of Audits Completed"),
    )


def _audit_share() -> Column:
    return F.round(nulls.safe_ratio(_c("Sum of Audits Completed"), _c("Count of Account Name"), scale=100), 0)


def previous(weighted: DataFrame) -> DataFrame:
    """Per sales rep: accounts, audits and the share of audits."""
    return _measures(weighted).select(
        _c(DIRECTOR), _c(MANAGER), _c(REPORT_OWNER), PAIR, _c("Count of Account Name"), _c("Sum of Audits Completed"),
        _audit_share().alias("MTD Audit %"),
    )


def _with_previous(measures: DataFrame, **kept: Column) -> DataFrame:
    """The measures of reps with what is kept of those with the same names. Both sides come from one shuffle of the accounts."""
    before = measures.select(PAIR, *[value.alias(name) for name, value in kept.items()])
    return measures.join(before, PAIR, "left")


def pivot_report(weighted: DataFrame) -> DataFrame:
    """Per sales rep: account rows, distinct accounts and the previous number of accounts."""
    return _with_previous(_measures(weighted), _before=_c("Count of Account Name")).select(
        _c(DIRECTOR), _c(MANAGER), _c(REPORT_OWNER), PAIR,
        _c("Count of Account 18 ID"), _c("Distinct Count of Account 18 ID"), F.col("_before").alias("Previous # of Accounts"),
    )


def gap_list(weighted: DataFrame) -> DataFrame:
    """One row per account and its attributes with the number of exclusions."""
    keys = [ACCOUNT_NAME, AUDITED, "Channel", ACCOUNT_ID, DIRECTOR, MANAGER, OWNER, *GAP_COLUMNS]
    return weighted.groupBy(*[_c(k) for k in keys]).agg(F.sum("_excluded").alias("Sum of Exclusions"))


def summary(weighted: DataFrame) -> DataFrame:
    """Per sales rep: audit share now and before, change in accounts and accounts not audited.

    ``Sum of Audits Completed`` is the number of distinct accounts, as in the report this column comes from.
    """
    entries, distinct, before = _c("Count of Account 18 ID"), _c("Distinct Count of Account 18 ID"), F.col("_before")
    share = F.coalesce(nulls.safe_ratio(distinct, entries), F.lit(0.0)) * 100
    measures = _with_previous(_measures(weighted), _before=_c("Count of Account Name"), _share=_audit_share())
    return measures.select(
        _c(DIRECTOR), _c(MANAGER), _c(REPORT_OWNER),
        entries.alias("Count of Account Name"),
        distinct.alias("Sum of Audits Completed"),
        F.round(share, 0).alias("MTD Audit %"),
        F.col("_share").alias("Prior Week"),
        before.alias("Previous # of Accounts"),
        (entries - before).alias("Database Movement"),
        (entries - distinct).alias("No of Accounts Not Audited"),
    )
