"""Drop folders and growing logs: what has arrived is taken once, and put away only after its output is committed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.agents import AgentDictionary
from tidemark.plans.weblog import enriched_log, is_page_view
from tidemark.sinks.files import write_parquet
from tidemark.sinks.versions import Change, Versions
from tidemark.sources.files import LOG_OPTIONS, LOG_SCHEMA, ddl, read_epg, with_file_stem
from tidemark.streaming import arrivals, tails


def ingest_epg(
    spark: SparkSession, folder: str, target: str, ledger: str, archive: str | None = None, delete: bool = False
) -> list[str]:
    """Takes the guide files that arrived into Parquet, one partition per file stem; returns their paths.

    Empty rows are dropped. A guide that is delivered again replaces its rows; the others stay as they are.
    """

    def process(paths: list[str]) -> list[str]:
        write_parquet(with_file_stem(read_epg(spark, paths)), target, by=["s3_file"])
        return paths

    return arrivals.take(spark, folder, ledger, process, archive, delete)


def append_weblog(
    spark: SparkSession, folder: str, blocks: DataFrame, target: str, dictionary: str | None = None
) -> list[str]:
    """Appends the cleaned and enriched lines that log files have gained; returns the files that had changed.

    Logs may be written all day while this runs every half hour: each line is taken once, when it is complete. A file that
    shrank or was replaced has its lines replaced. Lines and ledger are published as one version of ``target``, so a run
    that fails changes nothing. User agents are looked up in the table kept at ``dictionary``, if one is given.
    """
    table = Versions(spark, target)
    found = tails.take_lines(spark, folder, table.read("ledger"))
    if found is None:
        return []
    parsed = F.from_csv(F.rtrim(F.col("value"), F.lit("\r")), ddl(LOG_SCHEMA), {"sep": LOG_OPTIONS["sep"]})
    logs = (
        found.lines.where(F.col("value").rlike(r"[^\x00-\x20]"))
        .select("log_file", "generation", parsed.alias("line"))
        .select("line.*", "log_file", "generation")
    )
    known = None
    if dictionary is not None:
        kept = AgentDictionary(spark, dictionary)
        kept.extend(logs.where(is_page_view()))
        known = kept.read()
    table.publish(
        {
            "rows": Change(enriched_log(logs, blocks, known)),
            "ledger": Change(found.ledger, "overwrite"),
            "given_up": Change(found.given_up),
        }
    )
    return found.files


def read_weblog_table(spark: SparkSession, target: str) -> DataFrame | None:
    """The lines that :func:`append_weblog` has taken, without those of files that were replaced since."""
    table = Versions(spark, target)
    published = table.numbers()
    if not published:
        return None
    rows, given_up = (table.read(name, published[-1]) for name in ("rows", "given_up"))
    return rows.join(given_up, ["log_file", "generation"], "left_anti").drop("log_file", "generation")
