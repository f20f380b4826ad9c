"""Rating requests dropped as files; each scheduled run answers the new ones."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.plans.rating import MINUTE, rating_report
from tidemark.session import stored
from tidemark.sources.files import file_name
from tidemark.streaming import arrivals

REQUEST_COLUMNS = [*MINUTE, "channel_number"]


def read_requests(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, list[str]]:
    """Request rows by the names in each file's header, tagged with the stem of the file; and the files that were read.

    All files are read as lines in one scan, whatever their layouts: the first line of a file names its columns, and its
    other lines are read by their positions. Header names may be quoted or padded; a row stands in one line. A file that
    lacks a column is refused, and a file without any line has nothing to read.
    """
    lines = (
        spark.read.text(paths)
        .select(
            F.col("_metadata.file_path").alias("_file"),
            text.file_stem(file_name()).alias("request_file"),
            F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("_at"),
            F.ltrim("value", F.lit("\ufeff")).alias("value"),
        )
        .where(F.trim("value") != "")
    )
    names = F.transform(F.split("_header", ";"), lambda name: F.btrim(name, F.lit('" \t\r')))
    places = F.transform(F.array(*map(F.lit, REQUEST_COLUMNS)), lambda name: F.array_position("_names", name).cast("int"))
    # the first line of a file is in its first block
    first = lines.groupBy("_file").agg(F.min("_at").alias("_first"), F.min_by("value", "_at").alias("_header"))
    headers = stored(first.withColumn("_names", names).withColumn("_places", places), "request-headers")
    accepted = headers.where(~F.array_contains("_places", 0)).select("_file", "_first", "_places")
    width = headers.agg(F.max(F.size("_names"))).first()[0] or 1

    columns = ", ".join(f"_c{i} string" for i in range(width))
    parsed = F.from_csv("value", columns, {"sep": ";"})
    cells = F.array(*[F.col(f"_row._c{i}") for i in range(width)])
    rows = lines.join(accepted, "_file").where(F.col("_at") > F.col("_first")).withColumn("_row", parsed)
    rows = rows.withColumn("_cells", cells).select(
        *[F.get("_cells", F.get("_places", F.lit(i)) - 1).alias(name) for i, name in enumerate(REQUEST_COLUMNS)], "request_file"
    )
    # contents are not read for the names
    files = spark.read.format("binaryFile").load(paths).select("path", F.col("_metadata.file_path").alias("_file"))
    return rows, sorted(row.path for row in files.join(accepted, "_file", "left_semi").select("path").collect())


def answer_requests(
    spark: SparkSession,
    folder: str,
    viewing: DataFrame,
    target: str,
    ledger: str,
    run_date: dt.date,
    location: str | None = None,
    delete: bool = True,
) -> list[str]:
    """Writes one sorted CSV report per request file below ``target``, in a folder ``report=<name>_<day>``.

    Returns the requests that were answered; they go away once their answer is committed. A request that is delivered
    again is answered again, and replaces the report of the same day. A refused or failed one stays in its folder.
    """

    def process(paths: list[str]) -> list[str]:
        asked, accepted = read_requests(spark, paths)
        if not accepted:
            return []
        named = F.concat("request_file", F.lit(f"_{run_date:%Y-%m-%d}"))
        reports = rating_report(asked.withColumn("report", named), viewing, location, carry=["report"])
        order = ["report", *MINUTE, F.col("rating").desc(), "channel_number", "channel"]
        # a request is a small file that somebody wrote, so its report fits in one
        (
            reports.repartition("report")
            .sortWithinPartitions(*order)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .options(header="true", sep=";")
            .partitionBy("report")
            .csv(target)
        )
        return accepted

    return arrivals.take(spark, folder, ledger, process, delete=delete)
