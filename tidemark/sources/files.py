"""File scans: delimited logs, CSV, date-partitioned Parquet, JSON lines and workbook exports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import text

# Columns of a programme guide file, in file order, all text.
EPG_COLUMNS = ["epg_id", "senal", "datetime_from", "datetime_to", "epg_title", "cat"]
EPG_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in EPG_COLUMNS])
# Columns of a log line, all text but the date.
LOG_COLUMNS = [
    "Time", "ServerIP", "Method", "UriStem", "UriQuery", "Port", "UserName", "ClientIP", "UserAgent",
    "Referer", "HttpStatus", "Substatus", "Win32Status", "TimeTaken",
]
LOG_SCHEMA = T.StructType(
    [T.StructField("Date", T.DateType()), *[T.StructField(c, T.StringType()) for c in LOG_COLUMNS]]
)
LOG_OPTIONS = {"header": "false", "sep": " ", "recursiveFileLookup": "true"}
PARTITION_COLUMNS = ["year", "month", "day"]
BANNER_ROWS = 6
# A control character that text exports do not hold.
ROW_END = "\u001e"


def read_weblog(spark: SparkSession, path: str) -> DataFrame:
    """Headerless, blank-separated log files of a folder tree; broken fields become null."""
    return spark.read.options(**LOG_OPTIONS).schema(LOG_SCHEMA).csv(path)


def read_epg(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Programme guide CSV files: the header is skipped, columns go by position; other files are ignored."""
    return spark.read.options(header="true", pathGlobFilter="*.csv").schema(EPG_SCHEMA).csv(path)


def read_text_csv(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """CSV with a header, every column as text."""
    return spark.read.options(header="true", sep=sep, inferSchema="false").csv(path)


def open_if_there(spark: SparkSession, path: str, kind: str = "csv", **options: str) -> DataFrame | None:
    """The input, or None when it is missing. Only a missing path counts as that; other errors are raised."""
    try:
        return spark.read.options(**options).format(kind).load(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def exists(spark: SparkSession, path: str, kind: str = "csv", **options: str) -> bool:
    """Whether an input is there and opens."""
    return open_if_there(spark, path, kind, **options) is not None


def read_datasets(
    spark: SparkSession, locations: dict[str, str], schemas: dict[str, T.StructType] | None = None
) -> dict[str, DataFrame]:
    """Named CSV datasets without empty rows; a dataset that is missing is left out.

    Types are inferred, which reads a file one more time, unless a schema is given for the dataset.
    """
    found = {}
    for name, path in locations.items():
        if not exists(spark, path, header="true"):
            continue
        reader = spark.read.option("header", "true")
        declared = (schemas or {}).get(name)
        reader = reader.schema(declared) if declared else reader.option("inferSchema", "true")
        found[name] = reader.csv(path).na.drop(how="all")
    return found


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    """Parquet laid out as ``year=YYYY/month=MM/day=DD``; filters on the day read only those folders."""
    return spark.read.parquet(path)


def on_day(df: DataFrame, day: dt.date) -> DataFrame:
    parts = (day.year, day.month, day.day)
    for name, value in zip(PARTITION_COLUMNS, parts):
        df = df.where(F.col(name) == value)
    return df


def on_days(df: DataFrame, days: Iterable[dt.date]) -> DataFrame:
    """Any of the listed days, as a filter on the partition columns."""
    wanted = F.lit(False)
    for day in sorted(set(days)):
        one = F.lit(True)
        for name, value in zip(PARTITION_COLUMNS, (day.year, day.month, day.day)):
            one = one & (F.col(name) == value)
        wanted = wanted | one
    return df.where(wanted)


def between_days(df: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """All days from start to end, both included."""
    number = F.col("year") * 10000 + F.col("month") * 100 + F.col("day")
    low, high = (d.year * 10000 + d.month * 100 + d.day for d in (start, end))
    return df.where(number.between(low, high))


def day_folder(root: str, day: dt.date) -> str:
    """Path of one day in a plain ``YYYY/MM/DD`` layout."""
    return f"{root.rstrip('/')}/{day:%Y/%m/%d}"


def read_day_folders(spark: SparkSession, root: str, days: Iterable[dt.date]) -> DataFrame | None:
    """The days of a plain ``YYYY/MM/DD`` layout in one scan; days without a folder are skipped, none gives None.

    One path pattern names all days, so the folders are listed once and no day is probed on its own.
    """
    folders = ",".join(f"{day:%Y/%m/%d}" for day in sorted(set(days)))
    return open_if_there(spark, f"{root.rstrip('/')}/{{{folders}}}", "parquet")


def file_name() -> Column:
    return F.col("_metadata.file_name")


def with_file_stem(df: DataFrame, column: str = "s3_file") -> DataFrame:
    """Tags rows with the name of their file up to the first dot; empty rows are dropped before."""
    data = df.columns
    return (
        df.select(*data, text.file_stem(file_name()).alias(column)).na.drop(how="all", subset=data)
    )


def is_open_lock(name: Column) -> Column:
    """Lock files an office program leaves beside an open workbook."""
    return name.contains("~$")


def read_workbooks(
    spark: SparkSession, path: str, schema: T.StructType, banner: int = BANNER_ROWS, tag: str = "File Name"
) -> DataFrame:
    """CSV exports of workbooks: banner rows and the header are skipped, every row is tagged with its file.

    Line breaks inside quoted cells are kept. A sheet has at most 1,048,576 rows, so one file fits in a task; lock files
    are ignored.
    """
    whole = spark.read.text(path, wholetext=True).select("value", file_name().alias(tag))
    rest = F.try_element_at(F.split("value", "\r?\n", banner + 2), F.lit(banner + 2))
    # between quotes every second piece is the inside of a cell; breaks outside end a row
    outside = F.transform(
        F.split(rest, '"', -1),
        lambda piece, i: F.when(i % 2 == 0, F.regexp_replace(piece, "\r?\n", ROW_END)).otherwise(piece),
    )
    rows = F.split(F.array_join(outside, '"'), ROW_END)
    lines = (
        whole.where(~is_open_lock(F.col(tag))).select(tag, F.explode(rows).alias("_line")).where(F.col("_line") != "")
    )
    parsed = F.from_csv("_line", ddl(schema))
    return lines.select(parsed.alias("_row"), tag).select("_row.*", tag)


def ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of a slicer catalogue."""
    return spark.read.schema("name string, type string, values array<string>").json(path)
