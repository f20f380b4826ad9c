"""Sources, sinks and file streams. Each query writes whole test tables as files of one kind and reads them back."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bindings.registry import query
from bindings.reports import RATED, WEBLOG_SQL
from bindings.staging import staging, table, with_staging
from tidemark.plans import consolidate
from tidemark.session import working_folder
from tidemark.sinks import documents, files as sinks
from tidemark.sinks.versions import Change, Versions
from tidemark.sources import files as sources
from tidemark.streaming import arrivals, ingest, requests, tails

RUN_DATE = dt.date(2024, 1, 16)
EPG_ROWS = """
    SELECT CAST(event_id AS STRING) AS epg_id, event_type AS senal, CAST(CAST(ts AS DATE) AS STRING) AS datetime_from,
      CAST(user_id AS STRING) AS datetime_to, CASE WHEN value > 1 THEN 'Show ' || CAST(user_id AS STRING) END AS epg_title,
      CASE WHEN value > 50 THEN 'hit' END AS cat FROM events"""


def _write_text(df: DataFrame, folder: str, **options: str) -> None:
    df.write.options(emptyValue="", nullValue="", **options).csv(folder)


def _epg_folder(spark: SparkSession, sf_dir: str) -> str:
    """Guide files with a header, one per task."""
    folder = working_folder(spark, "epg")
    events = spark.sql(EPG_ROWS.replace("FROM events", "FROM {events}"), events=table(spark, sf_dir, "events"))
    _write_text(events.repartition("epg_id"), folder, header="true")
    return folder


def _log_folder(spark: SparkSession, sf_dir: str) -> str:
    folder = working_folder(spark, "weblog")
    _write_text(staging(spark, sf_dir, "weblog").repartition("UriStem"), f"{folder}/site/a", sep=" ")
    return folder


@query("s01_weblog_scan", with_staging(["weblog"], "SELECT * FROM st_weblog"))
def _log_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.read_weblog(spark, _log_folder(spark, sf_dir))


@query("s02_epg_scan", EPG_ROWS.replace("STRING", "VARCHAR"))
def _epg_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.read_epg(spark, _epg_folder(spark, sf_dir))


@query("s03_text_csv", with_staging(["rating_request"], "SELECT * FROM st_rating_request"))
def _text_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = working_folder(spark, "request")
    sinks.write_csv(staging(spark, sf_dir, "rating_request"), folder)
    return sources.read_text_csv(spark, folder, sep=";")


@query(
    "s04_comment_csv",
    "SELECT CAST(event_id AS VARCHAR) AS id, CAST(value AS VARCHAR) AS score, props AS comment FROM events",
)
def _comment_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments with quotes and commas inside."""
    folder = working_folder(spark, "comments")
    said = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("value").alias("score"), F.col("props").alias("comment")
    )
    sinks.write_csv(said, folder, sep=",")
    return sources.read_text_csv(spark, folder)


@query(
    "s05_named_datasets",
    """SELECT 'exclusion' AS dataset, COUNT(*) AS n, CAST(SUM(c_custkey) AS BIGINT) AS total FROM customer
    UNION ALL SELECT 'role_map', COUNT(*), CAST(SUM(n_nationkey) AS BIGINT) FROM nation""",
)
def _datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two datasets exist, a third is missing and left out."""
    folder = working_folder(spark, "datasets")
    paths = {"exclusion": f"{folder}/a", "role_map": f"{folder}/b", "absent": f"{folder}/c"}
    sinks.write_csv(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")), paths["exclusion"], sep=",")
    sinks.write_csv(table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id")), paths["role_map"], sep=",")
    found = sources.read_datasets(spark, paths)
    counts = [
        df.agg(F.count("*").alias("n"), F.sum(F.col("id").cast("bigint")).alias("total")).select(
            F.lit(name).alias("dataset"), "n", "total"
        )
        for name, df in found.items()
    ]
    return counts[0].unionByName(counts[1])


def _partitioned(spark: SparkSession, sf_dir: str, select: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The events as a date-partitioned table, cut down by ``select``."""
    folder = working_folder(spark, "daily")
    parts = {"year": F.year("ts"), "month": F.month("ts"), "day": F.dayofmonth("ts")}
    dated = table(spark, sf_dir, "events").withColumns(parts)
    sinks.write_parquet(dated, folder, by=["year", "month", "day"])
    return select(sources.read_daily(spark, folder)).select("event_id", "value")


def _daily_query(key: str, condition: str):
    return query(key, f"SELECT event_id, value FROM events WHERE CAST(ts AS DATE) {condition}")


@_daily_query("s06_one_day", "= DATE '2024-01-15'")
def _one_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _partitioned(spark, sf_dir, lambda df: sources.on_day(df, dt.date(2024, 1, 15)))


@_daily_query("s07_listed_days", "IN (DATE '2024-01-03', DATE '2024-01-09', DATE '2024-01-30')")
def _listed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = [dt.date(2024, 1, d) for d in (9, 3, 30, 9)] + [dt.date(2024, 3, 1)]
    return _partitioned(spark, sf_dir, lambda df: sources.on_days(df, days))


@_daily_query("s08_day_range", "BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'")
def _day_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, last = dt.date(2024, 1, 5), dt.date(2024, 1, 20)
    return _partitioned(spark, sf_dir, lambda df: sources.between_days(df, first, last))


@query(
    "s09_day_folders",
    "SELECT event_id, event_type FROM events WHERE CAST(ts AS DATE) IN (DATE '2024-01-02', DATE '2024-01-04')",
)
def _day_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain YYYY/MM/DD folders for all days, written in one job; one of the asked days has none."""
    root, staged = working_folder(spark, "folders"), working_folder(spark, "folders-staged")
    dated = table(spark, sf_dir, "events").select("event_id", "event_type", F.col("ts").cast("date").alias("of_day"))
    sinks.write_parquet(dated, staged, by=["of_day"])
    for row in dated.select("of_day").where("of_day IS NOT NULL").distinct().collect():
        arrivals.move(spark, f"{staged}/of_day={row.of_day}", sources.day_folder(root, row.of_day))
    return sources.read_day_folders(spark, root, [dt.date(2024, 1, d) for d in (2, 4)] + [dt.date(2030, 1, 1)])


@query(
    "s14_slicer_document",
    """
    SELECT '{"parameters":[' || STRING_AGG('{"name":"' || name || '","type":"' || type || '","values":[' || list || ']}', ','
      ORDER BY name) || ']}' AS document
    FROM (SELECT 'age_group' AS name, 'list' AS type, STRING_AGG('"' || v || '"', ',' ORDER BY v) AS list
            FROM (SELECT DISTINCT c_mktsegment AS v FROM customer)
          UNION ALL SELECT 'date', 'range', '"' || CAST(MIN(CAST(ts AS DATE)) AS VARCHAR) || '","' ||
            CAST(MAX(CAST(ts AS DATE)) AS VARCHAR) || '"' FROM events
          UNION ALL SELECT 'sex', 'list', STRING_AGG('"' || v || '"', ',' ORDER BY v)
            FROM (SELECT DISTINCT event_type AS v FROM events))""",
)
def _slicer_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct values of a few columns as JSON lines, read back into one document."""
    customer, events = table(spark, sf_dir, "customer"), table(spark, sf_dir, "events")

    def slicer(name: str, kind: str, values: DataFrame) -> DataFrame:
        return values.select(F.lit(name).alias("name"), F.lit(kind).alias("type"), "values")

    def distinct_values(df: DataFrame, column: str) -> DataFrame:
        return df.select(column).distinct().agg(F.sort_array(F.collect_list(column)).alias("values"))

    day = F.col("ts").cast("date")
    span = events.agg(F.array(F.min(day).cast("string"), F.max(day).cast("string")).alias("values"))
    catalogue = (
        slicer("sex", "list", distinct_values(events, "event_type"))
        .unionByName(slicer("age_group", "list", distinct_values(customer, "c_mktsegment")))
        .unionByName(slicer("date", "range", span))
    )
    folder = working_folder(spark, "slicers")
    sinks.write_json_lines(catalogue, folder)
    fragments = documents.slicer_document(sources.read_catalogue(spark, folder))
    documents.write_document(fragments, f"{folder}-document/slicers.json")
    return documents.read_document(spark, f"{folder}-document/slicers.json")


@query(
    "s17_file_tag",
    "SELECT s_suppkey, s_name, 'part-' AS prefix, 1 AS dots FROM supplier",
)
def _file_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows tagged with the stem of their file."""
    folder = working_folder(spark, "tagged")
    sinks.write_csv(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), folder, sep=",")
    scan = spark.read.schema("s_suppkey bigint, s_name string").options(header="true").csv(folder)
    tagged = sources.with_file_stem(scan, "s3_file")
    dots = F.when(~F.col("s3_file").contains("."), 1).otherwise(0)
    return tagged.select("s_suppkey", "s_name", F.left("s3_file", F.lit(5)).alias("prefix"), dots.alias("dots"))


WORKBOOK_SCHEMA = T.StructType(
    [
        T.StructField("Rank", T.StringType()),
        T.StructField("Activity Code Description", T.StringType()),
        T.StructField("Charged Hours", T.DoubleType()),
        T.StructField("NSR", T.DoubleType()),
        T.StructField("ANSR", T.DoubleType()),
        T.StructField("Entry", T.LongType()),
    ]
)


@query(
    "s19_workbooks",
    with_staging(
        ["workbook"],
        """SELECT "Rank", "Activity Code Description", "Charged Hours", "NSR", "ANSR", "Entry" FROM st_workbook""",
    ),
)
def _workbooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exports of 1,000 rows each with six banner rows and a header."""
    names = WORKBOOK_SCHEMA.fieldNames()
    rows = staging(spark, sf_dir, "workbook").withColumn("_book", F.floor(F.col("Entry") / 1000))
    line = F.to_csv(F.struct(*[F.col(f"`{n}`") for n in names]))
    head = "".join(f"banner {i}\n" for i in range(6)) + ",".join(names)
    books = rows.groupBy("_book").agg(F.concat(F.lit(head + "\n"), F.array_join(F.collect_list(line), "\n")).alias("value"))
    folder = working_folder(spark, "books")
    books.select("value").repartition("value").write.option("maxRecordsPerFile", "1").text(folder)
    return sources.read_workbooks(spark, folder, WORKBOOK_SCHEMA).drop("File Name")


@query("s20_source_probe", "SELECT COUNT(*) AS n, TRUE AS present, FALSE AS absent FROM region")
def _probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    present = sources.exists(spark, f"{sf_dir}/region.parquet", "parquet")
    absent = sources.exists(spark, f"{sf_dir}/nothing.parquet", "parquet")
    return table(spark, sf_dir, "region").agg(
        F.count("*").alias("n"), F.lit(present).alias("present"), F.lit(absent).alias("absent")
    )


@query(
    "k01_single_csv",
    """SELECT 1 AS files, 'o_orderkey;o_totalprice;o_comment' AS header, COUNT(*) AS n, TRUE AS in_order,
      CAST(SUM(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total FROM orders""",
)
def _single_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders sorted in 32 ranges and joined into one file; its lines are read back with their places."""
    folder = working_folder(spark, "report") + "/" + sinks.report_name("orders.csv", RUN_DATE)
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"), F.col("o_orderpriority").alias("o_comment")
    )
    sinks.write_report(orders, folder, [F.col("o_totalprice").desc(), "o_orderkey"])
    lines = spark.read.text(folder).select("value", "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("at"))
    head = F.min_by("value", F.struct("file_block_start", "at"))
    fields = F.from_csv("value", "o_orderkey bigint, o_totalprice decimal(18,2), o_comment string", {"sep": ";"})
    rows = lines.where(~F.col("value").startswith("o_orderkey;")).withColumn("row", fields)
    price = F.col("row.o_totalprice")
    # each line against the one before it in its block of the file, and each block against the one before it
    along = Window.partitionBy("file_block_start").orderBy("at")
    blocks = rows.withColumn("step", F.coalesce(F.lag(price).over(along) >= price, F.lit(True))).groupBy("file_block_start").agg(
        F.count("*").alias("n"), F.every("step").alias("steps"), F.min(price).alias("low"), F.max(price).alias("high"),
        F.sum(price).alias("total"), F.collect_set("file_path").alias("paths"),
    )
    in_turn = F.sort_array(F.collect_list(F.struct("file_block_start", "low", "high")))
    turns = F.every("steps") & F.forall(
        F.sequence(F.lit(1), F.greatest(F.size(in_turn) - 1, F.lit(1))),
        lambda i: F.coalesce(F.get(in_turn, i - 1)["low"] >= F.get(in_turn, i)["high"], F.lit(True)),
    )
    return blocks.agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("paths")))).alias("files"), lines.agg(head).scalar().alias("header"),
        F.sum("n").alias("n"), turns.alias("in_order"), F.sum("total").cast("double").alias("total"),
    )


@query(
    "k03_parquet_per_file",
    "SELECT o_orderkey, o_orderstatus, CASE o_orderstatus WHEN 'F' THEN 'new' ELSE 'old' END AS version FROM orders",
)
def _parquet_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second run replaces the partition it writes and leaves the others alone."""
    folder = working_folder(spark, "perfile")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    sinks.write_parquet(orders.withColumn("version", F.lit("old")), folder, by=["o_orderstatus"])
    again = orders.where(F.col("o_orderstatus") == "F").withColumn("version", F.lit("new"))
    sinks.write_parquet(again, folder, by=["o_orderstatus"])
    return spark.read.parquet(folder)


@query("k04_append", "SELECT n_nationkey, n_name FROM nation UNION ALL SELECT n_nationkey, n_name FROM nation")
def _append(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = working_folder(spark, "appended")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    sinks.write_table(nations, folder, "overwrite")
    sinks.write_table(nations, folder, "append")
    return sinks.read_table(spark, folder)


@query(
    "k04_versions",
    """SELECT o_orderkey, o_orderstatus, CAST(0 AS INTEGER) AS version, TRUE AS failed, FALSE AS added_again FROM orders
    UNION ALL SELECT o_orderkey, o_orderstatus, 1, TRUE, FALSE FROM orders
    UNION ALL SELECT o_orderkey, o_orderstatus, 1, TRUE, FALSE FROM orders WHERE o_orderstatus = 'F'""",
)
def _table_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both versions of a table after a load, an appended batch, the same batch again and an overwrite that fails."""
    store = Versions(spark, working_folder(spark, "versioned"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    store.publish({"rows": Change(orders, "overwrite")})
    finished = orders.where(F.col("o_orderstatus") == "F")
    store.publish({"rows": Change(finished)}, batch="finished")
    again = store.publish({"rows": Change(finished)}, batch="finished")
    # the last row breaks the write after others are on the disk
    last = orders.agg(F.max("o_orderkey")).scalar()
    broken = orders.withColumn(
        "o_orderstatus", F.when(F.col("o_orderkey") == last, F.raise_error(F.lit("broken row"))).otherwise(F.col("o_orderstatus"))
    )
    try:
        store.publish({"rows": Change(broken, "overwrite")})
        failed = False
    except PySparkException:
        failed = True
    parts = [store.read(number=n).withColumn("version", F.lit(n)) for n in store.numbers()]
    return parts[0].unionByName(parts[1]).withColumns({"failed": F.lit(failed), "added_again": F.lit(again)})


@query(
    "k07_sheets",
    with_staging(
        ["workbook"],
        """
        SELECT 'Consolidated files' AS sheet, COUNT(*) + 2 AS n FROM st_workbook
          WHERE COALESCE("Rank", '') NOT IN ('Unknown', 'Intern (CS)')
        UNION ALL SELECT 'Senior Rank', COUNT(*) FROM st_workbook WHERE "Rank" IN ('Executive Director', 'Manager')""",
    ),
)
def _sheet_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    sheets = consolidate.consolidation(staging(spark, sf_dir, "workbook"))
    paths = sinks.write_sheets(sheets, working_folder(spark, "sheets"))
    counts = [
        spark.read.options(header="true").csv(path).agg(F.count("*").alias("n")).select(F.lit(name).alias("sheet"), "n")
        for name, path in paths.items()
    ]
    return counts[0].unionByName(counts[1])


@query(
    "k09_json_lines",
    """SELECT '{"c_custkey":' || CAST(c_custkey AS VARCHAR) || ',"c_mktsegment":"' || c_mktsegment || '"}' AS json
    FROM customer""",
)
def _json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.as_json_lines(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"))


@query(
    "k09_column_document",
    """
    SELECT '{"data":[{"segment":{' || STRING_AGG('"' || CAST(rn AS VARCHAR) || '":"' || segment || '"', ',' ORDER BY rn) ||
      '},"n":{' || STRING_AGG('"' || CAST(rn AS VARCHAR) || '":' || CAST(n AS VARCHAR), ',' ORDER BY rn) || '}}]}' AS document
    FROM (SELECT c_mktsegment AS segment, COUNT(*) AS n, ROW_NUMBER() OVER (ORDER BY c_mktsegment) - 1 AS rn
          FROM customer GROUP BY 1)""",
)
def _column_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_segment = table(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("segment")).agg(
        F.count("*").alias("n")
    )
    path = working_folder(spark, "document") + "/data.json"
    documents.write_document(documents.column_document(per_segment, ["segment"], size=2), path)
    return documents.read_document(spark, path)


# ---------------------------------------------------------------- streams


@query("t01_epg_ingest", f"SELECT *, 'part-' AS s3_file FROM ({EPG_ROWS.replace('STRING', 'VARCHAR')})")
def _epg_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over a drop folder: the second finds only what came in between."""
    folder, out = _epg_folder(spark, sf_dir), working_folder(spark, "epg-out")
    for _ in range(2):
        ingest.ingest_epg(spark, folder, f"{out}/parquet", f"{out}/ledger", archive=f"{out}/processed")
    return spark.read.parquet(f"{out}/parquet").withColumn("s3_file", F.left("s3_file", F.lit(5)))


def _write_start(spark: SparkSession, source: str, target: str, size: int) -> None:
    """The first bytes of a file, as a server that is still writing it would leave them."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(files.open(path(source)), files.create(path(target), True), size, True)


@query("t02_weblog_append", with_staging(["weblog", "ip_blocks"], WEBLOG_SQL))
def _weblog_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs: over half of the lines, over files that have grown to all of them, and over the same files."""
    whole, folder, out = _log_folder(spark, sf_dir), working_folder(spark, "growing"), working_folder(spark, "weblog-out")
    blocks = staging(spark, sf_dir, "ip_blocks")
    for share in (0.5, 1.0, 1.0):
        for row in tails.listed(spark, whole).collect():
            _write_start(spark, row.log_file, f"{folder}/site/{row.log_file.rsplit('/', 1)[-1]}", int(row.size * share))
        ingest.append_weblog(spark, folder, blocks, f"{out}/logs", f"{out}/agents")
    return ingest.read_weblog_table(spark, f"{out}/logs")


@query(
    "t03_request_reports",
    with_staging(
        ["viewing", "rating_request"],
        """
        SELECT q.year, q.month, q.day, q.hour, q.minute, COALESCE(q.channel_number, 'sin datos') AS channel_number,
          COALESCE(r.channel, 'sin datos') AS channel, ROUND(CAST(COALESCE(r.rating, 0) AS FLOAT), 3) AS rating,
          '_2024-01-16' AS day_of_run
        FROM (SELECT CAST(year AS INT) AS year, CAST(month AS INT) AS month, CAST(day AS INT) AS day,
                CAST(hour AS INT) AS hour, TRY_CAST(minute AS INT) AS minute, channel_number FROM st_rating_request) q
        LEFT JOIN rated r USING (year, month, day, hour, minute, channel_number)""",
        rated=RATED,
    ),
)
def _request_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, out = working_folder(spark, "requests"), working_folder(spark, "reports")
    asked = staging(spark, sf_dir, "rating_request").select(*requests.REQUEST_COLUMNS)
    turned = [F.lit("free text").alias("note"), *reversed(requests.REQUEST_COLUMNS)]
    for mine, columns in ((F.col("minute") == "none", turned), (F.col("minute") != "none", requests.REQUEST_COLUMNS)):
        sinks.write_csv(asked.where(mine).repartition("minute").select(*columns), f"{folder}-part")
        # both kinds of files come from the same writer; they meet in the folder under names of their own
        for row in arrivals.listed(spark, f"{folder}-part").collect():
            arrivals.move(spark, row.path, f"{folder}/{row.path.rsplit('/', 1)[-1]}")
    requests.answer_requests(
        spark, folder, staging(spark, sf_dir, "viewing"), f"{out}/csv", f"{out}/ledger", RUN_DATE, "city"
    )
    schema = (
        "year int, month int, day int, hour int, minute int, channel_number string, channel string, rating float, "
        "report string"
    )
    reports = spark.read.schema(schema).options(header="true", sep=";").csv(f"{out}/csv")
    return reports.withColumn("day_of_run", F.right("report", F.lit(11))).drop("report")
