"""The report plans over the test tables."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindings.registry import query
from bindings.staging import staging, table, with_staging
from tidemark.functions import network
from tidemark.operators import aggregates
from tidemark.plans import audit, comments, consolidate, planner, rating, weblog

RUN_DATE = dt.date(2024, 1, 16)
REQUEST = json.dumps(
    {
        "request": [
            {"name": "date", "type": "range", "values": ["2024-01-31T03:00:20.976130", "2024-01-01T03:00:20.976130"]},
            {"name": "sex", "type": "list", "values": ["1"]},
            {"name": "age_group", "type": "list", "values": ["MACHINERY", "BUILDING", "FURNITURE"]},
            {"name": "social_class", "type": "list", "values": ["Medio", "Alto"]},
        ]
    }
)

# ---------------------------------------------------------------- web log

IN_BLOCK = """
  CASE WHEN {ip} LIKE '%.%' THEN
      TRY_CAST(SPLIT_PART({ip}, '.', 1) AS BIGINT) * 16777216 + TRY_CAST(SPLIT_PART({ip}, '.', 2) AS BIGINT) * 65536
        + TRY_CAST(SPLIT_PART({ip}, '.', 3) AS BIGINT) * 256 + TRY_CAST(SPLIT_PART({ip}, '.', 4) AS BIGINT)
        BETWEEN TRY_CAST(b.start_ip AS BIGINT) AND TRY_CAST(b.end_ip AS BIGINT)
    ELSE SPLIT_PART({ip}, ':', 3) = SPLIT_PART(b.start_ip, ':', 3) AND b.start_ip LIKE '2001:db8:%'
      AND LPAD(SPLIT_PART({ip}, ':', 4), 4, '0') < '8000' END"""
AGENT_TEXT = "REPLACE(\"UserAgent\", '+', ' ')"
WEBLOG_SQL = f"""
    SELECT w.*,
      CASE WHEN {AGENT_TEXT} LIKE '%Windows%' THEN 'Windows' WHEN {AGENT_TEXT} LIKE '%iPhone%' THEN 'iOS'
        WHEN {AGENT_TEXT} LIKE '%iPad%' THEN 'iOS' WHEN {AGENT_TEXT} LIKE '%Android%' THEN 'Android'
        WHEN {AGENT_TEXT} LIKE '%Mac OS X%' THEN 'Mac OS X' WHEN {AGENT_TEXT} LIKE '%Ubuntu%' THEN 'Ubuntu'
        ELSE 'Other' END AS "OS",
      CASE WHEN {AGENT_TEXT} LIKE '%iPhone%' THEN 'iPhone' WHEN {AGENT_TEXT} LIKE '%iPad%' THEN 'iPad'
        WHEN {AGENT_TEXT} LIKE '%SM-%' THEN 'Samsung' WHEN {AGENT_TEXT} LIKE '%Macintosh%' THEN 'Mac' ELSE 'Other' END
        AS "Device",
      CASE WHEN {AGENT_TEXT} LIKE '%Edg/%' THEN 'Edge' WHEN {AGENT_TEXT} LIKE '%Firefox/%' THEN 'Firefox'
        WHEN {AGENT_TEXT} LIKE '%Chrome/%Mobile%' THEN 'Chrome Mobile' WHEN {AGENT_TEXT} LIKE '%Chrome/%' THEN 'Chrome'
        WHEN {AGENT_TEXT} LIKE '%iP%Safari/%' THEN 'Mobile Safari' WHEN {AGENT_TEXT} LIKE '%Safari/%' THEN 'Safari'
        ELSE 'Other' END AS "Browser",
      {AGENT_TEXT} LIKE '%iPhone%' OR {AGENT_TEXT} LIKE '%Android%Mobile%' AS "Is_Mobile",
      COALESCE(b."Country", ' ') AS "Country", COALESCE(b."Region", ' ') AS "Region",
      COALESCE(b."Latitude", ' ') AS "Latitude", COALESCE(b."Longitude", ' ') AS "Longitude"
    FROM st_weblog w LEFT JOIN st_ip_blocks b ON {IN_BLOCK.format(ip='w."ClientIP"')}
    WHERE w."Method" = 'GET' AND TRY_CAST(w."HttpStatus" AS INT) BETWEEN 200 AND 299
      AND TRY_CAST(w."TimeTaken" AS INT) > 0 AND w."ClientIP" <> '-' AND w."Referer" <> '-'
      AND w."UserAgent" NOT LIKE '%bot%' AND w."UriStem" LIKE '%.aspx%'"""


@query("r01_weblog", with_staging(["weblog", "ip_blocks"], WEBLOG_SQL))
def _weblog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weblog.enriched_log(staging(spark, sf_dir, "weblog"), staging(spark, sf_dir, "ip_blocks"))


J20_FOUR = "(page_id * 7919) % 4294967296 * 7 % 4294967296"
J20_SIX = """'2001:Db8:' || CAST(page_id % 33 AS STRING) || ':' || CAST(page_id * 7 % 10000 AS STRING) || '::'
    || CAST(page_id % 1000 AS STRING)"""


@query(
    "j20_ip_range_lookup",
    with_staging(
        ["ip_blocks"],
        f"""
        SELECT p.page_id, p.number AS ip, p.ip AS address, COALESCE(b."Country", ' ') AS "Country",
          COALESCE(b."Region", ' ') AS "Region", COALESCE(b."Latitude", ' ') AS "Latitude", COALESCE(b."Longitude", ' ') AS "Longitude"
        FROM (SELECT page_id, n AS number, CAST(n // 16777216 AS VARCHAR) || '.' || CAST(n // 65536 % 256 AS VARCHAR) || '.'
                || CAST(n // 256 % 256 AS VARCHAR) || '.' || CAST(n % 256 AS VARCHAR) AS ip
              FROM (SELECT page_id, {J20_FOUR} AS n FROM pages)
              UNION ALL SELECT page_id, NULL, {J20_SIX.replace("STRING", "VARCHAR")} FROM pages) p
        LEFT JOIN st_ip_blocks b ON {IN_BLOCK.format(ip="p.ip")}""",
    ),
)
def _ip_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of addresses of both kinds spread over the whole range, and from the text of IPv4 back to the number."""
    pages = table(spark, sf_dir, "pages")
    four = pages.select("page_id", F.expr(J20_FOUR).alias("ip"))
    text = F.concat_ws(".", *[((F.shiftright("ip", bits)) % 256).cast("string") for bits in (24, 16, 8, 0)])
    hits = four.select("page_id", text.alias("ClientIP")).unionByName(pages.selectExpr("page_id", f"{J20_SIX} AS ClientIP"))
    spread = hits.withColumns({c: F.col("page_id") for c in weblog.SPREAD_BY if c != "ClientIP"})
    placed = weblog.with_place(spread, staging(spark, sf_dir, "ip_blocks"))
    return placed.select(
        "page_id", network.ip_to_long(F.col("ClientIP")).alias("ip"), F.col("ClientIP").alias("address"), *weblog.PLACE
    )


# ---------------------------------------------------------------- ratings

RATED = """
    SELECT CAST(YEAR(seen_at) AS INT) AS year, CAST(MONTH(seen_at) AS INT) AS month, CAST(DAY(seen_at) AS INT) AS day,
      CAST(HOUR(seen_at) AS INT) AS hour, CAST(MINUTE(seen_at) AS INT) AS minute, event_type AS channel,
      'n-' || event_type AS channel_number, IF(boxes > 0, ROUND(viewers / boxes, 3), NULL) AS rating
    FROM (SELECT TIME_BUCKET(INTERVAL 1 MINUTE, ts) AS seen_at, event_type, MAX(user_id % 4) AS boxes,
            SUM(IF(value >= 1, value, 0) * ((user_id % 5 + 1) / 7e0)) AS viewers FROM events GROUP BY 1, 2)"""


@query("r02_rating_by_minute", with_staging(["viewing"], "SELECT * FROM rated", rated=RATED))
def _rating_by_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rating.rating_by_minute(staging(spark, sf_dir, "viewing"))


@query(
    "r03_rating_report",
    with_staging(
        ["viewing", "rating_request"],
        """
        SELECT q.year, q.month, q.day, q.hour, q.minute, COALESCE(q.channel_number, 'sin datos') AS channel_number,
          COALESCE(r.channel, 'sin datos') AS channel, ROUND(CAST(COALESCE(r.rating, 0) AS FLOAT), 3) AS rating
        FROM (SELECT CAST(year AS INT) AS year, CAST(month AS INT) AS month, CAST(day AS INT) AS day,
                CAST(hour AS INT) AS hour, TRY_CAST(minute AS INT) AS minute, channel_number FROM st_rating_request) q
        LEFT JOIN rated r USING (year, month, day, hour, minute, channel_number)
        ORDER BY 1, 2, 3, 4, 5, rating DESC""",
        rated=RATED,
    ),
)
def _rating_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rating.rating_report(staging(spark, sf_dir, "rating_request"), staging(spark, sf_dir, "viewing"), "city")


@query(
    "r04_channel_list",
    with_staging(
        ["viewing"],
        """SELECT DISTINCT channel, channel_number FROM st_viewing WHERE year = '2024' AND month = '1' AND day = '15'""",
    ),
)
def _channel_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rating.channel_list(staging(spark, sf_dir, "viewing"), RUN_DATE)


# ---------------------------------------------------------------- planner

FACTORS = """
    SELECT id_location, social_class, SUM(probability_factor) AS probability_factor FROM st_sociodemographic
    WHERE age_group IN ('MACHINERY', 'BUILDING', 'FURNITURE') AND social_class IN ('Medio', 'Alto') AND sex = '1'
    GROUP BY ALL"""
# a location is a customer: the chosen ones have a class and a weight
CHOSEN = """
    SELECT c_custkey, IF(c_acctbal < 6000, 'Medio', 'Alto') AS kind, (c_nationkey + 1) / 32e0 AS weight FROM customer
    WHERE c_acctbal >= 2000 AND c_nationkey < 12 AND c_mktsegment IN ('MACHINERY', 'BUILDING', 'FURNITURE')"""
# an event is a look at the show with the number in its properties, which runs in the hour of the event
SHOWS = """
    SELECT event_type AS channel, title_no, runs_at, kind, SUM(value * weight) / NULLIF(SUM(title_no % 3 * weight), 0) * 100 AS rated
    FROM (SELECT event_type, user_id, value, TIME_BUCKET(INTERVAL 1 HOUR, ts) AS runs_at,
            CAST(REGEXP_EXTRACT(props, '[0-9]+') AS INT) AS title_no FROM events)
    LEFT JOIN chosen ON user_id = c_custkey
    WHERE runs_at >= TIMESTAMP '2024-01-01' AND runs_at < TIMESTAMP '2024-02-01' GROUP BY ALL"""
# what each class and each weekday has of a title
LABELLED = """
    SELECT channel, title_no, MAP_FROM_ENTRIES(LIST((label, {shows: shows, rated: rated}))) AS of_label
    FROM (SELECT channel, title_no, label, COUNT(*) AS shows, SUM(rated) AS rated
          FROM (SELECT channel, title_no, rated, UNNEST([kind, DAYNAME(runs_at)]) AS label FROM shows) GROUP BY ALL)
    WHERE label IS NOT NULL GROUP BY ALL"""
LABEL_COLUMNS = ", ".join(
    f"IF(of_label['{label}'].shows = shows, of_label['{label}'].rated, COALESCE(of_label['{label}'].rated, 0)) AS {name}"
    for name, label in {**planner.SOCIAL_CLASSES, **planner.WEEKDAYS}.items()
)
TITLES = f"""
    SELECT channel, 'Show ' || title_no AS epg_title, first_run AS epg_start,
      first_run + IF(title_no = 7, 0, 45) * INTERVAL 1 MINUTE AS epg_end, rating, {LABEL_COLUMNS}
    FROM (SELECT channel, title_no, MIN(runs_at) AS first_run, COUNT(*) AS shows, SUM(rated) AS rating FROM shows GROUP BY ALL)
    LEFT JOIN labelled USING (channel, title_no)"""
TITLE_CTES = {"chosen": CHOSEN, "shows": SHOWS, "labelled": LABELLED, "titles": TITLES}
RATINGS = ["rating", *planner.SOCIAL_CLASSES, *planner.WEEKDAYS]


def _audience(spark: SparkSession) -> planner.Audience:
    return planner.Audience.of(planner.read_request(spark, REQUEST))


@query("r06_audience_factors", with_staging(["sociodemographic"], FACTORS))
def _factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planner.audience_factors(staging(spark, sf_dir, "sociodemographic"), _audience(spark))


@query(
    "r07_planner",
    with_staging(
        [],
        f"""SELECT channel, epg_title, STRFTIME(epg_start, '%Y-%m-%d %H:%M') AS epg_start,
        STRFTIME(epg_end, '%Y-%m-%d %H:%M') AS epg_end, {", ".join(f"ROUND({c}, 4) AS {c}" for c in RATINGS)} FROM titles""",
        **TITLE_CTES,
    ),
)
def _titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    factors = planner.audience_factors(staging(spark, sf_dir, "sociodemographic"), _audience(spark))
    ratings = planner.rating_by_title(staging(spark, sf_dir, "main_table"), factors)
    minutes = [F.date_format(c, "yyyy-MM-dd HH:mm").alias(c) for c in ("epg_start", "epg_end")]
    return ratings.select("channel", "epg_title", *minutes, *[F.round(c, 4).alias(c) for c in RATINGS])


def _per_minute(source: str, name: str) -> str:
    return f"ROUND({source} / NULLIF(epg_duration, 0), 2) AS {name}"


@query(
    "r08_planner_report",
    with_staging(
        [],
        f"""
        SELECT channel, epg_title, STRFTIME(epg_start, '%Y-%m-%d %H:%M') AS epg_start,
          STRFTIME(epg_end, '%Y-%m-%d %H:%M') AS epg_end, epg_duration, {_per_minute("rating", "rating_promedio")},
          {", ".join(_per_minute(c, c) for c in RATINGS[1:])}
        FROM (SELECT *, CAST(DATE_DIFF('second', epg_start, epg_end) AS DOUBLE) / 60 AS epg_duration FROM titles)
        ORDER BY channel, epg_title, epg_start""",
        **TITLE_CTES,
    ),
)
def _planner_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planner.planner_report(
        staging(spark, sf_dir, "main_table"), staging(spark, sf_dir, "sociodemographic"), _audience(spark)
    )


REQUEST_DOCUMENTS = """
    SELECT c_custkey, '{"request": [{"name": "date", "type": "range", "values": ["2024-01-' ||
      LPAD(CAST(c_nationkey + 1 AS STRING), 2, '0') || 'T03:00:20.976130", "2024-01-12T03:00:20.976130"]}, ' ||
      '{"name": "sex", "type": "list", "values": ["1"]}, {"name": "' ||
      CASE WHEN c_acctbal < 0 THEN 'age' ELSE 'age_group' END || '", "type": "list", "values": ["' || c_mktsegment ||
      '", "X"]}, {"name": "social_class", "type": "list", "values": []}]}' AS document FROM customer"""


@query(
    "p25_request_check",
    """
    SELECT c_custkey, LEAST(a, b) AS start, GREATEST(a, b) AS "end", c_acctbal >= 0 AS names_ok,
      LEAST(a, b) >= TIMESTAMP '2024-01-06' AND GREATEST(a, b) <= TIMESTAMP '2024-02-05' AS period_ok,
      CASE WHEN c_acctbal >= 0 THEN c_mktsegment || ',X' END AS age_groups
    FROM (SELECT *, TIMESTAMP '2024-01-12 03:00:20.976130' AS a,
            TIMESTAMP '2024-01-01 03:00:20.976130' + c_nationkey * INTERVAL 1 DAY AS b FROM customer)""",
)
def _request_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests with swapped and early periods and wrong names, one per customer."""
    sql = REQUEST_DOCUMENTS.replace("{", "{{").replace("}", "}}").replace("FROM customer", "FROM {customer}")
    sent = spark.sql(sql, customer=table(spark, sf_dir, "customer"))
    checked = planner.check_request(planner.parse_requests(sent, "document"), dt.datetime(2024, 2, 5))
    return checked.select(
        "c_custkey",
        F.col("start").cast("timestamp_ntz").alias("start"),
        F.col("end").cast("timestamp_ntz").alias("end"),
        "names_ok",
        "period_ok",
        F.array_join("age_group", ",").alias("age_groups"),
    )


# ---------------------------------------------------------------- audits

AUDIT_TABLES = ["accounts", "role_map", "audits", "exclusions"]
# an account is a customer; it is visited by the orders of half its number and excluded once or twice. Every visit
# repeats the account for every exclusion entry.
VISITED = """
    SELECT c_custkey, c_nationkey, c_acctbal, 'A' || c_custkey AS account, COALESCE(visits, 0) AS visits,
      LIST_CONCAT([CAST(c_acctbal < 1000 AS INT)], IF(c_acctbal < -800, [1], [])) AS flags,
      GREATEST(COALESCE(visits, 0), 1) AS times
    FROM customer LEFT JOIN (SELECT o_custkey * 2 AS of_customer, COUNT(*) AS visits FROM orders GROUP BY 1)
      ON of_customer = c_custkey"""
# the sales rep with number n answers for nation n - 2; region 4 has no manager
OWNERS = """
    SELECT n_nationkey + 2 AS rep, 'Director ' || n_regionkey AS director,
      IF(n_regionkey = 4, NULL, 'Manager ' || n_nationkey) AS manager FROM nation"""
ACCOUNT_LIST = """
    SELECT ac.*, o.director AS "Area Sales Director", o.manager AS "Account Owner Manager",
      CAST(v.visits > 0 AS INT) AS "Audit Complete",
      UNNEST(FLATTEN(LIST_TRANSFORM(RANGE(v.times), lambda i: v.flags))) AS "Exclusions"
    FROM st_accounts ac JOIN visited v ON v.account = ac."Account 18 ID" LEFT JOIN owners o ON o.rep = v.c_nationkey"""
ACCOUNT_CTES = {"visited": VISITED, "owners": OWNERS, "account_list": ACCOUNT_LIST}
# all counts of a rep at once
REPS = """
    SELECT ANY_VALUE(director) AS "Area Sales Director", ANY_VALUE(manager) AS "Account Owner Manager",
      'Owner ' || c_nationkey AS "Account (EU): Owner Name", ANY_VALUE(manager) || 'Owner ' || c_nationkey
        AS concatenated_names,
      COUNT(*) AS accounts, CAST(SUM(entries) AS BIGINT) AS entries,
      CAST(SUM(IF(c_acctbal < -500, 0, entries)) AS BIGINT) AS named, CAST(SUM(IF(visits > 0, entries, 0)) AS BIGINT) AS audits
    FROM (SELECT *, times * LEN(flags) AS entries FROM visited LEFT JOIN owners ON rep = c_nationkey) GROUP BY c_nationkey"""
REP_CTES = {"visited": VISITED, "owners": OWNERS, "reps": REPS}
REP_COLUMNS = '"Area Sales Director", "Account Owner Manager", "Account (EU): Owner Name"'
GAP_KEYS = ", ".join(
    f'"{c}"'
    for c in (
        audit.ACCOUNT_NAME, audit.AUDITED, "Channel", audit.ACCOUNT_ID, audit.DIRECTOR, audit.MANAGER, audit.OWNER,
        *audit.GAP_COLUMNS,
    )
)


def _audit_tables(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [staging(spark, sf_dir, name) for name in AUDIT_TABLES]


def _weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.weighted_accounts(*_audit_tables(spark, sf_dir))


@query("r10_account_list", with_staging(["accounts"], "SELECT * FROM account_list", **ACCOUNT_CTES))
def _account_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.account_list(*_audit_tables(spark, sf_dir))


@query(
    "r11_previous",
    with_staging(
        [],
        f"""SELECT {REP_COLUMNS}, concatenated_names, named AS "Count of Account Name", audits AS "Sum of Audits Completed",
          ROUND(IF(named > 0, audits / named * 100, NULL), 0) AS "MTD Audit %" FROM reps""",
        **REP_CTES,
    ),
)
def _previous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.previous(_weighted(spark, sf_dir))


@query(
    "r12_pivot_report",
    with_staging(
        [],
        f"""SELECT {REP_COLUMNS}, concatenated_names, entries AS "Count of Account 18 ID",
          accounts AS "Distinct Count of Account 18 ID",
          IF(concatenated_names IS NULL, NULL, named) AS "Previous # of Accounts" FROM reps""",
        **REP_CTES,
    ),
)
def _pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.pivot_report(_weighted(spark, sf_dir))


@query(
    "r13_gap_list",
    with_staging(
        ["accounts"],
        f"""SELECT {GAP_KEYS}, CAST(SUM("Exclusions") AS BIGINT) AS "Sum of Exclusions" FROM account_list
        GROUP BY {GAP_KEYS}""",
        **ACCOUNT_CTES,
    ),
)
def _gap_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.gap_list(_weighted(spark, sf_dir))


@query(
    "r14_audit_summary",
    with_staging(
        [],
        f"""
        SELECT {REP_COLUMNS}, entries AS "Count of Account Name", accounts AS "Sum of Audits Completed",
          ROUND(accounts / entries * 100, 0) AS "MTD Audit %",
          ROUND(IF(before > 0, audits / before * 100, NULL), 0) AS "Prior Week", before AS "Previous # of Accounts",
          entries - before AS "Database Movement", entries - accounts AS "No of Accounts Not Audited"
        FROM (SELECT *, IF(concatenated_names IS NULL, NULL, named) AS before FROM reps)""",
        **REP_CTES,
    ),
)
def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.summary(_weighted(spark, sf_dir))


# ---------------------------------------------------------------- consolidation

KEPT = """SELECT * FROM st_workbook WHERE "Rank" IS NULL OR "Rank" NOT IN ('Unknown', 'Intern (CS)')"""


def _sheets(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return consolidate.consolidation(staging(spark, sf_dir, "workbook"))


@query(
    "r15_consolidate",
    with_staging(
        ["workbook"],
        """
        SELECT *, 'data' AS row_kind FROM kept
        UNION ALL BY NAME SELECT 'Total' AS "Rank", SUM("Charged Hours") AS "Charged Hours", ROUND(SUM("NSR"), 2) AS "NSR",
          SUM("ANSR") AS "ANSR", 'total' AS row_kind FROM kept
        UNION ALL BY NAME SELECT 'Consolidation done' AS "Rank", 'trailer' AS row_kind""",
        kept=KEPT,
    ),
)
def _consolidated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sheets(spark, sf_dir)["Consolidated files"].withColumn("NSR", F.round("NSR", 2))


@query(
    "r15_senior_rank",
    with_staging(
        ["workbook"], """SELECT * FROM st_workbook WHERE "Rank" = 'Executive Director' OR "Rank" = 'Manager'"""
    ),
)
def _senior(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sheets(spark, sf_dir)["Senior Rank"]


@query(
    "r15_highlighted",
    with_staging(["workbook"], """SELECT * FROM st_workbook WHERE "Activity Code Description" = 'General'"""),
)
def _highlighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consolidate.highlighted(staging(spark, sf_dir, "workbook"))


@query(
    "a15_rows_per_file",
    with_staging(
        ["workbook"],
        """
        SELECT "File Name", COUNT(*) AS row_count FROM st_workbook GROUP BY 1
        UNION ALL SELECT 'Total', COUNT(*) FROM st_workbook""",
    ),
)
def _rows_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.counts_with_total(staging(spark, sf_dir, "workbook"), "File Name")


@query(
    "a13_numeric_sums",
    with_staging(
        ["workbook"],
        """SELECT SUM("Charged Hours") AS "Charged Hours", ROUND(SUM("NSR"), 2) AS "NSR", SUM("ANSR") AS "ANSR",
        CAST(SUM("Entry") AS BIGINT) AS "Entry" FROM st_workbook""",
    ),
)
def _numeric_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.numeric_sums(staging(spark, sf_dir, "workbook")).withColumn("NSR", F.round("NSR", 2))


# ---------------------------------------------------------------- comments

SCORED = """
    SELECT id, TRY_CAST(score AS DOUBLE) AS score,
      CASE WHEN LOWER(TRIM(comment)) IN ('na', '??', '.', '...', '') THEN NULL ELSE comment END AS comment
    FROM st_comments WHERE TRY_CAST(score AS DOUBLE) IS NOT NULL"""
PARTS = """
    SELECT s.score, COALESCE(p.part, 0) AS part, COALESCE(p.comment, '') AS comment, COALESCE(p.texts, 0) AS texts
    FROM (SELECT DISTINCT score FROM scored) s
    LEFT JOIN (SELECT score, CAST(FLOOR(id / 256) AS BIGINT) AS part, STRING_AGG(comment, ' ' ORDER BY id) AS comment,
                 COUNT(*) AS texts FROM scored WHERE comment IS NOT NULL GROUP BY ALL) p ON s.score = p.score"""


@query("r16_comments", with_staging(["comments"], PARTS, scored=SCORED))
def _comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comments.comments_by_score(staging(spark, sf_dir, "comments"), "id")


@query(
    "r16_summaries",
    with_staging(
        ["comments"],
        """SELECT score, COALESCE(MAX(word), 'No hay comentarios relevantes.') AS resumen
        FROM (SELECT score, UNNEST(COALESCE(STRING_SPLIT(comment, ' '), [NULL])) AS word FROM scored) GROUP BY score""",
        scored=SCORED,
    ),
)
def _summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hook for a summariser, here the word that is last in the alphabet: one answer per score."""
    parts = comments.comments_by_score(staging(spark, sf_dir, "comments"), "id")
    return comments.summary_by_score(parts, lambda text, score: max(text.split(" ")))


@query(
    "r16_key_sentences",
    with_staging(
        ["comments"],
        """
        SELECT b.score, b.id, b.pos, b.copies, b.weight, b.sentence FROM (
          SELECT l.*, w.weight, ROW_NUMBER() OVER (PARTITION BY l.score ORDER BY w.weight DESC, l.id, l.pos) AS n
          FROM listed l JOIN (
            SELECT words.score, words.sentence, CAST(FLOOR(SUM(c.n) * 1000 / COUNT(*)) AS BIGINT) AS weight
            FROM words JOIN (SELECT score, word, SUM(copies) AS n FROM words GROUP BY ALL) c
              ON words.score = c.score AND words.word = c.word GROUP BY ALL) w
            ON l.score = w.score AND l.sentence = w.sentence) b
        WHERE n <= 3""",
        scored=SCORED,
        split="""
            SELECT score, id, UNNEST(list) AS sentence, UNNEST(RANGE(LEN(list))) AS pos
            FROM (SELECT score, id, STRING_SPLIT_REGEX(comment, '[.!?\\n]+') AS list FROM scored WHERE comment IS NOT NULL)""",
        listed="""
            SELECT score, TRIM(sentence) AS sentence, MIN((id, pos))[1] AS id, CAST(MIN((id, pos))[2] AS INT) AS pos,
              COUNT(*) AS copies FROM split WHERE TRIM(sentence) <> '' GROUP BY 1, 2""",
        words="""
            SELECT score, sentence, copies, word FROM (
              SELECT score, sentence, copies, UNNEST(STRING_SPLIT_REGEX(LOWER(sentence), '[ \\t,;:]+')) AS word
              FROM listed) WHERE word <> ''""",
    ),
)
def _key_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comments.key_sentences(staging(spark, sf_dir, "comments"), "id")
