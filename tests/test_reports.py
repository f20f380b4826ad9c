"""Small hand-made cases for the reports."""

from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.plans import agents, audit, comments, consolidate, planner, rating, weblog
from tidemark.sinks import documents, ordered

VIEW = (
    "year string, month string, day string, hour string, minute string, channel string, channel_number string, "
    "location string, mac_addr_channel double, location_weight double, deco_count int"
)
REQUEST = "year string, month string, day string, hour string, minute string, channel_number string"


@pytest.fixture(scope="module")
def viewing(spark):
    at = ("2024", "01", "05", "10")
    return spark.createDataFrame(
        [
            (*at, "1", "News", "7", "here", 3.0, 0.5, 4),
            (*at, "1", "News", "7", "here", None, 0.5, 6),
            (*at, "1", "News", "7", "there", 100.0, 1.0, 1),
            (*at, "2", "News", "7", "here", 3.0, 1.0, 0),
            (*at, "3", "News", "7", "here", 1.0, 1.0, 3),
            (*at, "3", "News HD", "7", "here", 2.0, 1.0, 3),
        ],
        VIEW,
    )


def test_rating_by_minute(viewing, rows):
    rated = rating.rating_by_minute(viewing, "here")
    assert rows(rated, "minute", "channel", "rating") == [
        (1, "News", 0.25), (2, "News", None), (3, "News", 0.333), (3, "News HD", 0.667),
    ]


def test_rating_report_defaults_and_order(spark, viewing):
    at = ("2024", "1", "5", "10")
    request = spark.createDataFrame(
        [
            (*at, "1", "7"), (*at, "3", "7"), (*at, "2", "7"), (*at, "9", "7"), (*at, "1", None),
            (*at, "x", "7"), ("2024", "1", "6", "10", "1", "7"),
        ],
        REQUEST,
    )
    report = rating.rating_report(request, viewing, "here")
    found = [(r.day, r.minute, r.channel_number, r.channel, round(r.rating, 3)) for r in report.collect()]
    assert found == [
        (5, None, "7", "sin datos", 0.0),
        (5, 1, "7", "News", 0.25),
        (5, 1, "sin datos", "sin datos", 0.0),
        (5, 2, "7", "News", 0.0),
        # one number, two names
        (5, 3, "7", "News HD", 0.667),
        (5, 3, "7", "News", 0.333),
        (5, 9, "7", "sin datos", 0.0),
        # a day without data
        (6, 1, "7", "sin datos", 0.0),
    ]


def test_channel_list_is_of_yesterday(viewing, rows):
    assert rows(rating.channel_list(viewing, dt.date(2024, 1, 6))) == [("News", "7"), ("News HD", "7")]
    assert rating.channel_list(viewing, dt.date(2024, 1, 5)).count() == 0


def request_text(first, second, names=("date", "sex", "age_group", "social_class")):
    values = {"date": [first, second], "sex": ["1"], "age_group": ["[35,50)"], "social_class": ["Alto", "Medio"]}
    return json.dumps({"request": [{"name": n, "type": "list", "values": values.get(n, [])} for n in names]})


@pytest.mark.parametrize(
    ("first", "second", "names", "ok"),
    [
        ("2024-01-10T03:00:00.000001", "2024-01-12T01:00:00.000000", None, (True, True)),
        ("2024-01-12T01:00:00.000000", "2024-01-10T03:00:00.000001", None, (True, True)),
        ("2024-01-10T03:00:00.000000", "2024-01-10T03:00:00.000000", None, (True, True)),
        ("2023-11-10T03:00:00.000000", "2024-01-10T03:00:00.000000", None, (True, False)),
        ("2024-01-10T03:00:00.000000", "2024-02-10T03:00:00.000000", None, (True, False)),
        ("2024-01-10T03:00:00.000000", "2024-01-11T03:00:00.000000", ("sex", "date"), (False, True)),
        ("2024-01-10T03:00:00.000000", "2024-01-11T03:00:00.000000", ("sex",), (False, False)),
    ],
)
def test_request_check(spark, first, second, names, ok):
    text = request_text(first, second, names) if names else request_text(first, second)
    checked = planner.check_request(planner.read_request(spark, text), dt.datetime(2024, 1, 20))
    row = checked.first()
    assert (row.names_ok, row.period_ok) == ok


def test_audience_keeps_the_last_day(spark):
    # the last day begins earlier in the day than the first one
    text = request_text("2024-01-12T01:00:00.000000", "2024-01-10T03:00:00.000001")
    audience = planner.Audience.of(planner.read_request(spark, text))
    assert (audience.start, audience.end) == (dt.date(2024, 1, 10), dt.date(2024, 1, 12))
    assert audience.social_class == ["Alto", "Medio"]


def test_planner_report(spark, rows):
    start = dt.datetime(2024, 1, 7, 10)  # a Sunday
    main = spark.createDataFrame(
        [
            ("2024-01-07", "c", start, start + dt.timedelta(minutes=50), "show", 1, 2.0, 4.0),
            ("2024-01-08", "c", start + dt.timedelta(days=1), start + dt.timedelta(days=1, minutes=50), "show", 1, 1.0, 4.0),
            ("2024-01-08", "c", start, start + dt.timedelta(minutes=10), "unknown place", 9, 2.0, 4.0),
            ("2024-01-08", "c", start, start, "no time", 1, 2.0, 4.0),
            ("2024-01-08", "c", start, start + dt.timedelta(minutes=10), "no boxes", 1, 2.0, 0.0),
            ("2024-01-09", "c", start, start, "too late", 1, 2.0, 4.0),
        ],
        "fecha string, channel string, timestamp_from timestamp, timestamp_to timestamp, epg_title string, "
        "id_location int, cable_box_action double, cable_box_count double",
    )
    people = spark.createDataFrame(
        [
            (1, "a", "Alto", "1", 0.5), (1, "b", "Alto", "1", 0.25), (1, "a", "Medio", "1", 0.5),
            (1, "a", "Bajo", "1", 0.5), (1, "a", "Alto", "2", 0.5), (9, "z", "Alto", "1", 0.5),
        ],
        "id_location int, age_group string, social_class string, sex string, probability_factor double",
    )
    audience = planner.Audience(dt.date(2024, 1, 7), dt.date(2024, 1, 8), ["1"], ["a", "b"], ["Alto", "Medio"])
    assert rows(planner.audience_factors(people, audience)) == [(1, "Alto", 0.75), (1, "Medio", 0.5)]
    report = planner.planner_report(main, people, audience)
    columns = ["rating_promedio", "rating_upper_class", "rating_lower_class", "rating_sunday", "rating_monday"]
    assert rows(report, "epg_title", "epg_start", "epg_duration", *columns) == [
        ("no boxes", "2024-01-07 10:00", 10.0, None, 0.0, 0.0, 0.0, None),
        ("no time", "2024-01-07 10:00", 0.0, None, None, None, None, None),
        # 50 % on Sunday and 25 % on Monday for each of the two classes, per minute of the earliest showing
        ("show", "2024-01-07 10:00", 50.0, 3.0, 1.5, 0.0, 2.0, 1.0),
        # a place without factors: class columns and other weekdays are 0, the rest is unknown
        ("unknown place", "2024-01-07 10:00", 10.0, None, 0.0, 0.0, 0.0, None),
    ]


@pytest.fixture(scope="module")
def audit_tables(spark):
    columns = [
        audit.ACCOUNT_ID, audit.ACCOUNT_NAME, audit.OWNER, "Channel", *audit.GAP_COLUMNS,
    ]
    fill = ["x"] * (len(columns) - 3)
    accounts = spark.createDataFrame(
        [("1", "One", "O", *fill), ("2", None, "O", *fill), ("3", "Three", "P", *fill), ("4", "Four", "Q", *fill)],
        ", ".join(f"`{c}` string" for c in columns),
    )
    roles = spark.createDataFrame(
        [("O", "D", "M"), ("P", "D", None)],
        "`Account Owner/Sales Rep` string, `Area Sales Director` string, `Account Owner Manager/Sales Manager` string",
    )
    audits = spark.createDataFrame(
        [("1", "2024-01-05T10:00"), ("1", "2024-01-09T10:00"), ("9", "2024-01-09T10:00")],
        "`Account 18 ID` string, `Audit Datetime` string",
    )
    exclusions = spark.createDataFrame([("1", 1), ("2", 0)], "`Account Id` string, Exclude int")
    return accounts, roles, audits, exclusions


def test_account_list_repeats_audited_accounts(audit_tables, rows):
    listed = audit.account_list(*audit_tables)
    assert rows(listed, audit.ACCOUNT_ID, audit.DIRECTOR, audit.MANAGER, audit.AUDITED, audit.EXCLUSIONS) == [
        ("1", "D", "M", 1, 1), ("1", "D", "M", 1, 1), ("2", "D", "M", 0, 0), ("3", "D", None, 0, 0),
        ("4", None, None, 0, 0),
    ]
    assert rows(audit.audits_with_date(audit_tables[2]), "Date", audit.AUDITED)[0] == ("2024-01-05", 1)


def test_audit_reports(audit_tables, rows):
    weighted = audit.weighted_accounts(*audit_tables)
    assert rows(
        audit.previous(weighted), audit.REPORT_OWNER, audit.PAIR, "Count of Account Name", "Sum of Audits Completed",
        "MTD Audit %",
    ) == [("O", "MO", 2, 2, 100.0), ("P", None, 1, 0, 0.0), ("Q", None, 1, 0, 0.0)]
    assert rows(
        audit.pivot_report(weighted), audit.REPORT_OWNER, "Count of Account 18 ID", "Distinct Count of Account 18 ID",
        "Previous # of Accounts",
    ) == [("O", 3, 2, 2), ("P", 1, 1, None), ("Q", 1, 1, None)]
    assert rows(
        audit.summary(weighted), audit.REPORT_OWNER, "MTD Audit %", "Prior Week", "Database Movement",
        "No of Accounts Not Audited",
    ) == [("O", 67.0, 100.0, 1, 1), ("P", 100.0, None, None, 0), ("Q", 100.0, None, None, 0)]
    assert rows(audit.gap_list(weighted), audit.ACCOUNT_ID, audit.AUDITED, "Sum of Exclusions") == [
        ("1", 1, 2), ("2", 0, 0), ("3", 0, 0), ("4", 0, 0),
    ]


def test_consolidation(spark, rows):
    book = spark.createDataFrame(
        [
            ("Manager", "General", 1.0, 10.0, 5.0), ("Unknown", "x", 9.0, 9.0, 9.0), (None, "x", 2.0, 20.0, 6.0),
            ("Intern (CS)", "x", 9.0, 9.0, 9.0), ("Executive Director", "x", 3.0, None, 7.0),
        ],
        "Rank string, `Activity Code Description` string, `Charged Hours` double, NSR double, ANSR double",
    )
    sheets = consolidate.consolidation(book)
    assert rows(sheets["Consolidated files"], "row_kind", "Rank", "Charged Hours", "NSR", "ANSR") == [
        ("data", "Executive Director", 3.0, None, 7.0),
        ("data", "Manager", 1.0, 10.0, 5.0),
        ("data", None, 2.0, 20.0, 6.0),
        ("total", "Total", 6.0, 30.0, 18.0),
        ("trailer", "Consolidation done", None, None, None),
    ]
    assert rows(sheets["Senior Rank"], "Rank") == [("Executive Director",), ("Manager",)]
    assert consolidate.highlighted(book).count() == 1


@pytest.fixture(scope="module")
def answers(spark):
    return spark.createDataFrame(
        [
            (1, "9", "good food. good place"), (2, "9", " NA "), (3, "9", "bad food. good place"), (4, "3", "??"),
            (5, "3", None), (6, "bad", "lost"), (300, "9.0", "late answer"), (7, None, "lost"),
        ],
        "id bigint, score string, comment string",
    )


def test_comments_by_score(answers, rows):
    parts = comments.comments_by_score(answers, "id", width=256)
    assert rows(parts) == [
        (3.0, 0, "", 0),
        (9.0, 0, "good food. good place bad food. good place", 2),
        (9.0, 1, "late answer", 1),
    ]


def test_summaries(answers, rows):
    def summariser(text, score):
        if "late" in text:
            raise RuntimeError("no model")
        return text.upper()

    parts = comments.comments_by_score(answers, "id")
    assert rows(comments.summarise(parts, summariser), "score", "part", "resumen") == [
        (3.0, 0, "No hay comentarios relevantes."),
        (9.0, 0, "GOOD FOOD. GOOD PLACE BAD FOOD. GOOD PLACE"),
        (9.0, 1, "Error al resumir: no model"),
    ]


def test_one_summary_per_score(spark, rows):
    parts = spark.createDataFrame(
        [(1.0, i * 7, f"w{i:03d} x") for i in range(50)] + [(2.0, 0, "")], "score double, part long, comment string"
    )
    found = comments.summary_by_score(parts, lambda text, score: min(text.split()), fan_in=3)
    assert rows(found) == [(1.0, "w000"), (2.0, "No hay comentarios relevantes.")]


def test_key_sentences_count_copies_once(answers, rows):
    # good 3, place 2, food 2, bad 1, late 1, answer 1
    best = comments.key_sentences(answers, "id", n=2)
    assert rows(best, "id", "pos", "copies", "weight", "sentence") == [
        (1, 0, 1, 2500, "good food"), (1, 1, 2, 2500, "good place"),
    ]


def test_key_sentences_sort_no_words(answers, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = comments.key_sentences(answers, "id", n=2)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joined = [row for row in plan.splitlines() if "Join" in row and "_salt" in row]
    assert joined and all("ShuffledHashJoin" in row for row in joined)


def test_weblog_chain(spark, tmp_path, rows):
    agent = "Mozilla/5.0+(Windows+NT+10.0)+Chrome/114.0+Safari/537.36"

    def entry(**change):
        values = {
            "Date": "2023-06-01", "Time": "10:00:00", "ServerIP": "10.0.0.1", "Method": "GET", "UriStem": "/a.aspx",
            "UriQuery": "-", "Port": "443", "UserName": "-", "ClientIP": "1.2.3.4", "UserAgent": agent,
            "Referer": "http://x", "HttpStatus": "200", "Substatus": "0", "Win32Status": "0", "TimeTaken": "12",
        }
        return " ".join((values | change).values())

    lines = [
        "#Software: Server", "#Version: 1.0", "#Date: 2023-06-01 00:00:00",
        "#Fields: date time s-ip cs-method cs-uri-stem cs-uri-query s-port cs-username c-ip cs(User-Agent) cs(Referer) "
        "sc-status sc-substatus sc-win32-status time-taken",
        entry(), entry(ClientIP="9.9.9.9", UserAgent="Bingpreview/1.0"), entry(HttpStatus="-"), entry(HttpStatus="404"),
        entry(Method="POST"), entry(UserAgent="Googlebot/2.1"), entry(TimeTaken="0"), entry(UriStem="/a.html"),
        entry(Referer="-"), entry(UserAgent="SuperBot/1.0", ClientIP="not-an-ip"),
    ]
    deep = tmp_path / "site" / "june"
    deep.mkdir(parents=True)
    (deep / "log.txt").write_text("\n".join(lines) + "\n")

    from tidemark.sources.files import read_weblog

    blocks = spark.createDataFrame(
        [(16777216, 33554431, "Land", "North, East", 1.5, -2.5)],
        "start_ip bigint, end_ip bigint, Country string, Region string, Latitude double, Longitude double",
    )
    found = weblog.enriched_log(read_weblog(spark, str(tmp_path)), blocks)
    columns = ["ClientIP", "OS", "Browser", "Is_Mobile", *weblog.PLACE]
    assert rows(found, *columns) == [
        ("1.2.3.4", "Windows", "Chrome", False, "Land", "North, East", "1.5", "-2.5"),
        ("9.9.9.9", "Other", "Other", False, " ", " ", " ", " "),
        # the bot filter looks for lower case only
        ("not-an-ip", "Other", "Other", False, " ", " ", " ", " "),
    ]
    strict = read_weblog(spark, str(tmp_path)).where(weblog.is_page_view(ignore_bot_case=True))
    assert strict.count() == 2


def whole(fragments):
    return "".join(r.fragment for r in sorted(fragments.collect(), key=lambda r: r.place))


def test_column_document_keeps_nulls_and_order(spark, tmp_path):
    df = spark.createDataFrame([("b", None), ("a", 1)], 'k string, `v "1"` int')
    expected = {"data": [{"k": {"0": "a", "1": "b"}, 'v "1"': {"0": 1, "1": None}}]}
    assert json.loads(whole(documents.column_document(df, ["k"]))) == expected
    assert json.loads(whole(documents.column_document(df.limit(0), ["k"]))) == {"data": [{"k": {}, 'v "1"': {}}]}


def test_documents_of_many_fragments_are_one_document(spark, tmp_path):
    rng = random.Random(2)
    names = [rng.choice(["a", "é", 'q"', "line\nbreak", "\\", "]}"]) + str(n % 7) for n in range(500)]
    df = spark.createDataFrame([(n, name, [name] * (n % 3)) for n, name in enumerate(names)], "n int, name string, list array<string>")
    fragments = documents.column_document(df, [F.col("n").desc()], size=11)
    assert fragments.count() == 3 * 46 and fragments.agg(F.max(F.length("fragment"))).first()[0] < 600
    path = str(tmp_path / "d" / "data.json")
    documents.write_document(fragments, path)
    expected = {str(i): v for i, v in enumerate(reversed(names))}
    for text in (open(path, encoding="utf-8").read(), documents.read_document(spark, path).first().document):
        data = json.loads(text)["data"][0]
        assert data["name"] == expected and list(data["n"].values()) == list(range(499, -1, -1)) and len(data["list"]) == 500
    catalogue = df.select("name", F.lit("list").alias("type"), F.col("list").alias("values")).distinct()
    documents.write_document(documents.slicer_document(catalogue, size=3), path)
    entries = json.loads(open(path, encoding="utf-8").read())["parameters"]
    assert [(e["name"], e["values"]) for e in entries] == sorted((r.name, r["values"]) for r in catalogue.collect())
    assert whole(documents.slicer_document(catalogue.limit(0), "e")) == '{"e":[]}'


def test_rows_are_numbered_over_ranges(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("k"), F.col("id"))
    rows, total = ordered.numbered(df, [F.col("k").desc()], tasks=8)
    found = sorted((r._row, r.k) for r in rows.collect())
    assert total == 3000 and [n for n, _ in found] == list(range(3000)) and [k for _, k in found] == [2] * 1000 + [1] * 1000 + [0] * 1000
    # a value that a third of the rows share is dealt to several tasks
    assert ordered.in_ranges(df, ["k"], 8).groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 900


def test_report_reads_only_the_days_asked_for(spark, tmp_path):
    from tidemark.sinks.files import write_parquet
    from tidemark.sources.files import read_daily, read_text_csv

    seen = spark.range(48).select(
        F.lit(2024).alias("year"), F.lit(1).alias("month"), (F.col("id") % 24 + 1).cast("int").alias("day"),
        F.lit("10").alias("hour"), F.lit("1").alias("minute"), F.lit("News").alias("channel"),
        F.lit("7").alias("channel_number"), F.lit("here").alias("location"), F.lit(3.0).alias("mac_addr_channel"),
        F.lit(0.5).alias("location_weight"), F.lit(4).alias("deco_count"),
    )
    write_parquet(seen, str(tmp_path / "viewing"), by=["year", "month", "day"])
    (tmp_path / "ask.csv").write_text("year;month;day;hour;minute;channel_number\n2024;1;5;10;1;7\n")
    request = read_text_csv(spark, str(tmp_path / "ask.csv"), sep=";")
    report = rating.rating_report(request, read_daily(spark, str(tmp_path / "viewing")), "here")
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    assert [(r.day, r.rating) for r in report.collect()] == [(5, 0.75)]


def test_agents_are_looked_up(spark, rows):
    texts = ["Windows Edg/1", None, "curl", "Ubuntu Firefox/2", "Windows Edg/1"] + ["iPhone Safari/6"] * 60
    logs = spark.createDataFrame(list(enumerate(texts)), "n int, UserAgent string")
    plain = agents.classified(logs)
    found = agents.with_agent(logs, ["n"])
    assert rows(found) == rows(plain)
    known = agents.classified(logs.select("UserAgent").distinct().where("UserAgent IS NOT NULL AND UserAgent <> 'curl'"))
    assert rows(agents.with_agent(logs, ["n"], known).where("UserAgent <> 'curl'")) == rows(plain.where("UserAgent <> 'curl'"))
    assert rows(agents.with_agent(logs, ["n"], known).where("UserAgent = 'curl'"), "OS") == [(None,)]


def test_rules_run_on_different_agents_only(spark):
    logs = spark.createDataFrame([(1, "a", "1.2.3.4")], "n int, UserAgent string, ClientIP string")
    plan = agents.with_agent(logs, ["n"])._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    with_rules = [i for i, line in enumerate(lines) if "SamsungBrowser" in line]
    # between the rules and the scan below them stands the grouping by agent
    for i in with_rules:
        scan = next(j for j in range(i, len(lines)) if "LogicalRDD" in lines[j])
        assert any("Aggregate [UserAgent" in line for line in lines[i:scan])
    assert with_rules
