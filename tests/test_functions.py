from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions import agents, dates, documents, network, nulls, text


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_null_helpers(spark):
    null = F.lit(None).cast("string")
    assert one(
        spark,
        nulls.differs_keeping_null(null, "x"),
        nulls.differs_keeping_null(F.lit("x"), "x"),
        nulls.is_number_between(F.lit("204"), 200, 299),
        nulls.is_number_between(F.lit("-"), 200, 299),
        nulls.safe_ratio(F.lit(1), F.lit(0)),
        nulls.safe_ratio(F.lit(2), F.lit(3), digits=1, scale=100),
        nulls.flag(F.lit(None).cast("boolean")),
        nulls.as_number(F.lit(" 7.5 ")),
        nulls.as_number(F.lit("seven")),
        nulls.as_number(F.lit("\t-1e3\n")),
        *[nulls.as_number(F.lit(t)) for t in ("NaN", "5d", "1f", "Infinity", "0x1", "")],
    ) == (True, False, True, None, None, 66.7, 0, 7.5, None, -1000.0, *[None] * 6)


def test_text_helpers(spark):
    null = F.lit(None).cast("string")
    assert one(
        spark,
        text.full_name(F.lit("Ann"), F.lit("Lee")),
        text.full_name(F.lit("Ann"), null),
        text.full_name(null, F.lit("Lee")),
        text.key_of(F.lit(1), null, sep="-"),
        text.key_with_blanks(F.lit(1), null, sep="-"),
        text.file_stem(F.lit("/drop/guide.2024.csv")),
        text.zero_padded(F.lit(7), 2),
    ) == ("Ann Lee", "Ann", None, None, "1-", "guide", "07")


def test_noise_comments(spark):
    noise = ["na", " NA ", "??", ".", "...", "", "  ", "na\t", "\n"]
    df = spark.createDataFrame([(c,) for c in [*noise, "ok", "n.a."]], "c string")
    assert [r[0] for r in df.select(text.is_noise(F.col("c"))).collect()] == [True] * 9 + [False] * 2


def test_fiscal_calendar(spark):
    days = [dt.date(2023, m, 1) for m in range(1, 13)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    found = df.select(dates.fiscal_quarter(F.col("d")), dates.fiscal_month(F.month("d"))).collect()
    assert [r[0] for r in found] == (
        ["RFY23-Q3"] * 3 + ["RFY23-Q4"] * 3 + ["RFY24-Q1"] * 3 + ["RFY24-Q2"] * 3
    )
    assert [r[1] for r in found] == [7, 8, 9, 10, 11, 12, 1, 2, 3, 4, 5, 6]


def test_excise_by_country_and_year(spark):
    def value(country, year):
        return one(spark, dates.excise(F.lit(country), F.lit(year).cast("int")))[0]

    assert [value("13", 2022), value("13", 2023), value("13", None), value("12", 2023), value(None, 2023)] == [
        1.07, 1.08, 1.0, 1.0, 1.0,
    ]


def test_minutes_and_texts(spark):
    a, b = F.lit("2024-01-01 10:00:00").cast("timestamp"), F.lit("2024-01-01 10:45:30").cast("timestamp")
    assert one(spark, dates.minutes_between(a, b), dates.minute_text(b), dates.weekday_name(a)) == (
        45.5, "2024-01-01 10:45", "Monday",
    )


def test_ip_numbers(spark):
    cases = {"1.2.3.4": 16909060, "255.255.255.255": 4294967295, "256.1.1.1": None, "1.2.3": None, "::1": None, None: None}
    df = spark.createDataFrame([(c,) for c in cases], "ip string")
    assert [r[0] for r in df.select(network.ip_to_long(F.col("ip"))).collect()] == list(cases.values())


def test_user_agents(spark):
    cases = [
        ("Mozilla/5.0 (Windows NT 10.0) Chrome/114.0 Safari/537.36 Edg/114.0", "Windows", "Other", "Edge", False),
        ("Mozilla/5.0+(iPhone;+CPU+iPhone+OS+16_5)+Version/16.5+Mobile/15E148+Safari/604.1", "iOS", "iPhone", "Mobile Safari", True),
        ("Mozilla/5.0 (Linux; Android 13; Pixel 7) Chrome/112.0 Mobile Safari/537.36", "Android", "Pixel", "Chrome Mobile", True),
        ("Mozilla/5.0 (Linux; Android 12; Tab) Chrome/112.0 Safari/537.36", "Android", "Generic Tablet", "Chrome", False),
        ("Mozilla/5.0 (X11; Linux x86_64; rv:109.0) Gecko/20100101 Firefox/114.0", "Linux", "Other", "Firefox", False),
        ("curl/8.0", "Other", "Other", "Other", False),
        (None, "", "", "", False),
    ]
    df = spark.createDataFrame([(c[0],) for c in cases], "a string")
    a = F.col("a")
    found = df.select(agents.agent_os(a), agents.agent_device(a), agents.agent_browser(a), agents.agent_is_mobile(a))
    assert [tuple(r) for r in found.collect()] == [c[1:] for c in cases]


def test_slicers_last_name_wins(spark):
    document = '{"request": [{"name": "sex", "values": ["1"]}, {"name": "sex", "values": ["2"]}]}'
    slicers = documents.parse_slicers(F.lit(document), "request")
    assert one(
        spark, documents.slicer_values(slicers, "sex"), documents.slicer_values(slicers, "age"), documents.slicer_names(slicers)
    ) == (["2"], None, ["sex", "sex"])
