"""Sources, sinks, retries and file streams."""

from __future__ import annotations

import datetime as dt
import os
import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.agents import AgentDictionary
from tidemark.session import shared_folder, working_folder
from tidemark.sinks import files as sinks
from tidemark.sinks.versions import Change, Versions
from tidemark.sources import files as sources
from tidemark.sources import jdbc, retry
from tidemark.streaming import ingest, requests, tails


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert working_folder(spark, "a") != working_folder(spark, "a")


def guide(path, *ids):
    text = "ID,SIGNAL,FROM,TO,TITLE,CATEGORY\n" + "".join(f"{i},s,f,t,Title {i},c\n" if i else ",,,,,\n" for i in ids)
    path.write_text(text)


def test_epg_scan_tags_and_cleans(spark, tmp_path, rows):
    guide(tmp_path / "one.v1.csv", 1, None)
    guide(tmp_path / "two.csv", 2)
    (tmp_path / "note.txt").write_text("no guide")
    found = sources.with_file_stem(sources.read_epg(spark, str(tmp_path)))
    assert rows(found, "epg_id", "epg_title", "s3_file") == [("1", "Title 1", "one"), ("2", "Title 2", "two")]


def test_workbooks_skip_banner_and_lock_files(spark, tmp_path, rows):
    banner = "".join(f"line {i}\n" for i in range(6))
    (tmp_path / "a.csv").write_text(banner + "Rank,Hours\nManager,1.5\n\n\"Staff, new\",2\n\"Two\nlines\",4\n")
    (tmp_path / "b.csv").write_text(banner.replace("\n", "\r\n") + "Rank,Hours\r\n,3\r\n")
    (tmp_path / "~$a.csv").write_text("lock")
    schema = T.StructType([T.StructField("Rank", T.StringType()), T.StructField("Hours", T.DoubleType())])
    found = sources.read_workbooks(spark, str(tmp_path), schema)
    assert rows(found) == [
        ("Manager", 1.5, "a.csv"), ("Staff, new", 2.0, "a.csv"), ("Two\nlines", 4.0, "a.csv"), (None, 3.0, "b.csv"),
    ]


def test_daily_partitions_are_pruned(spark, tmp_path):
    days = spark.range(40).select("id", F.expr("date_add(date'2024-01-01', cast(id as int))").alias("d"))
    parts = {"year": F.year("d"), "month": F.month("d"), "day": F.dayofmonth("d")}
    sinks.write_parquet(days.withColumns(parts), str(tmp_path / "t"), by=["year", "month", "day"])
    daily = sources.read_daily(spark, str(tmp_path / "t"))
    assert sources.on_day(daily, dt.date(2024, 2, 1)).count() == 1
    assert sources.on_days(daily, [dt.date(2024, 1, 1), dt.date(2024, 2, 2), dt.date(2025, 1, 1)]).count() == 2
    assert sources.on_days(daily, []).count() == 0
    assert sources.between_days(daily, dt.date(2024, 1, 30), dt.date(2024, 2, 2)).count() == 4
    plan = sources.on_day(daily, dt.date(2024, 2, 1))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_missing_input(spark, tmp_path):
    (tmp_path / "there").mkdir()
    (tmp_path / "there" / "x.csv").write_text("a,b\n1,2\n,\n")
    assert sources.exists(spark, str(tmp_path / "there"))
    assert not sources.exists(spark, str(tmp_path / "gone"))
    # anything but a missing path is an error
    with pytest.raises(Exception):
        sources.exists(spark, str(tmp_path / "there"), "no_such_format")
    found = sources.read_datasets(spark, {"a": str(tmp_path / "there"), "b": str(tmp_path / "gone")})
    assert list(found) == ["a"] and found["a"].collect() == [(1, 2)]
    assert sources.read_day_folders(spark, str(tmp_path), [dt.date(2024, 1, 1)]) is None
    spark.range(3).write.parquet(sources.day_folder(str(tmp_path), dt.date(2024, 1, 2)))
    spark.range(4).write.parquet(sources.day_folder(str(tmp_path), dt.date(2024, 2, 2)))
    asked = [dt.date(2024, 1, 1), dt.date(2024, 2, 2), dt.date(2024, 1, 2), dt.date(2024, 2, 2)]
    assert sources.read_day_folders(spark, str(tmp_path), asked).count() == 7
    assert sources.day_folder("/x/", dt.date(2024, 3, 4)) == "/x/2024/03/04"


def test_report_file(spark, tmp_path):
    assert sinks.report_name("ask.csv", dt.date(2024, 1, 2)) == "ask_2024-01-02"
    out = str(tmp_path / "r")
    sinks.write_report(spark.range(5).repartition(3), out, [F.col("id").desc()])
    files = [f for f in os.listdir(out) if f.endswith(".csv")]
    assert len(files) == 1 and "_SUCCESS" not in os.listdir(out)
    assert open(os.path.join(out, files[0])).read().split() == ["id", "4", "3", "2", "1", "0"]


def test_retry_only_what_may_pass():
    calls = []

    def deadlocked():
        calls.append(1)
        if len(calls) < 3:
            raise RuntimeError("chosen as deadlock victim")
        return "written"

    assert retry.with_retry(deadlocked, retry.WRITE_ATTEMPTS, 0, retry.is_deadlock) == "written"
    assert len(calls) == 3

    def broken():
        calls.append(1)
        raise RuntimeError("no such table")

    with pytest.raises(RuntimeError, match="no such table"):
        retry.with_retry(broken, 3, 0, retry.is_deadlock)
    assert len(calls) == 4
    with pytest.raises(RuntimeError, match="always"):
        retry.with_retry(lambda: (_ for _ in ()).throw(RuntimeError("always")), 2, 0)


def test_jdbc_options():
    source = jdbc.Connection("jdbc:x://host/db", "org.x.Driver", "u", "secret")
    assert source.options() == {
        "url": "jdbc:x://host/db", "driver": "org.x.Driver", "user": "u", "password": "secret", "fetchsize": "10000",
    }
    assert "secret" not in repr(source)
    assert jdbc.Split("id", "0", "100", 8).options()["numPartitions"] == "8"


@pytest.mark.parametrize("kind", ["even", "skewed", "dates", "text", "copies"])
def test_balanced_splits_hold_every_row_once(kind):
    rng = random.Random(7)
    keys = {
        "even": lambda: rng.randint(-10_000, 10_000),
        "skewed": lambda: int(2 ** rng.uniform(0, 40)),
        "dates": lambda: dt.date(2020, 1, 1) + dt.timedelta(days=int(rng.expovariate(0.002))),
        "text": lambda: rng.choice("aaaab'c") + str(rng.randint(0, 10**9)),
        "copies": lambda: rng.choice([5, 5, 5, 5, rng.randint(0, 1000)]),
    }[kind]
    base = duckdb.connect()
    rows = [(n, keys() if n % 40 else None) for n in range(4000)]
    frame = pd.DataFrame({"n": [n for n, _ in rows], "k": pd.Series([k for _, k in rows], dtype="object" if kind in ("dates", "text") else "Int64")})
    base.register("frame", frame)
    base.execute(f"CREATE TABLE t AS SELECT n, CAST(k AS {dict(dates='DATE', text='VARCHAR').get(kind, 'BIGINT')}) AS k FROM frame")
    firsts = [first for _, first in base.execute(jdbc.quantile_statement("t", "k", 16)).fetchall()]
    predicates = jdbc.range_predicates("k", firsts)
    found = [[n for (n,) in base.execute(f"SELECT n FROM t WHERE {p}").fetchall()] for p in predicates]
    assert sorted(sum(found, [])) == list(range(4000)) and len(found[-1]) == 100
    sizes = list(map(len, found[:-1]))
    if kind == "copies":  # one key holds most rows, and no range can cut it
        assert sorted(sizes)[-2] <= 2 * 3900 / 16
    else:
        assert len(sizes) == 16 and max(sizes) <= 2 * min(sizes)


def test_split_of_an_empty_table_or_a_single_key():
    assert jdbc.range_predicates("k", []) == ["k IS NOT NULL", "k IS NULL"]
    assert jdbc.range_predicates("k", [3, 3, None]) == ["k IS NOT NULL", "k IS NULL"]
    assert jdbc.range_predicates("k", ["a'b", "c"]) == ["k < 'c'", "k >= 'c'", "k IS NULL"]


def test_requests_of_many_layouts_are_one_scan(spark, tmp_path, rows):
    names = ["year", "month", "day", "hour", "minute", "channel_number"]
    for n in range(12):
        layout = [*names, *[f"x{i}" for i in range(n)]]
        random.Random(n).shuffle(layout)
        cells = {c: f"{c}{n}" for c in layout} | {"channel_number": f'"{n};7"', "x0": '"a ""b"" c"'}
        head = ";".join(f' "{c}" ' if n % 3 == 0 else c for c in layout)
        (tmp_path / f"r {n}.csv").write_text("\ufeff" * (n % 2) + head + "\r\n" + ";".join(cells[c] for c in layout) + "\r\n\r\n")
    (tmp_path / "short.csv").write_text("year;month\n1;2\n")
    (tmp_path / "empty.csv").write_text("\n")
    paths = sorted(str(p) for p in tmp_path.iterdir())
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("requests", "")
    found, accepted = requests.read_requests(spark, paths)
    assert len(jobs.getJobIdsForGroup("requests")) <= 6
    assert [p.rsplit("/", 1)[-1] for p in accepted] == sorted(f"r {n}.csv" for n in range(12))
    expected = sorted(tuple(f"{c}{n}" for c in names[:5]) + (f"{n};7",) for n in range(12))
    assert sorted(tuple(r) for r in found.select(*names).collect()) == expected


def test_epg_ingest_takes_each_file_once(spark, tmp_path, rows):
    drop, out = tmp_path / "drop", tmp_path / "out"
    drop.mkdir()

    def run():
        ingest.ingest_epg(spark, str(drop), str(out / "parquet"), str(out / "ledger"), archive=str(out / "processed"))
        return rows(spark.read.parquet(str(out / "parquet")), "epg_id", "s3_file")

    guide(drop / "one.csv", 1, None)
    assert run() == [("1", "one")]
    guide(drop / "two.csv", 2)
    assert run() == [("1", "one"), ("2", "two")]
    guide(drop / "three.csv", 3)
    assert run() == [("1", "one"), ("2", "two"), ("3", "three")]
    # files of earlier runs were moved away, none was lost
    assert not [p for p in drop.iterdir() if p.suffix == ".csv"]
    assert sorted(p.name for p in (out / "processed").rglob("*.csv")) == ["one.csv", "three.csv", "two.csv"]
    # a file that comes again under its old name replaces its rows
    guide(drop / "two.csv", 4, 5)
    assert run() == [("1", "one"), ("3", "three"), ("4", "two"), ("5", "two")]
    assert run() == [("1", "one"), ("3", "three"), ("4", "two"), ("5", "two")]


def test_ingest_without_archive_takes_changed_files_only(spark, tmp_path, rows):
    drop, out = tmp_path / "drop", tmp_path / "out"
    drop.mkdir()
    guide(drop / "one.csv", 1)
    guide(drop / "two.csv", 2)
    args = (spark, str(drop), str(out / "parquet"), str(out / "ledger"))
    assert len(ingest.ingest_epg(*args)) == 2 and ingest.ingest_epg(*args) == []
    guide(drop / "two.csv", 7)
    os.utime(drop / "two.csv", (2_000_000_000, 2_000_000_000))
    assert [p.rsplit("/", 1)[-1] for p in ingest.ingest_epg(*args)] == ["two.csv"]
    assert rows(spark.read.parquet(str(out / "parquet")), "epg_id", "s3_file") == [("1", "one"), ("7", "two")]


def test_requests_are_answered_per_file(spark, tmp_path, rows):
    drop, out = tmp_path / "drop", tmp_path / "out"
    drop.mkdir()
    head = "year;month;day;hour;minute;channel_number\n"
    # columns go by name, whatever their order; a file that lacks one is refused
    (drop / "first.csv").write_text("channel_number;note;minute;hour;day;month;year\n7;x;1;10;5;1;2024\n")
    (drop / "lacking.csv").write_text("channel_number;minute\n7;1\n")
    (drop / "second.csv").write_text(head + "2024;1;5;10;1;8\n2024;1;5;10;2;7\n")
    viewing = spark.createDataFrame(
        [("2024", "01", "05", "10", "01", "News", "7", "here", 3.0, 0.5, 4)],
        "year string, month string, day string, hour string, minute string, channel string, channel_number string, "
        "location string, mac_addr_channel double, location_weight double, deco_count int",
    )
    answered = requests.answer_requests(
        spark, str(drop), viewing, str(out / "csv"), str(out / "ledger"), dt.date(2024, 1, 6), "here"
    )
    assert len(answered) == 2 and [p.name for p in drop.iterdir() if p.suffix == ".csv"] == ["lacking.csv"]
    assert all(len(list(p.glob("*.csv"))) == 1 for p in (out / "csv").glob("report=*"))
    reports = spark.read.options(header="true", sep=";").csv(str(out / "csv"))
    assert rows(reports, "report", "channel_number", "minute", "channel", "rating") == [
        ("first_2024-01-06", "7", "1", "News", "0.375"),
        ("second_2024-01-06", "7", "2", "sin datos", "0.0"),
        ("second_2024-01-06", "8", "1", "sin datos", "0.0"),
    ]


def test_failed_answer_keeps_the_request(spark, tmp_path):
    drop, out = tmp_path / "drop", tmp_path / "out"
    drop.mkdir()
    (drop / "ask.csv").write_text("year;month;day;hour;minute;channel_number\n2024;1;5;10;1;7\n")
    broken = spark.range(1)  # no viewing table at all
    with pytest.raises(Exception):
        requests.answer_requests(
            spark, str(drop), broken, str(out / "csv"), str(out / "ledger"), dt.date(2024, 1, 6)
        )
    assert [p.name for p in drop.iterdir()] == ["ask.csv"]


def test_request_delivered_again_is_answered_again(spark, tmp_path, rows):
    drop, out = tmp_path / "drop", tmp_path / "out"
    drop.mkdir()
    viewing = spark.createDataFrame(
        [], "year string, month string, day string, hour string, minute string, channel string, channel_number string, "
        "location string, mac_addr_channel double, location_weight double, deco_count int",
    )
    for day, minute in ((6, 1), (8, 2), (8, 3)):
        (drop / "ask.csv").write_text(f"year;month;day;hour;minute;channel_number\n2024;1;5;10;{minute};7\n")
        requests.answer_requests(spark, str(drop), viewing, str(out / "csv"), str(out / "ledger"), dt.date(2024, 1, day))
    reports = spark.read.options(header="true", sep=";").csv(str(out / "csv"))
    assert rows(reports, "report", "minute") == [("ask_2024-01-06", "1"), ("ask_2024-01-08", "3")]


AGENT = "Mozilla/5.0+(iPhone;+CPU)+Safari/604.1"


def log_line(n, agent=AGENT, ip="10.0.0.1", status=200):
    return f"2024-01-01 00:00:{n:02} 10.0.0.1 GET /p{n}.aspx - 443 - {ip} {agent} http://r {status} 0 0 {n + 1}"


def test_growing_logs_give_every_line_once(spark, tmp_path):
    drop, out = tmp_path / "logs" / "day one", str(tmp_path / "out")
    drop.mkdir(parents=True)
    blocks = spark.createDataFrame(
        [("10.0.0.0", "10.0.0.255", "A", "r", "1", "2"), ("2001:db8::", "2001:db8::ffff", "B", "r", "1", "2")],
        "start_ip string, end_ip string, Country string, Region string, Latitude string, Longitude string",
    )

    def run():
        changed = ingest.append_weblog(spark, str(tmp_path / "logs"), blocks, f"{out}/t", f"{out}/agents")
        table = ingest.read_weblog_table(spark, f"{out}/t")
        return len(changed), sorted((r["UriStem"], r["Country"], r["Device"]) for r in table.collect()) if table else None

    assert run() == (0, None)
    one, two = drop / "one.log", drop / "two 100%.log"
    phone = lambda *numbers: [(f"/p{n}.aspx", "A", "iPhone") for n in numbers]
    # the last line is not complete yet
    one.write_text("#Fields: date time\n" + log_line(1) + "\r\n" + log_line(2)[:40])
    assert run() == (1, phone(1))
    assert run() == (0, phone(1))
    one.write_text("#Fields: date time\n" + "".join(log_line(n) + "\r\n" for n in (1, 2, 3)))
    two.write_text(log_line(4, ip="2001:db8::7") + "\n\n" + log_line(5, status=404) + "\n")
    assert run() == (2, [*phone(1, 2, 3), ("/p4.aspx", "B", "iPhone")])
    # equal lines that come again are lines of their own
    with two.open("a") as file:
        file.write((log_line(6) + "\n") * 2)
    assert run() == (1, [*phone(1, 2, 3), ("/p4.aspx", "B", "iPhone"), *phone(6, 6)])
    # a file that shrank and one that was replaced have their lines replaced
    one.write_text(log_line(3) + "\n")
    assert run() == (1, [*phone(3), ("/p4.aspx", "B", "iPhone"), *phone(6, 6)])
    two.write_text("".join(log_line(n) + "\n" for n in range(10, 40)))
    assert run()[1] == sorted(phone(*range(10, 40), 3))
    # an emptied file says nothing until it has a line again
    two.write_text("")
    assert run() == (0, sorted(phone(*range(10, 40), 3)))
    two.write_text(log_line(8) + "\n")
    assert run() == (1, phone(3, 8))


def test_growing_file_of_many_blocks(spark, tmp_path):
    text = [f"{'é' * (n % 50)} line {n}" for n in range(4000)]
    path = tmp_path / "a.log"
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        ledger, found = None, []
        for end in (1500, 1501, 4000):
            path.write_text("".join(line + "\n" for line in text[:end]), newline="")
            taken = tails.take_lines(spark, str(tmp_path), ledger)
            found.append([r["value"] for r in taken.lines.collect()])
            ledger = taken.ledger
            assert taken.given_up.count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [len(f) for f in found] == [1500, 1, 2499] and sorted(sum(found, [])) == sorted(text)


def test_failed_log_run_changes_nothing(spark, tmp_path):
    (tmp_path / "logs").mkdir()
    (tmp_path / "logs" / "a.log").write_text(log_line(1) + "\n")
    broken = spark.range(1)  # no blocks at all
    with pytest.raises(Exception):
        ingest.append_weblog(spark, str(tmp_path / "logs"), broken, str(tmp_path / "t"))
    assert ingest.read_weblog_table(spark, str(tmp_path / "t")) is None


def test_dictionary_classifies_new_agents_only(spark, tmp_path, rows):
    kept = AgentDictionary(spark, str(tmp_path / "agents"))

    def logs(*agents):
        return spark.createDataFrame([(a,) for a in agents], "UserAgent string")

    assert kept.read() is None and kept.extend(logs("Windows Edg/1", "Windows Edg/1", None))
    first = kept.table.manifest()["datasets"]["agents"]
    assert kept.extend(logs("Windows Edg/1", "Ubuntu Firefox/2")) and not kept.extend(logs("Ubuntu Firefox/2"))
    folders = kept.table.manifest()["datasets"]["agents"]
    assert folders[:1] == first and len(folders) == 2
    added = spark.read.parquet(f"{kept.table.path}/data/{folders[1]}")
    assert rows(added) == [("Ubuntu Firefox/2", "Ubuntu", "Other", "Firefox", False)]
    assert rows(kept.read(), "UserAgent", "Browser") == [("Ubuntu Firefox/2", "Firefox"), ("Windows Edg/1", "Edge")]


def test_failing_overwrite_leaves_the_old_version(spark, tmp_path):
    table = Versions(spark, str(tmp_path / "t"))
    assert table.read() is None
    table.publish({"rows": Change(spark.range(3))})
    before = table.read()
    broken = spark.range(5).select(F.raise_error(F.lit("disk full")).cast("long").alias("id"))
    with pytest.raises(Exception, match="disk full"):
        table.publish({"rows": Change(broken, "overwrite")})
    assert table.read().count() == 3
    # a reader that has begun keeps its version while another one is published
    table.publish({"rows": Change(table.read().select((F.col("id") + 10).alias("id")), "overwrite")})
    assert before.count() == 3 and sorted(r.id for r in table.read().collect()) == [10, 11, 12]
    assert sorted(r.id for r in table.read(number=0).collect()) == [0, 1, 2]


def test_repeated_batch_adds_nothing(spark, tmp_path):
    table = Versions(spark, str(tmp_path / "t"))
    assert table.publish({"rows": Change(spark.range(3)), "log": Change(spark.range(1), "overwrite")}, batch="monday")
    assert not table.publish({"rows": Change(spark.range(3))}, batch="monday")
    assert table.publish({"rows": Change(spark.range(3, 4))}, batch="tuesday")
    assert table.read().count() == 4 and table.read("log").count() == 1 and table.numbers() == [0, 1]
    with pytest.raises(ValueError, match="columns"):
        table.publish({"rows": Change(spark.range(3).withColumn("more", F.lit(1)))})
    with pytest.raises(ValueError, match="appended"):
        table.publish({"rows": Change(spark.range(3), "merge")})


def test_two_writers_do_not_lose_each_other(spark, tmp_path, monkeypatch):
    table, other = Versions(spark, str(tmp_path / "t")), Versions(spark, str(tmp_path / "t"))
    table.publish({"rows": Change(spark.range(1))})
    put, waiting = Versions._put, [True]

    def late(self, manifest, number):
        if self is table and waiting:
            waiting.clear()
            other.publish({"rows": Change(spark.range(10, 12))})
        return put(self, manifest, number)

    monkeypatch.setattr(Versions, "_put", late)
    assert table.publish({"rows": Change(spark.range(20, 21))})
    assert sorted(r.id for r in table.read().collect()) == [0, 10, 11, 20] and table.numbers() == [0, 1, 2]


def test_compacted_and_expired_table_keeps_its_rows(spark, tmp_path):
    table = Versions(spark, str(tmp_path / "t"))
    for n in range(4):
        table.publish({"rows": Change(spark.range(n * 10, n * 10 + 3))})
    table.compact("rows", 1)
    assert len(table.manifest()["datasets"]["rows"]) == 1 and table.expire(1) == 4
    assert table.read().count() == 12 and table.numbers() == [4]
