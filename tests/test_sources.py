"""CSV reading, merging, incremental ingest and history."""

from __future__ import annotations

import json
import os
from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql import Observation
from pyspark.sql import types as T

from emberlog.config import BATCH, INTERACTIVE
from emberlog.operators import clean, filters
from emberlog.plans.batch import ingest, ingest_interactive
from emberlog.plans.parse import parse_logs, parse_logs_interactive
from emberlog.schema import PARSED, missing_columns, validate_schema
from emberlog.sinks import history
from emberlog.sources import csv_logs, log_table
from emberlog.sources.csv_logs import group_by_header, list_files, read_csv_logs, read_files
from tests.conftest import HEADER, SAMPLE, tuples


def test_all_text_and_quotes(spark, write_csv):
    path = write_csv("a.csv", ["Id", "Time", "Message"], ["7", "10:15:23", 'say "hi", twice'])
    df = csv_logs.read_csv_logs(spark, path)
    assert {f.dataType for f in df.schema} == {T.StringType()}
    assert tuples(df) == [("7", "10:15:23", 'say "hi", twice')]


def test_files_are_merged_by_name(spark, write_csv, tmp_path):
    write_csv("d/a.csv", ["message", "level"], ["one", "INFO"])
    write_csv("d/b.csv", ["LEVEL", "content", "extra"], ["WARN", "two", "x"])
    write_csv("d/ignored.txt", ["message"], ["no"])
    df = csv_logs.read_csv_logs(spark, str(tmp_path / "d"))
    assert sorted(tuples(df, "message", "log_level", "extra")) == [("one", "INFO", None), ("two", "WARN", "x")]


def test_first_of_equal_names_and_nameless_columns(spark, write_csv):
    path = write_csv("a.csv", ["IP", "ip", "", "message"], ["1.1.1.1", "2.2.2.2", "z", "m"])
    df = csv_logs.read_csv_logs(spark, path)
    assert tuples(df, "ip", "_c2", "message") == [("1.1.1.1", "z", "m")]


def test_odd_files(spark, write_csv, tmp_path):
    write_csv("d d/ok[1]+%.csv", ["message"], ["kept"])
    (tmp_path / "d d" / "empty.csv").write_text("")
    (tmp_path / "d d" / "bom.csv").write_bytes("﻿message\nwith mark\n".encode())
    (tmp_path / "d d" / "crlf.csv").write_bytes(b"message\r\nwith cr\r\n")
    (tmp_path / "d d" / "header_only.csv").write_text("message,level\n")
    df = csv_logs.read_csv_logs(spark, str(tmp_path / "d d"))
    assert sorted(tuples(df, "message")) == [("kept",), ("with cr",), ("with mark",)]


def test_headers_are_found_without_reading_files(spark, write_csv, tmp_path):
    write_csv("d/a.csv", ["message", "level"], ["one", "INFO"])
    write_csv("d/b c.csv", ["x"], ["1"], ["2"])
    (tmp_path / "d" / "none.csv").write_text("\n \n")
    line = "a long line of a big file that nobody needs to see for its header\n"
    (tmp_path / "d" / "big.csv").write_text("message\n" + line * 600_000)
    files = csv_logs.list_files(spark, str(tmp_path / "d"))
    found = csv_logs.file_headers(spark, files)
    assert {os.path.basename(r.path): r.header for r in found.collect()} == {
        "a.csv": "message,level", "b%20c.csv": "x", "big.csv": "message"
    }
    # One task per file, so no file is read on the way to another's header.
    assert found.rdd.getNumPartitions() == len(files)
    rows = found._jdf.queryExecution().executedPlan()
    read = [rows]
    while not read[-1].nodeName().startswith("Scan csv"):
        read.append(read[-1].children().apply(0))
    assert "value" in read[-1].simpleString(100)


def test_headers_of_all_files_are_probed_by_one_job(spark, write_csv, tmp_path):
    for k in range(6):
        write_csv(f"many/f{k}.csv", ["message", "level"], [f"row {k}", "INFO"])
    files = csv_logs.list_files(spark, str(tmp_path / "many"))
    tracker, group = spark.sparkContext.statusTracker(), f"probe-{os.getpid()}-{id(tmp_path)}"
    spark.sparkContext.setJobGroup(group, "header probe")
    try:
        groups = group_by_header(spark, files)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert groups == {"message,level": files}
    # Not one job a file, each waiting for the one before.
    assert len(tracker.getJobIdsForGroup(group)) == 1


def test_ragged_records_are_rejects(spark, write_csv, tmp_path):
    path = tmp_path / "ragged"
    path.mkdir()
    wide = ",".join(["x"] * 30_000)
    (path / "a.csv").write_text(f'date,time,level,content\n1,2,INFO,disk full, node 7\n1,2,INFO,"disk full, node 7"\n1,2\n{wide}\n1,2,INFO,say "a, b"\n')
    (path / "b.csv").write_text('content,level\nfine,INFO\n"un,closed,INFO\n')
    rows = csv_logs.read_csv_logs(spark, str(path))
    assert sorted(tuples(rows, "message"), key=repr) == [("disk full, node 7",), ("fine",), ("un,closed,INFO",), (None,)]
    rejects = csv_logs.read_rejects(spark, str(path))
    assert sorted(tuples(rejects, "reason", "fields", "expected")) == [("long", 5, 4), ("long", 5, 4), ("long", 30_000, 4)]
    texts = {r.record for r in rejects.collect()}
    assert {"1,2,INFO,disk full, node 7", wide} <= texts and all(r.source_file.endswith("a.csv") for r in rejects.collect())
    strict = csv_logs.read_rejects(spark, str(path), strict=True)
    assert strict.filter("reason = 'short'").count() == 2
    assert csv_logs.read_csv_logs(spark, str(path), strict=True).count() + strict.count() == 7
    # However few columns are asked for.
    assert rows.select("log_level").count() == 4 and rows.count() == 4 and rejects.count() == 3
    assert csv_logs.read_rejects(spark, str(tmp_path / "nowhere")).count() == 0


def test_rejects_follow_their_files(spark, tmp_path):
    base, drop = str(tmp_path / "table"), tmp_path / "drop"
    drop.mkdir()
    (drop / "a.csv").write_text("timestamp,level,content\n2024-01-01 00:00:00,INFO,a,b\n2024-01-01 00:00:00,INFO,c\n")
    log_table.ingest_new(spark, base, str(drop))
    assert tuples(log_table.read_ingested_rejects(spark, base), "record") == [("2024-01-01 00:00:00,INFO,a,b",)]
    (drop / "a.csv").write_text("timestamp,level,content\n2024-01-01 00:00:00,INFO,\"a,b\"\n2024-01-01 00:00:00,INFO,c\n")
    log_table.ingest_new(spark, base, str(drop))
    assert log_table.read_ingested_rejects(spark, base).count() == 0
    assert sorted(tuples(log_table.read_ingested(spark, base), "message")) == [("a,b",), ("c",)]


def test_headerless(spark, write_csv):
    path = write_csv("a.csv", ["1", "x"], ["2", "y"])
    assert tuples(csv_logs.read_csv_logs(spark, path, header=False)) == [("1", "x"), ("2", "y")]


def test_multi_line_messages(spark, write_csv):
    path = write_csv("a.csv", ["message", "level"], ["first\nsecond", "INFO"])
    assert tuples(csv_logs.read_csv_logs(spark, path, multi_line=True)) == [("first\nsecond", "INFO")]


@pytest.mark.parametrize("place", ["", "nowhere"])
def test_no_files(spark, tmp_path, place):
    parsed = ingest(spark, str(tmp_path / place))
    assert parsed.count() == 0
    assert [(f.name, f.dataType) for f in parsed.schema][: len(PARSED)] == [(f.name, f.dataType) for f in PARSED]


def test_month_comes_before_date_time(spark, write_csv):
    path = write_csv("a.csv", ["Month", "Date", "Time", "Content"], ["Jun", "4", "15:16:01", "m"])
    profile = replace(BATCH, default_year=2020)
    assert tuples(ingest(spark, path, profile), "timestamp", "month") == [(datetime(2020, 6, 4, 15, 16, 1), 6)]


def test_time_alone_is_no_timestamp(spark, write_csv):
    path = write_csv("a.csv", ["Date", "Time", "Content"], ["", "15:16:01", "m"])
    assert tuples(ingest(spark, path), "timestamp", "message") == [(None, "m")]


def test_brackets_only_for_the_interactive_profile(spark, write_csv):
    path = write_csv("a.csv", ["Date", "Time", "Content"], ["[2016-09-28", "04:30:30,5]", "m"])
    assert tuples(ingest_interactive(spark, path), "timestamp") == [(datetime(2016, 9, 28, 4, 30, 30, 500000),)]
    assert tuples(ingest(spark, path), "timestamp") == [(None,)]


def test_interactive_profile(spark, write_csv):
    path = write_csv(
        "a.csv",
        ["timestamp", "level", "content"],
        ["2024-01-01 00:00:00", "Warning", "a"],
        ["2024-01-01 00:00:01", "", "b"],
        ["never", "ERROR", "c"],
    )
    df = ingest_interactive(spark, path, INTERACTIVE)
    assert sorted(tuples(df, "log_level", "message")) == [("UNKNOWN", "b"), ("WARN", "a")]
    assert df.columns == ["timestamp", "log_level", "message"]


def test_parse_without_message_column(spark):
    df = spark.createDataFrame([("2024-01-01",), (None,)], "timestamp string")
    parsed = parse_logs(df)
    assert tuples(parsed, "date", "message", "log_level", "error_type") == [
        (date(2024, 1, 1), "", "INFO", "UnknownError")
    ]


def test_parse_sample(sample):
    rows = {r.lineid: r for r in sample.collect()}
    assert [rows[str(i)].log_level for i in range(1, 11)] == [
        "INFO", "WARN", "ERROR", "ERROR", "ERROR", "INFO", "WARN", "ERROR", "INFO", "CRITICAL",
    ]
    assert [rows[i].error_type for i in ("3", "4", "5", "8")] == [
        "TimeoutError", "", "QueueFullException", "UnknownError",
    ]
    assert rows["8"].ip_address == "10.1.2.3"
    assert (rows["9"].service_name, rows["9"].endpoint_path) == ("pricing", "/v2/prices")
    assert (rows["7"].hour, rows["7"].day, rows["7"].month, rows["7"].year) == (0, 2, 3, 2026)


def test_removed_rows_are_observed(spark):
    df = spark.createDataFrame([("2024-01-01", None), (None, "  "), (None, None), (None, "m")], "timestamp string, message string")
    seen = Observation()
    assert clean.clean_null_rows(df, seen).count() == 2
    assert seen.get == {"rows_seen": 4, "rows_kept": 2}


def test_schema_checks(spark):
    df = spark.createDataFrame([], "Timestamp string, message string")
    assert validate_schema(df, ["timestamp", "MESSAGE"])
    assert missing_columns(df, ["log_level", "message"]) == ["log_level"]
    assert not validate_schema(df, ["log_level"])
    with pytest.raises(ValueError, match="log_level"):
        validate_schema(df, ["log_level"], strict=True)


def test_parsed_table_is_pruned(spark, sample, tmp_path):
    path = str(tmp_path / "parsed")
    log_table.write_parsed(sample, path)
    df = log_table.read_parsed(spark, path)
    assert df.columns[: len(PARSED)] == PARSED.fieldNames()
    assert df.count() == 10
    from emberlog.operators.filters import filter_data
    from emberlog.operators.metrics import errors_per_service

    day = filter_data(df, (date(2026, 3, 2), date(2026, 3, 2)), levels=["ERROR"])
    assert tuples(day, "lineid") == [("8",)]
    plan = errors_per_service(day)._jdf.queryExecution().executedPlan().toString()
    assert "date#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    pushed = errors_per_service(df)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(log_level,ERROR)" in pushed
    schema = pushed.split("ReadSchema: struct<")[1].split(">")[0]
    assert schema == "log_level:string,service_name:string"


def test_incremental_ingest(spark, write_csv, tmp_path):
    base, drop = str(tmp_path / "table"), str(tmp_path / "drop")
    write_csv("drop/a.csv", HEADER, *SAMPLE[:4])
    first = log_table.ingest_new(spark, base, drop)
    assert first and log_table.ingest_new(spark, base, drop) is None
    write_csv("drop/b.csv", HEADER, *SAMPLE[4:6])
    second = log_table.ingest_new(spark, base, drop)
    assert second not in (None, first)
    assert log_table.read_ingested(spark, base).count() == 6

    # A changed file replaces what it held before.
    path = write_csv("drop/a.csv", HEADER, *SAMPLE[:3], ["11", "2026-03-03", "01:00:00", "ERROR", "New", "late row"])
    os.utime(path, (2_000_000_000, 2_000_000_000))
    assert log_table.ingest_new(spark, base, drop)
    rows = log_table.read_ingested(spark, base, extra_columns=True)
    assert sorted(int(r.lineid) for r in rows.collect()) == [1, 2, 3, 5, 6, 11]

    # What a run leaves behind that dies before its manifest entry does not count.
    rows.drop("batch_id").write.parquet(f"{base}/logs/batch_id=bdead", partitionBy="date")
    assert log_table.read_ingested(spark, base).count() == 6


def test_headers_behind_blank_lines(spark, tmp_path):
    texts = {"a": "\n \nTimestamp,Level,Content\n2024-01-01 00:00:00,INFO,a\n", "b": "\ufeff\r\n\r\nLevel,Content\r\nWARN,b\r\n",
             "c": "Level,Content," + ",".join(f"x{k}" for k in range(400_000)) + "\nERROR,c\n"}
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_text(text, encoding="utf-8", newline="")
    found = group_by_header(spark, list_files(spark, str(tmp_path)))
    assert sorted(len(header) for header in found)[:2] == [13, 23] and len(found) == 3
    small = [path for header, paths in found.items() for path in paths if len(header) < 100]
    assert sorted(tuples(read_files(spark, small), "log_level", "message")) == [("INFO", "a"), ("WARN", "b")]


def test_quoted_header_over_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text('\nLevel,"Con\ntent",Message\nINFO,x,"two\nlines"\n')
    df = read_csv_logs(spark, str(tmp_path), multi_line=True)
    assert tuples(df, "log_level", "message") == [("INFO", "two\nlines")]


def test_skipped_files_are_tried_again(spark, write_csv, tmp_path):
    base, drop = str(tmp_path / "table"), str(tmp_path / "drop")
    write_csv("drop/a.csv", HEADER, *SAMPLE[:4])
    (tmp_path / "drop" / "b.csv").write_text("\n\n")
    assert log_table.ingest_new(spark, base, drop)
    assert spark.read.parquet(f"{base}/manifest").count() == 1
    assert tuples(log_table.new_files(spark, base, drop).selectExpr("path LIKE '%b.csv'")) == [(True,)]
    assert log_table.ingest_new(spark, base, drop) is None
    write_csv("drop/b.csv", HEADER, *SAMPLE[4:])
    assert log_table.ingest_new(spark, base, drop)
    assert log_table.read_ingested(spark, base).count() == 10
    # Without superseded files there is no join on the table.
    plan = log_table.read_ingested(spark, base)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "PartitionFilters: [batch_id" in plan


def test_interactive_layouts_and_dropped_rows(spark):
    texts = ["1/5/2024 3:04:05 PM", "1/5/2024 12:04 am", "January 5, 2024 15:04:05", "Jan 5, 2024 03:04:05 pm", "5-Jan-2024 15:04:05",
             "5 January 2024 15:04:05", "2024-01-05 03:04:05 PM", "2024-01-05 15:04:05", "May 5, 2024", "no time at all", None]
    seen = Observation()
    parsed = parse_logs_interactive(spark.createDataFrame([(x,) for x in texts], "timestamp string"), observation=seen)
    afternoon = datetime(2024, 1, 5, 15, 4, 5)
    assert [r.timestamp for r in parsed.collect()] == [
        afternoon, datetime(2024, 1, 5, 0, 4), *[afternoon] * 6, datetime(2024, 5, 5)
    ]
    assert seen.get == {"rows_seen": 11, "rows_kept": 9}


def test_interactive_services_can_be_searched(spark):
    raw = spark.createDataFrame([("2024-01-01", "auth", "code 77"), ("2024-01-02", "pay", "code x")], "timestamp string, service string, message string")
    df = parse_logs_interactive(raw)
    assert filters.search_logs(df, filters=filters.SearchFilter(services=("auth",))).count() == 1
    assert filters.search_logs(df, "AUTH").count() == 1 and filters.filter_data(df, services=["pay"]).count() == 1
    assert filters.search_logs(df, r"CODE \D", regex=True).first().message == "code x"
    with pytest.raises(ValueError, match="service_name"):
        filters.search_logs(df.drop("service_name"), filters=filters.SearchFilter(services=("auth",)))


def test_ingest_warns_without_messages(spark, write_csv, caplog):
    ingest(spark, write_csv("x.csv", ["Timestamp", "Level"], ["2024-01-01", "INFO"]))
    assert "neither a message nor a content column" in caplog.text


def test_json_arrays_are_bounded(spark, tmp_path):
    from emberlog.sinks.reports import export_json_array

    export_json_array(spark.range(25).coalesce(1), str(tmp_path / "j"), records=10)
    lines = [r.value for r in spark.read.text(str(tmp_path / "j")).collect()]
    assert sorted(len(json.loads(line)) for line in lines) == [5, 10, 10]


def test_history(spark, sample, tmp_path):
    base = str(tmp_path)
    assert history.read_history(spark, base).count() == 0
    record = history.record_analysis(sample, base, "ann", ["a.csv"], at=datetime(2026, 3, 5, 8))
    raw = sample.select("timestamp", "log_level", "message")
    other = history.record_analysis(raw, base, "bob", ["a.csv", "b.csv", "c.csv"])
    rows = {r.record_id: r for r in history.read_history(spark, base).collect()}
    assert (rows[record].num_errors, rows[record].num_warnings, rows[record].file_name) == (4, 2, "a.csv")
    assert rows[record].analysis_ts == datetime(2026, 3, 5, 8)
    assert rows[other].file_name == "3 files"
    assert history.load_snapshot(spark, base, record).count() == 10
    assert history.load_snapshot(spark, base, "unknown") is None


def test_display_name():
    assert history.display_name(["a.csv", "b.csv"]) == "a.csv, b.csv"
    assert history.display_name(["x" * 60]) == "x" * 47 + "..."
