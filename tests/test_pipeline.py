"""The batch run with its files, and the drop-folder streams."""

from __future__ import annotations

import json
from datetime import datetime, timedelta
from pathlib import Path

import pytest

from emberlog.operators import metrics
from emberlog.operators.rules import with_alert_id
from emberlog.plans import reports
from emberlog.plans.batch import ingest, run_batch
from emberlog.plans.parse import parse_logs
from emberlog.streaming import drop_folder
from tests.conftest import HEADER, SAMPLE, tuples
from tests.test_alerting import alert_table


def one_file(folder, suffix):
    """The text of all files of a report in their order."""
    return "".join(file.read_text() for file in sorted(Path(folder).glob(f"part-*{suffix}")))


def test_batch_run(spark, write_csv, tmp_path):
    path, out = write_csv("logs/a.csv", HEADER, *SAMPLE), str(tmp_path / "out")
    at = datetime(2026, 3, 3, 12)
    result = run_batch(spark, path, out, at=at, username="ann")
    assert spark.read.parquet(result.parsed_path).count() == 10
    assert one_file(f"{out}/reports/csv/errors_by_type", ".csv").splitlines() == [
        "error_type,count",
        '"",1',
        "QueueFullException,1",
        "TimeoutError,1",
        "UnknownError,1",
    ]
    summary = json.loads(one_file(f"{out}/reports/json/summary", ".json"))
    assert summary["total_logs"] == 10
    levels = spark.read.json(f"{out}/reports/json/level_counts")
    assert dict(tuples(levels, "log_level", "count"))["ERROR"] == 4
    by_day = [json.loads(line) for line in one_file(f"{out}/reports/json/errors_by_day", ".json").splitlines()]
    assert by_day == [{"date": "2026-03-01", "error_count": 3}, {"date": "2026-03-02", "error_count": 1}]
    alerts = spark.read.parquet(result.alerts_path)
    assert tuples(alerts, "alert_ts", "username", "alert_type") == [(at, "ann", "HIGH_ERROR_RATE")]
    lines = spark.read.text(f"{out}/alert_lines")
    assert tuples(lines) == [("[2026-03-03 12:00:00] [CRITICAL] HIGH_ERROR_RATE: Error rate 40.00% exceeds threshold 10.00%",)]
    # A second run replaces the reports and appends to the alerts.
    run_batch(spark, path, out, at=at + timedelta(hours=1), username="ann")
    assert spark.read.parquet(result.parsed_path).count() == 10
    assert spark.read.parquet(result.alerts_path).count() == 2


def test_cube_agrees_with_single_reports(spark, sample):
    # Rows without timestamp, type, address or message belong in.
    gaps = spark.createDataFrame(
        [(None, "ERROR", "lost"), ("2026-03-01 09:30:00", "ERROR", None)], "timestamp string, log_level string, message string"
    )
    rows = sample.unionByName(parse_logs(gaps), allowMissingColumns=True)
    cube = reports.counts_cube(rows).cache()
    single = reports.run_all(rows)
    cut = reports.from_cube(cube)
    assert set(cut) == set(single)
    for name, df in single.items():
        assert tuples(cut[name]) == tuples(df), name
        assert cut[name].columns == df.columns
    cube.unpersist()


def test_cube_scans_once(sample):
    plan = reports.counts_cube(sample)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_detail_reports(spark, sample, tmp_path):
    for form in ("csv", "json", "parquet"):
        head, rows = reports.export_detail(sample, str(tmp_path), form)
        reader = spark.read.option("header", True) if form == "csv" else spark.read
        assert reader.format(form).load(rows).count() == 4, form
        assert reader.format(form).load(head).count() == 1
    meta = json.loads(one_file(f"{tmp_path}/json/report_head", ".json"))
    assert meta["report_meta"] == {"total_logs": 10, "total_errors": 4, "total_warnings": 2, "error_rate_percent": 40.0}
    assert [e["message"] for e in meta["top_errors"]][:1] == ["QueueFullException while adding"]


def test_report_head_is_one_cell_per_value(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1), "ERROR", "a, b\nc")], "timestamp timestamp, log_level string, message string")
    assert reports.report_summary(df).first().most_frequent_error == "a; b c (Count: 1)"


def stream_once(spark, tmp_path):
    stream = drop_folder.read_stream(spark, str(tmp_path / "drop"), HEADER)
    drop_folder.start_error_trends(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    return tuples(drop_folder.read_error_trends(spark, str(tmp_path / "out")))


def test_streamed_trend_grows_with_the_folder(spark, write_csv, tmp_path):
    nine, ten, eight = datetime(2026, 3, 1, 9), datetime(2026, 3, 1, 10), datetime(2026, 3, 2, 8)
    write_csv("drop/a.csv", HEADER, *SAMPLE[:3])
    assert stream_once(spark, tmp_path) == [(nine, 1)]
    write_csv("drop/b.csv", HEADER, *SAMPLE[3:])
    # The 09:00 window goes on where the first run stopped.
    assert stream_once(spark, tmp_path) == [(nine, 2), (ten, 1), (eight, 1)]
    # Nothing new, nothing changes.
    assert stream_once(spark, tmp_path) == [(nine, 2), (ten, 1), (eight, 1)]


def test_streamed_trend_is_the_batch_trend(spark, write_csv, sample, tmp_path):
    write_csv("drop/a.csv", HEADER, *SAMPLE)
    assert stream_once(spark, tmp_path) == tuples(metrics.error_trends(sample))


def test_stream_rejects_too_late_rows(spark, write_csv, tmp_path):
    write_csv("drop/a.csv", HEADER, *SAMPLE)
    before = stream_once(spark, tmp_path)
    write_csv("drop/late.csv", HEADER, ["11", "2026-02-01", "00:00:00", "ERROR", "x", "very late"])
    assert stream_once(spark, tmp_path) == before


def dedup_stream(spark, folder, out, checkpoint):
    schema = alert_table(spark, [("a", datetime(2024, 1, 1), "A")]).schema
    stream = spark.readStream.schema(schema).parquet(folder)
    drop_folder.start_alert_dedup(stream, out, checkpoint).awaitTermination()
    return sorted(tuples(drop_folder.read_sent_alerts(spark, out), "username", "alert_ts", "alert_type"), key=repr)


def test_streamed_alert_dedup(spark, tmp_path):
    start, hour = datetime(2024, 1, 1), timedelta(hours=1)
    drop, out = str(tmp_path / "alerts"), str(tmp_path / "kept")

    def run(*rows):
        alert_table(spark, rows).write.mode("append").parquet(drop)
        return dedup_stream(spark, drop, out, str(tmp_path / "cp"))

    first = run(("ann", start, "A"), ("bob", start, "A"), ("ann", start, "B"), (None, start, "A"))
    assert len(first) == 4
    # A repeat within the hour is dropped, another user's first alert is not.
    second = run(("ann", start + hour / 2, "A"), ("eve", start + hour / 2, "A"), (None, start + hour / 2, "A"))
    assert len(second) == 5
    # After exactly the cooldown the type may be sent again.
    assert ("ann", start + hour, "A") in run(("ann", start + hour, "A"))


def test_dedup_gathers_no_user_in_one_value(spark, capsys):
    start = datetime(2024, 1, 1)
    alerts = alert_table(spark, [("u", start + timedelta(minutes=k), "A") for k in range(300)] + [(None, start, "A")])
    last = spark.createDataFrame([("u", "A", 1704067200_000_000 - 1800_000_000)], "username string, alert_type string, last bigint")
    sent = drop_folder.without_repeats(alerts, last)
    sent.explain(True)
    assert "collect_" not in capsys.readouterr().out
    found = sorted(tuples(sent, "username", "alert_ts"), key=repr)
    assert found == sorted([("u", start + timedelta(minutes=30 + 60 * k)) for k in range(5)] + [(None, start)], key=repr)


def test_alerts_out_of_order_are_sent_as_in_order(spark, tmp_path):
    start = datetime(2024, 1, 1)
    minutes = [0, 30, 61, 90, 130, 200, 259, 260, 400, 401, 461]
    alerts = [("ann", start + timedelta(minutes=m), "A") for m in minutes] + [("bob", start + timedelta(minutes=70), "B")]
    shuffled = [alerts[k] for k in (3, 0, 11, 2, 1, 5, 4, 8, 6, 7, 10, 9)]
    drop, out = str(tmp_path / "drop"), str(tmp_path / "out")
    for k in range(0, len(shuffled), 3):
        alert_table(spark, shuffled[k : k + 3]).coalesce(1).write.mode("append").parquet(drop)
        stream = spark.readStream.schema(spark.read.parquet(drop).schema).parquet(drop)
        drop_folder.start_alert_dedup(stream, out, str(tmp_path / "cp"), lateness_s=200 * 60).awaitTermination()
    drop_folder.release_held(spark, out, spark.read.parquet(drop).schema)
    sent = sorted((r.username, (r.alert_ts - start).seconds // 60) for r in drop_folder.read_sent_alerts(spark, out).collect())
    assert sent == [("ann", 0), ("ann", 61), ("ann", 130), ("ann", 200), ("ann", 260), ("ann", 400), ("ann", 461), ("bob", 70)]
    assert drop_folder.read_late_alerts(spark, out).count() == 0


def test_alerts_behind_the_watermark_are_kept_apart(spark, tmp_path):
    start = datetime(2024, 1, 1)
    drop, out = str(tmp_path / "drop"), str(tmp_path / "out")
    for minute in (100, 50, 170):
        alert_table(spark, [("ann", start + timedelta(minutes=minute), "A")]).coalesce(1).write.mode("append").parquet(drop)
        stream = spark.readStream.schema(spark.read.parquet(drop).schema).parquet(drop)
        drop_folder.start_alert_dedup(stream, out, str(tmp_path / "cp")).awaitTermination()
    assert [r.alert_ts.minute for r in drop_folder.read_late_alerts(spark, out).collect()] == [50]
    assert drop_folder.read_sent_alerts(spark, out).count() == 2


def test_streamed_dedup_is_the_same_for_one_and_many_batches(spark, tmp_path):
    start = datetime(2024, 1, 1)
    rows = sorted(((f"u{k % 3}", start + timedelta(minutes=37 * k + k % 5), "AB"[k % 2]) for k in range(120)), key=lambda r: r[1])
    rows += [("u0", rows[-1][1] + timedelta(hours=5 * k), "A") for k in range(1, 11)]
    expected, last = [], {}
    for user, at, kind in rows:
        if (user, kind) not in last or at - last[user, kind] >= timedelta(hours=1):
            last[user, kind] = at
            expected.append((user, at, kind))
    alert_table(spark, rows).write.parquet(str(tmp_path / "one"))
    assert dedup_stream(spark, str(tmp_path / "one"), str(tmp_path / "o1"), str(tmp_path / "c1")) == sorted(expected, key=repr)
    for k in range(0, len(rows), 26):
        alert_table(spark, rows[k : k + 26]).write.mode("append").parquet(str(tmp_path / "many"))
        found = dedup_stream(spark, str(tmp_path / "many"), str(tmp_path / "o2"), str(tmp_path / "c2"))
    assert found == sorted(expected, key=repr)


def test_folder_trend_with_two_orders_of_columns(spark, write_csv, tmp_path):
    order = [3, 5, 1, 2, 0, 4]
    write_csv("drop/a.csv", HEADER, *SAMPLE[:5])
    write_csv("drop/b.csv", [HEADER[k] for k in order], *[[row[k] for k in order] for row in SAMPLE[5:]])
    drop, out, checkpoint = (str(tmp_path / name) for name in ("drop", "out", "cp"))
    for _ in range(2):
        drop_folder.start_folder_trends(spark, drop, out, checkpoint, max_files_per_trigger=1).awaitTermination()
        got = tuples(drop_folder.read_folder_trends(spark, out))
        assert got == tuples(metrics.error_trends(ingest(spark, drop)))


def test_folder_trend_counts_files_that_were_empty_at_first(spark, write_csv, tmp_path):
    drop, out, checkpoint = str(tmp_path / "drop"), str(tmp_path / "out"), str(tmp_path / "cp")

    def total():
        drop_folder.start_folder_trends(spark, drop, out, checkpoint).awaitTermination()
        return sum(r.error_count for r in drop_folder.read_folder_trends(spark, out).collect())

    write_csv("drop/a.csv", HEADER, SAMPLE[2])
    late = [tmp_path / "drop" / f"{name}.csv" for name in "xy"]
    for file in late:
        file.write_text("")
    assert total() == 1
    # The stream has seen the path; no new file arrives, then one does.
    late[0].write_text(Path(write_csv("spare/x.csv", HEADER, SAMPLE[3])).read_text())
    assert total() == 2 and total() == 2
    late[1].write_text(Path(write_csv("spare/y.csv", HEADER, SAMPLE[4], SAMPLE[7])).read_text())
    write_csv("drop/b.csv", HEADER, SAMPLE[2])
    assert total() == 5 and total() == 5


def test_stream_fails_on_another_header(spark, write_csv, tmp_path):
    write_csv("drop/a.csv", ["Level", "Content", "Date", "Time"], ["ERROR", "x", "2024-01-01", "00:00:01"])
    with pytest.raises(Exception, match="(?i)header"):
        stream_once(spark, tmp_path)


def test_batch_runs_append_their_own_lines(spark, write_csv, tmp_path):
    path, out = write_csv("logs/a.csv", HEADER, *SAMPLE), str(tmp_path / "out")
    per_run = []
    for _ in range(3):
        result = run_batch(spark, path, out)
        per_run.append((spark.read.parquet(result.alerts_path).count(), spark.read.text(f"{out}/alert_lines").count()))
    assert per_run[0][0] > 0 and per_run == [(k * per_run[0][0],) * 2 for k in (1, 2, 3)]


def test_alert_ids_are_stable(spark):
    one = alert_table(spark, [("ann", datetime(2024, 1, 1), "A")])
    assert one.first().alert_id == with_alert_id(one).first().alert_id


def test_main_help(capsys):
    from emberlog.plans.batch import main

    with pytest.raises(SystemExit):
        main(["--help"])
    assert "--out" in capsys.readouterr().out
