"""Rolling counts, rules, cooldown and the alert table, against brute force where it is not obvious."""

from __future__ import annotations

import random
from dataclasses import replace
from datetime import date, datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from emberlog.config import Thresholds
from emberlog.operators import alert_log, metrics, rolling, rules
from emberlog.sinks.alerts import alert_lines, append_alert_lines, append_alerts, read_alerts
from tests.conftest import tuples

START = datetime(2024, 1, 1)
LOGS = "timestamp timestamp, log_level string, message string"


def logs(spark, *groups):
    """Rows of (count, level, message), a day apart so that nothing bursts."""
    rows = [(START + timedelta(days=i), level, message) for n, level, message in groups for i in range(n)]
    return spark.createDataFrame(rows, LOGS)


def brute_force(points, window):
    out = {}
    for key, at in points:
        out[key, at] = sum(1 for k, other in points if k == key and at - window < other <= at)
    return out


@pytest.mark.parametrize("window_s, slices", [(3600, 3600), (3600, 60), (60, 400), (1, 1), (7, 1000)])
def test_rolling_count_against_brute_force(spark, window_s, slices):
    rng = random.Random(window_s * 7 + slices)
    base = datetime(1969, 12, 31, 23, 59)
    moments = [base + timedelta(seconds=rng.uniform(0, window_s * 4)) for _ in range(150)]
    # Pairs exactly one window and one microsecond less than a window apart, and repeats of one instant.
    moments += [m + timedelta(seconds=window_s) for m in moments[:40]]
    moments += [m + timedelta(seconds=window_s, microseconds=-1) for m in moments[:40]]
    moments += moments[:10]
    points = [(rng.choice("aab"), m) for m in moments]
    df = spark.createDataFrame([*points, (None, START), ("a", None)], "message string, timestamp timestamp")
    got = {(r.message, r.timestamp): r.rolling_count for r in rolling.rolling_count(df, window_s=window_s, slices=slices).collect()}
    assert got == brute_force(points, timedelta(seconds=window_s))


def test_rolling_count_is_that_of_pandas(spark):
    rng = random.Random(3)
    moments = sorted({START + timedelta(seconds=rng.uniform(0, 9000)) for _ in range(200)})
    frame = pd.DataFrame({"timestamp": moments, "message": "m"})
    expected = frame.assign(one=1).set_index("timestamp")["one"].rolling("1h").sum()
    got = rolling.rolling_count(spark.createDataFrame(frame)).orderBy("timestamp").collect()
    assert [r.rolling_count for r in got] == [int(n) for n in expected]


def test_rolling_count_rejects_uneven_slices(spark):
    with pytest.raises(ValueError, match="do not divide"):
        rolling.rolling_count(logs(spark, (1, "ERROR", "m")), window_s=1, slices=7)


def test_rows_keep_their_multiplicity(spark):
    df = spark.createDataFrame([("m", START, i) for i in range(5)], "message string, timestamp timestamp, i int")
    rows = tuples(rolling.with_rolling_count(df), "i", "rolling_count")
    assert sorted(rows) == [(i, 5) for i in range(5)]


def test_hot_key_is_spread_over_tasks(spark):
    """All rows have one key; the final window must still be split by slice, not sort the key in one task."""
    df = spark.range(20_000).select(
        F.lit("m").alias("message"), F.timestamp_millis(F.col("id") * 700).alias("timestamp")
    )
    counted = rolling.rolling_count(df)
    assert counted.agg(F.max("rolling_count")).first()[0] == 5143
    plan = counted._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [sum(delta" in line]
    assert len(windows) == 2 and all("part#" in line.split("], [")[1] for line in windows)
    assert all("unboundedpreceding" in line for line in windows)


def test_burst_threshold(spark):
    def burst(n, gap_s):
        rows = [(START + timedelta(seconds=gap_s * i), "ERROR", "m") for i in range(n)]
        return tuples(rules.burst_alert(spark.createDataFrame(rows, LOGS)), "alert_type", "message")

    assert burst(20, 1) == []
    assert burst(21, 1) == [("Error Burst", "Alert: Error Burst Detected - 'm' (21/hr)")]
    # 21 rows of which no window holds more than 20: the first is exactly an hour before the last.
    assert burst(21, 180) == []
    assert burst(21, 179) != []


def test_burst_reports_the_most_frequent_only(spark):
    rows = [(START + timedelta(seconds=i), "ERROR", "short") for i in range(30)]
    rows += [(START + timedelta(minutes=2 * i), "ERROR", "long") for i in range(40)]
    rows += [(START + timedelta(days=i), "ERROR", "rare") for i in range(99)]
    rows += [(START, "WARN", "warned")] * 50
    df = spark.createDataFrame(rows, LOGS)
    assert tuples(rules.burst_alert(df), "message") == [("Alert: Error Burst Detected - 'long' (30/hr)",)]
    found = rolling.bursts(df.filter("log_level = 'ERROR'"))
    assert {tuple(r) for r in found.collect()} == {("short", 30, 30), ("long", 30, 40)}


def types(alerts):
    return sorted(row.alert_type for row in alerts.collect())


def test_batch_limits(spark):
    # 10 % is not above 10 %.
    assert types(rules.batch_alerts(logs(spark, (1, "ERROR", "a"), (9, "INFO", "b")))) == []
    assert types(rules.batch_alerts(logs(spark, (2, "ERROR", "a"), (9, "INFO", "b")))) == ["HIGH_ERROR_RATE"]
    assert types(rules.batch_alerts(logs(spark, (4, "ERROR", "a"), (96, "INFO", "b")))) == []
    assert types(rules.batch_alerts(logs(spark, (5, "ERROR", "a"), (95, "INFO", "b")))) == ["CRITICAL_ERRORS"]
    assert types(rules.batch_alerts(logs(spark, (6, "ERROR", "a"), (94, "INFO", "b")))) == [
        "CRITICAL_ERRORS",
        "FREQUENT_ERRORS",
    ]
    many = [(1, "ERROR", f"m{i}") for i in range(101)]
    assert types(rules.batch_alerts(logs(spark, *many, (999, "INFO", "b")))) == [
        "CRITICAL_ERRORS",
        "HIGH_ERROR_COUNT",
    ]


def test_batch_texts(spark):
    alerts = rules.batch_alerts(logs(spark, (7, "ERROR", "disk 100%"), (10, "INFO", "b")))
    texts = {r.alert_type: (r.severity, r.message) for r in alerts.collect()}
    assert texts == {
        "HIGH_ERROR_RATE": ("CRITICAL", "Error rate 41.18% exceeds threshold 10.00%"),
        "CRITICAL_ERRORS": ("CRITICAL", "Found 7 critical errors (threshold: 5)"),
        "FREQUENT_ERRORS": (
            "CRITICAL",
            "Frequent Error: disk 100% (7 times)\n\nErrors occurring > 5 times:\n- disk 100%: 7\n",
        ),
    }


def test_severity_limit(spark):
    df = logs(spark, (9, "ERROR", "a")).withColumn("severity", F.lit(2))
    assert "CRITICAL_ERRORS" not in types(rules.batch_alerts(df))


def test_frequent_lists_ten_and_pattern_counts_all(spark):
    df = logs(spark, *[(6 + i, "ERROR", f"m{i:02}") for i in range(25)], (1, "ERROR", "once"))
    text = rules.frequent_alert(df).first().message
    assert text.startswith("Multiple Frequent Errors Detected (10 distinct types > 5 occ.)\n\n")
    assert text.count("\n- ") == 10 and "- m24: 30\n" in text and "m14" not in text
    alert = rules.frequent_pattern_alert(df, F.lit(False)).first()
    assert alert.message == "Multiple Frequent Errors Detected (25 types)"
    assert alert.metrics["patterns"] == "25"
    stamped = rules.stamp(rules.frequent_pattern_alert(df, F.lit(False)), START)
    details = sorted(tuples(rules.frequent_details(df, stamped), "rank", "message", "count"))
    assert details == [(k + 1, f"m{24 - k:02}", 30 - k) for k in range(25)]
    assert {r.alert_id for r in rules.frequent_details(df, stamped).collect()} == {stamped.first().alert_id}
    tied = logs(spark, (9, "ERROR", "a"), (9, "ERROR", "b"), (7, "ERROR", "c"))
    assert sorted(tuples(rules.frequent_details(tied, stamped), "rank", "message")) == [(1, "a"), (1, "b"), (3, "c")]
    assert alert.metrics == {"patterns": "25", "top_count": "30"}
    assert rules.frequent_messages(df).count() == 25


def test_interactive_rules(spark):
    df = logs(spark, (3, "ERROR", "a"), (3, "CRITICAL", "c"), (14, "INFO", "b"))
    alerts = {r.alert_type: r for r in rules.interactive_alerts(df).collect()}
    assert sorted(alerts) == ["High Critical Rate", "High Error Rate"]
    assert alerts["High Error Rate"].message == "High Error Rate Detected: 15.00%"
    assert alerts["High Error Rate"].details == "Total Logs: 20\nError Count: 3\nTop Errors:\n- a (3)"
    assert alerts["High Critical Rate"].message == "Critical Log Rate Exceeds 10%: 15.00%"
    # Exactly 10 % does not fire.
    assert types(rules.interactive_alerts(logs(spark, (2, "ERROR", "a"), (18, "INFO", "b")))) == []


def test_cooldown_gates_all_but_the_burst(spark):
    rows = [(START + timedelta(seconds=i), "ERROR", "m") for i in range(30)]
    df = spark.createDataFrame(rows, LOGS)
    every = ["Error Burst", "Frequent Error Pattern", "High Error Rate"]
    assert types(rules.interactive_alerts(df)) == every
    assert types(rules.interactive_alerts(df, in_cooldown=F.lit(True))) == ["Error Burst"]
    assert types(rules.interactive_alerts(df, in_cooldown=F.lit(True), force=True)) == every


def test_forced_check(spark):
    quiet = logs(spark, (9, "INFO", "b"))
    assert types(rules.interactive_alerts(quiet)) == []
    forced = rules.interactive_alerts(quiet, force=True)
    assert tuples(forced, "severity", "message") == [("Info", "Manual Alert History Check")]
    assert tuples(rules.interactive_alerts(quiet.limit(0), force=True)) == []


def alert_table(spark, rows):
    """Alerts of (user, moment, type)."""
    df = spark.createDataFrame(
        [(u, at, kind, f"{kind} message") for u, at, kind in rows],
        "username string, alert_ts timestamp, alert_type string, message string",
    )
    extra = {"severity": F.lit("CRITICAL"), "details": F.lit("d"), "metrics": F.create_map(F.lit("a"), F.lit("b"))}
    return rules.with_alert_id(df.withColumns(extra))


def test_cooldown_is_per_user_and_ends_on_time(spark):
    alerts = alert_table(spark, [("ann", START, "A"), ("bob", START - timedelta(hours=2), "A")])

    def cooling(user, after):
        column = alert_log.in_cooldown(alerts, user, START + after)
        return spark.range(1).select(column).first()[0]

    assert cooling("ann", timedelta(0))
    assert cooling("ann", timedelta(seconds=3599, microseconds=999999))
    assert not cooling("ann", timedelta(hours=1))
    assert not cooling("bob", timedelta(0))
    assert not cooling("eve", timedelta(0))


def test_replayed_cooldown(spark):
    offsets = [0, 100, 3600, 3700, 7300, 7300]
    rows = [("ann", START + timedelta(seconds=s), "A") for s in offsets] + [("bob", START + timedelta(seconds=200), "A")]
    out = alert_log.replay_cooldown(alert_table(spark, rows), tick_s=1)
    sent = sorted((r.username, (r.alert_ts - START).seconds, r.sent) for r in out.collect())
    assert sent == [
        ("ann", 0, True),
        ("ann", 100, False),
        ("ann", 3600, True),
        ("ann", 3700, False),
        ("ann", 7300, True),
        ("ann", 7300, True),
        ("bob", 200, True),
    ]


def test_replayed_cooldown_against_brute_force(spark):
    rng = random.Random(5)
    rows = [(rng.choice("ab"), START + timedelta(minutes=rng.randrange(2000)), "A") for _ in range(400)]
    expected = set()
    for user in "ab":
        last = None
        for at in sorted({at for u, at, _ in rows if u == user}):
            if last is None or at - last >= timedelta(hours=1):
                last = at
                expected.add((user, at))
    out = alert_log.replay_cooldown(alert_table(spark, rows))
    assert {(r.username, r.alert_ts) for r in out.filter("sent").collect()} == expected
    assert out.count() == 400


def test_replayed_cooldown_compares_seconds_and_takes_alerts_without_a_user(spark):
    seconds = [59, 3600, 3659, 3661]
    rows = [(user, START + timedelta(seconds=s), "A") for user in ("ann", None) for s in seconds]
    out = alert_log.replay_cooldown(alert_table(spark, rows))
    for user in ("ann", None):
        mine = sorted((int((r.alert_ts - START).total_seconds()), r.sent) for r in out.collect() if r.username == user)
        # The check of minute 60 is at 3600, not an hour after 59, and 3659 shares its fate.
        assert mine == [(59, True), (3600, False), (3659, False), (3661, True)]


def test_sendings_of_a_hot_user_are_those_of_the_fold(spark):
    rng = random.Random(8)
    hot = sorted(rng.sample(range(8_000), 1500))
    rows = [("ann", t) for t in hot] + [("bob", t) for t in (5, 14, 15, 24, 25, 26, 900, 909, 910)] + [("eve", 3)]
    times = spark.createDataFrame(rows, "key string, time bigint")
    last = spark.createDataFrame([("bob", 5), ("eve", 3), ("ann", -20), ("zoe", 1)], "key string, time bigint")

    def fold(own: list[int], before: int | None) -> list[int]:
        sent = []
        for t in own:
            if before is None or t - before >= 10:
                before = t
                sent.append(t)
        return sent

    def found(known):
        return sorted(tuples(alert_log.sending_times(times, 10, known), "key", "time"))

    ann = [("ann", t) for t in fold(hot, None)]
    assert found(None) == sorted([*ann, *(("bob", t) for t in (5, 15, 25, 900, 910)), ("eve", 3)])
    assert found(last) == sorted([*(("ann", t) for t in fold(hot, -20)), *(("bob", t) for t in (15, 25, 900, 910))])
    assert alert_log.sending_times(times.filter("false"), 10).count() == 0


def test_cooldown_gathers_nothing_by_user(spark):
    rows = [("ann", START + timedelta(minutes=3 * k), "A") for k in range(300)]
    plan = alert_log.replay_cooldown(alert_table(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "Python" not in plan and "Window" not in plan


def test_keys_tell_null_from_text(spark):
    rows = [(None, "a"), ("", "a"), ("-", "a"), ("1:x", "a"), ("1", ":xa"), ("a", None), ("a", "")]
    keys = spark.createDataFrame(rows, "u string, t string").select(alert_log.key_of("u", "t").alias("k"))
    assert keys.distinct().count() == len(rows)


def test_checks_remember_the_last_count(spark, tmp_path):
    base, df = str(tmp_path), logs(spark, (3, "ERROR", "a"))
    found = [rules.check_for_change(df, base, "ann", START + timedelta(hours=k)).first() for k in range(2)]
    assert [(r.total_logs, r.changed) for r in found] == [(3, True), (3, False)]
    assert rules.check_for_change(df, base, "bob", START).first().changed
    assert rules.check_for_change(df.limit(2), base, "ann", START + timedelta(hours=3)).first().changed


def test_alert_overview_lists_the_latest_ten(spark):
    rows = [("ann", START + timedelta(hours=k), "AB"[k % 2]) for k in range(14)]
    parts = tuples(alert_log.alert_overview(alert_table(spark, rows)), "part", "alert_type", "count")
    assert parts[0] == ("total", None, 14) and sorted(parts[1:3]) == [("type", "A", 7), ("type", "B", 7)]
    assert [p for p, *_ in parts].count("latest") == 10


def test_alert_ids_tell_null_from_empty(spark):
    rows = alert_table(spark, [("ann", START, "A")])
    ids = {
        rules.with_alert_id(rows.withColumn("username", F.lit(user).cast("string")).withColumn("details", F.lit(text))).first().alert_id
        for user in (None, "", "ann") for text in ("x", "y")
    }
    assert len(ids) == 6


def test_alert_queries(spark):
    rows = [("ann", START + timedelta(hours=i), "A" if i % 3 else "B") for i in range(60)] + [("bob", START, "A")]
    alerts = alert_table(spark, rows)
    day = alert_log.alert_history(alerts, "ann", date(2024, 1, 2), date(2024, 1, 2))
    assert [r.alert_ts.hour for r in day.collect()] == list(range(23, -1, -1))
    assert alert_log.alert_history(alerts, "ann", limit=5).count() == 5
    assert [r.alert_ts for r in alert_log.recent_alerts(alerts, 2).collect()] == [
        START + timedelta(hours=59),
        START + timedelta(hours=58),
    ]
    assert tuples(alert_log.alert_summary(alerts)) == [("A", 41, 61), ("B", 20, 61)]


def test_alerts_for_top_errors_is_literal(spark):
    errors = logs(spark, (9, "ERROR", "A mess.*"), (8, "ERROR", "B message"), *[(2, "ERROR", f"x{i}") for i in range(9)])
    alerts = alert_table(spark, [("ann", START, "A"), ("ann", START, "B")])
    assert tuples(alert_log.alerts_for_top_errors(alerts, errors), "alert_type") == [("B",)]
    assert alert_log.alerts_for_top_errors(alerts, errors.limit(0)).count() == 0


def test_alert_table(spark, tmp_path):
    path = str(tmp_path / "alerts")
    assert read_alerts(spark, path).count() == 0
    found = rules.batch_alerts(logs(spark, (7, "ERROR", "a")))
    for hour in (1, 2):
        append_alerts(rules.stamp(found, START + timedelta(hours=hour), "ann"), path)
    table = read_alerts(spark, path)
    assert table.count() == 6
    assert table.select("alert_id").distinct().count() == 6
    again = rules.stamp(found, START + timedelta(hours=1), "ann")
    assert again.join(table, "alert_id", "left_anti").count() == 0
    lines = [r.value for r in alert_lines(table.filter("alert_type = 'CRITICAL_ERRORS'")).collect()]
    assert "[2024-01-01 01:00:00] [CRITICAL] CRITICAL_ERRORS: Found 7 critical errors (threshold: 5)" in lines
    append_alert_lines(table, str(tmp_path / "lines"))
    assert spark.read.text(str(tmp_path / "lines")).count() > 6


def test_thresholds_can_be_changed(spark):
    limits = replace(Thresholds(), error_rate=0.5, critical_count=99, frequent_count=99)
    assert types(rules.batch_alerts(logs(spark, (5, "ERROR", "a"), (5, "INFO", "b")), limits)) == []


def test_changed_since_check(spark):
    df = logs(spark, (5, "ERROR", "a"))
    assert tuples(rules.changed_since_check(df)) == [(5, True)]
    assert tuples(rules.changed_since_check(df, 5)) == [(5, False)]


def test_totals_without_severity(spark):
    assert tuples(metrics.level_totals(logs(spark, (5, "ERROR", "a"))), "critical_errors") == [(5,)]
