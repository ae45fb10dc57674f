"""Alert rules and queries over the alert and history tables."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.registry import Inputs, register
from emberlog.config import Thresholds
from emberlog.operators import alert_log, filters, heavy, metrics, rolling, rules
from emberlog.sinks.alerts import alert_lines, append_alerts, read_alerts
from emberlog.sinks.reports import TIMESTAMP_FORMAT, export_csv

LIMITS = Thresholds()
# Thresholds that the test data can reach.
LOW = replace(LIMITS, critical_rate_pct=1, burst_count=2)
AT = datetime(2024, 2, 1)
SHOWN = ("alert_type", "severity", "message")

TOTALS_SQL = """totals AS (SELECT count(*) AS total, count(*) FILTER (log_level = 'ERROR') AS errs,
    count(*) FILTER (log_level = 'CRITICAL') AS crits, count(*) FILTER (log_level = 'ERROR' AND severity >= 3) AS severe
    FROM parsed)"""
RATE_SQL = """SELECT 'HIGH_ERROR_RATE' AS alert_type, 'CRITICAL' AS severity,
    printf('Error rate %.2f%% exceeds threshold 10.00%%', errs / total * 100) AS message
    FROM totals WHERE errs / total > 0.1"""
COUNT_SQL = """SELECT 'HIGH_ERROR_COUNT' AS alert_type, 'CRITICAL' AS severity,
    'Total error count ' || errs || ' exceeds threshold 100' AS message FROM totals WHERE errs > 100"""
SEVERE_SQL = """SELECT 'CRITICAL_ERRORS' AS alert_type, 'CRITICAL' AS severity,
    'Found ' || severe || ' critical errors (threshold: 5)' AS message FROM totals WHERE severe >= 5"""
FREQUENT_SQL = """SELECT 'FREQUENT_ERRORS' AS alert_type, 'CRITICAL' AS severity,
    CASE WHEN count(*) > 1 THEN 'Multiple Frequent Errors Detected (' || count(*) || ' distinct types > 5 occ.)'
         ELSE 'Frequent Error: ' || first(message) || ' (' || max(n) || ' times)' END
    || chr(10) || chr(10) || 'Errors occurring > 5 times:' || chr(10)
    || string_agg('- ' || message || ': ' || n, chr(10) ORDER BY n DESC, message) || chr(10) AS message
    FROM (SELECT message, n FROM message_counts WHERE n > 5 ORDER BY n DESC, message LIMIT 10) HAVING count(*) > 0"""
RATE_PCT_SQL = """SELECT 'High Error Rate' AS alert_type, 'Critical' AS severity,
    printf('High Error Rate Detected: %.2f%%', errs / total * 100) AS message
    FROM totals WHERE errs / total * 100 > 10"""
CRITICAL_PCT_SQL = """SELECT 'High Critical Rate' AS alert_type, 'Critical' AS severity,
    printf('Critical Log Rate Exceeds 1%%: %.2f%%', crits / total * 100) AS message
    FROM totals WHERE crits / total * 100 > 1"""
PATTERN_SQL = """SELECT 'Frequent Error Pattern' AS alert_type, 'Critical' AS severity,
    CASE WHEN count(*) > 1 THEN 'Multiple Frequent Errors Detected (' || count(*) || ' types)'
         ELSE 'Frequent Error Detected: ' || min(message) || ' (' || max(n) || ' times)' END AS message
    FROM message_counts WHERE n > 5 HAVING count(*) > 0"""
BURST_TABLES = """rolled AS (SELECT message, count(*) OVER (PARTITION BY message ORDER BY "timestamp"
    RANGE BETWEEN INTERVAL '3599.999999 seconds' PRECEDING AND CURRENT ROW) AS rolling_count FROM errors),
    burst AS (SELECT r.message, max(r.rolling_count) AS peak, max(c.n) AS n FROM rolled r
              JOIN message_counts c ON c.message = r.message GROUP BY r.message HAVING max(r.rolling_count) > 2)"""
BURST_SQL = """SELECT * FROM (SELECT 'Error Burst' AS alert_type, 'Critical' AS severity,
    'Alert: Error Burst Detected - ''' || message || ''' (' || peak || '/hr)' AS message
    FROM burst ORDER BY n DESC, burst.message LIMIT 1)"""


def shown(alerts: DataFrame) -> DataFrame:
    return alerts.select(*SHOWN)


def threshold_rule(t: Inputs, alert_type: str) -> DataFrame:
    fired = rules.threshold_alerts(metrics.level_totals(t.logs), LIMITS)
    return shown(fired.filter(F.col("alert_type") == alert_type))


ALERT_SQL = "username, alert_ts, alert_type, severity, message, details"
ALERT = ("username", "alert_ts", "alert_type", "severity", "message", "details")


@register("alert_error_rate", f"WITH {TOTALS_SQL} {RATE_SQL}")
def _(t: Inputs):
    return threshold_rule(t, "HIGH_ERROR_RATE")


@register("alert_error_count", f"WITH {TOTALS_SQL} {COUNT_SQL}")
def _(t: Inputs):
    return threshold_rule(t, "HIGH_ERROR_COUNT")


@register("alert_critical", f"WITH {TOTALS_SQL} {SEVERE_SQL}")
def _(t: Inputs):
    return threshold_rule(t, "CRITICAL_ERRORS")


@register("alert_frequent", FREQUENT_SQL)
def _(t: Inputs):
    return shown(rules.frequent_alert(t.logs, LIMITS))


@register(
    "alert_error_rate_pct",
    f"""WITH {TOTALS_SQL}, a AS ({RATE_PCT_SQL})
    SELECT a.*, 'Total Logs: ' || total || chr(10) || 'Error Count: ' || errs || chr(10) || 'Top Errors:' || chr(10)
      || (SELECT string_agg('- ' || message || ' (' || n || ')', chr(10) ORDER BY n DESC, message)
          FROM (SELECT message, n FROM message_counts ORDER BY n DESC, message LIMIT 20)) AS details
    FROM a, totals""",
)
def _(t: Inputs):
    top = rules.top_errors_text(t.logs, LOW.top_listed)
    fired = rules.rate_alerts(metrics.level_totals(t.logs), top, F.lit(False), LOW)
    return fired.filter("alert_type = 'High Error Rate'").select(*SHOWN, "details")


@register("alert_critical_rate", f"WITH {TOTALS_SQL} {CRITICAL_PCT_SQL}")
def _(t: Inputs):
    top = rules.top_errors_text(t.logs, LOW.top_listed)
    fired = rules.rate_alerts(metrics.level_totals(t.logs), top, F.lit(False), LOW)
    return shown(fired.filter("alert_type = 'High Critical Rate'"))


@register("frequent_messages", "SELECT message, n AS count FROM message_counts WHERE n > 5")
def _(t: Inputs):
    return rules.frequent_messages(t.logs)


@register("heavy_messages", "SELECT message, n AS count FROM message_counts WHERE n > 5")
def _(t: Inputs):
    return heavy.heavy_messages(t.logs)


@register(
    "alerts_with_frequent_messages",
    f"""WITH wanted AS (SELECT message FROM message_counts WHERE n > 5 AND trim(message) <> '')
        SELECT {ALERT_SQL} FROM alerts a WHERE EXISTS (
          SELECT 1 FROM wanted w WHERE contains(concat_ws(' ', coalesce(a.details, ''), coalesce(a.message, '')), w.message))""",
)
def _(t: Inputs):
    return heavy.alerts_with_messages(t.alerts, rules.frequent_messages(t.logs)).select(*ALERT)


@register(
    "alert_frequent_all",
    f"""WITH a AS ({PATTERN_SQL}), m AS (SELECT message AS error_message, n AS count,
          rank() OVER (ORDER BY n DESC) AS rank FROM message_counts WHERE n > 5)
        SELECT a.*, 'Errors occurring > 5 times' AS details, m.* FROM a, m""",
)
def _(t: Inputs):
    alerts = rules.stamp(rules.frequent_pattern_alert(t.logs, F.lit(False), LIMITS), AT)
    details = rules.frequent_details(t.logs, alerts, LIMITS).withColumnRenamed("message", "error_message")
    return alerts.join(details, "alert_id").select(*SHOWN, "details", "error_message", "count", "rank")


@register(
    "bursts",
    """WITH rolled AS (SELECT event_type, count(*) OVER (PARTITION BY event_type ORDER BY "timestamp"
         RANGE BETWEEN INTERVAL '3599.999999 seconds' PRECEDING AND CURRENT ROW) AS rolling_count FROM parsed)
       SELECT event_type, count(*) AS total, max(rolling_count) AS max_burst FROM rolled GROUP BY event_type
       HAVING max(rolling_count) > 5""",
)
def _(t: Inputs):
    return rolling.bursts(t.logs, "event_type", threshold=5)


@register("alert_burst", f"WITH {BURST_TABLES} {BURST_SQL}")
def _(t: Inputs):
    return shown(rules.burst_alert(t.logs, LOW))


@register(
    "alerts_all",
    f"WITH {TOTALS_SQL} {RATE_SQL} UNION ALL {COUNT_SQL} UNION ALL {SEVERE_SQL} UNION ALL SELECT * FROM ({FREQUENT_SQL})",
)
def _(t: Inputs):
    return shown(rules.batch_alerts(t.logs, LIMITS))


@register(
    "alerts_interactive",
    f"""WITH {TOTALS_SQL}, {BURST_TABLES} {RATE_PCT_SQL} UNION ALL {CRITICAL_PCT_SQL} UNION ALL {PATTERN_SQL}
        UNION ALL {BURST_SQL}""",
)
def _(t: Inputs):
    return shown(rules.interactive_alerts(t.logs, LOW))


@register(
    "alerts_interactive_cooldown",
    f"""WITH {TOTALS_SQL}, {BURST_TABLES},
    latest AS (SELECT max(alert_ts) AS seen FROM alerts WHERE username = 'user-3'),
    gated AS ({RATE_PCT_SQL} UNION ALL {CRITICAL_PCT_SQL} UNION ALL {PATTERN_SQL}),
    moments AS (SELECT 'within' AS moment, seen + INTERVAL 59 MINUTES AS asked FROM latest
                UNION ALL SELECT 'after', seen + INTERVAL 60 MINUTES FROM latest)
    SELECT moment, gated.* FROM gated, latest, moments WHERE asked - seen >= INTERVAL 1 HOUR
    UNION ALL SELECT moment, b.* FROM moments, ({BURST_SQL}) b""",
)
def _(t: Inputs):
    seen = t.alerts.filter("username = 'user-3'").agg(F.max("alert_ts").cast("timestamp_ntz")).first()[0]
    found = []
    for name, minutes in (("within", 59), ("after", 60)):
        cooling = alert_log.in_cooldown(t.alerts, "user-3", seen + timedelta(minutes=minutes))
        found.append(shown(rules.interactive_alerts(t.logs, LOW, cooling)).withColumn("moment", F.lit(name)))
    return found[0].unionByName(found[1])


@register(
    "alerts_forced_quiet",
    "SELECT 'Manual Check' AS alert_type, 'Info' AS severity, 'Manual Alert History Check' AS message "
    "WHERE EXISTS (SELECT 1 FROM parsed WHERE log_level <> 'ERROR')",
)
def _(t: Inputs):
    quiet = t.logs.filter(~filters.is_error())
    return shown(rules.interactive_alerts(quiet, LIMITS, force=True))


# Checks happen once a minute, at the time of the minute's first alert; times are compared in full.
REPLAY_SQL = """
WITH RECURSIVE checks AS (SELECT username, date_trunc('minute', alert_ts) AS tick, min(alert_ts) AS checked FROM alerts
                          GROUP BY username, date_trunc('minute', alert_ts)),
sending(username, checked) AS (
  SELECT username, min(checked) FROM checks GROUP BY username
  UNION ALL
  SELECT s.username, (SELECT min(c.checked) FROM checks c
                      WHERE c.username = s.username AND c.checked >= s.checked + INTERVAL 3600 SECONDS)
  FROM sending s WHERE s.checked IS NOT NULL)
SELECT a.username, a.alert_ts, a.details,
  EXISTS (SELECT 1 FROM sending s WHERE s.username = a.username
          AND date_trunc('minute', s.checked) = date_trunc('minute', a.alert_ts)) AS sent
FROM alerts a"""


@register("alert_cooldown", REPLAY_SQL)
def _(t: Inputs):
    return alert_log.replay_cooldown(t.alerts).select("username", "alert_ts", "details", "sent")


@register(
    "alert_history",
    f"""SELECT {ALERT_SQL} FROM alerts WHERE username = 'user-2' AND alert_ts >= '2024-01-05'
        AND alert_ts < '2024-01-21' ORDER BY alert_ts DESC LIMIT 100""",
)
def _(t: Inputs):
    days = (date(2024, 1, 5), date(2024, 1, 20))
    return alert_log.alert_history(t.alerts, "user-2", *days).select(*ALERT)


@register(
    "export_alert_history",
    f"""SELECT {ALERT_SQL}, '{{"event":"' || substr(details, 7) || '"}}' AS metrics FROM alerts
        WHERE username = 'user-1' ORDER BY alert_ts DESC LIMIT 100""",
)
def _(t: Inputs):
    path = f"{t.scratch()}/csv"
    export_csv(alert_log.alert_history(t.alerts, "user-1"), path)
    columns = "alert_id string, alert_ts timestamp, username string, alert_type string, severity string, message string"
    reader = t.spark.read.schema(f"{columns}, details string, metrics string").option("header", True)
    reader = reader.option("escape", '"').option("timestampFormat", TIMESTAMP_FORMAT)
    return reader.csv(path).select(*ALERT, "metrics")


@register("recent_alerts", f"SELECT {ALERT_SQL} FROM alerts ORDER BY alert_ts DESC LIMIT 20")
def _(t: Inputs):
    return alert_log.recent_alerts(t.alerts).select(*ALERT)


@register(
    "alert_summary",
    """SELECT 'total' AS part, NULL AS alert_type, count(*) AS count, CAST(NULL AS TIMESTAMP) AS alert_ts, NULL AS message FROM alerts
       UNION ALL SELECT 'type', alert_type, count(*), NULL, NULL FROM alerts GROUP BY alert_type
       UNION ALL SELECT * FROM (SELECT 'latest', alert_type, 1, alert_ts, message FROM alerts ORDER BY alert_ts DESC LIMIT 10)""",
)
def _(t: Inputs):
    return alert_log.alert_overview(t.alerts)


@register(
    "alerts_for_top_errors",
    f"""WITH top AS (SELECT message AS wanted FROM message_counts WHERE trim(message) <> '' ORDER BY n DESC, message LIMIT 5)
        SELECT {ALERT_SQL} FROM alerts
        WHERE EXISTS (SELECT 1 FROM top WHERE contains(details || ' ' || message, wanted))""",
)
def _(t: Inputs):
    return alert_log.alerts_for_top_errors(t.alerts, t.logs).select(*ALERT)


@register("alert_append", f"SELECT {ALERT_SQL} FROM alerts")
def _(t: Inputs):
    path = f"{t.scratch()}/alerts"
    half = F.col("alert_ts") < F.lit(datetime(2024, 1, 16))
    append_alerts(t.alerts.filter(half), path)
    append_alerts(t.alerts.filter(~half), path)
    return read_alerts(t.spark, path).select(*ALERT)


@register(
    "alert_lines",
    """SELECT '[' || strftime(alert_ts, '%Y-%m-%d %H:%M:%S') || '] [' || severity || '] ' || alert_type || ': '
       || message AS value FROM alerts""",
)
def _(t: Inputs):
    return alert_lines(t.alerts)


@register(
    "alert_ids",
    """SELECT details, sha256('=' || epoch_us(alert_ts) || '|=' || username || '|=' || alert_type || '|=' || message
              || '|=' || details) AS alert_id
       FROM alerts""",
)
def _(t: Inputs):
    return t.alerts.select("details", "alert_id")


@register(
    "history_list",
    """SELECT record_id, username, analysis_ts, file_name, num_errors, num_warnings, data_path FROM history
       WHERE username = 'svc-2' ORDER BY analysis_ts DESC LIMIT 50""",
)
def _(t: Inputs):
    return alert_log.history_list(t.history, "svc-2")


@register(
    "changed_since_check",
    """WITH n AS (SELECT count(*) AS every, count(*) FILTER (log_level = 'ERROR') AS errors FROM parsed)
       SELECT 1 AS step, errors AS total_logs, true AS changed FROM n
       UNION ALL SELECT 2, errors, false FROM n UNION ALL SELECT 3, every, every <> errors FROM n""",
)
def _(t: Inputs):
    base = t.scratch()
    steps = [t.logs.filter(filters.is_error()), t.logs.filter(filters.is_error()), t.logs]
    found = [
        rules.check_for_change(df, base, "user-1", AT + timedelta(hours=k)).withColumn("step", F.lit(k + 1))
        for k, df in enumerate(steps)
    ]
    return found[0].unionByName(found[1]).unionByName(found[2])
