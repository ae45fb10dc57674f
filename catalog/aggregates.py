"""Counts, rates, breakdowns, trends, top-k and rolling windows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.registry import Inputs, register
from emberlog.operators import metrics, ranking, rolling


@register("total_logs", "SELECT count(*) AS total_logs FROM parsed")
def _(t: Inputs):
    return metrics.total_logs(t.logs)


@register("error_count", "SELECT count(*) AS total_errors FROM errors")
def _(t: Inputs):
    return metrics.error_count(t.logs)


@register(
    "error_rate",
    "SELECT round(count(*) FILTER (log_level = 'ERROR') / count(*), 6) AS error_rate FROM parsed",
)
def _(t: Inputs):
    return metrics.error_rate(t.logs).select(F.round("error_rate", 6).alias("error_rate"))


@register("errors_by_type", "SELECT error_type, count(*) AS count FROM errors GROUP BY error_type")
def _(t: Inputs):
    return metrics.errors_by_type(t.logs)


@register(
    "errors_by_severity",
    "SELECT severity, log_level, count(*) AS count FROM errors GROUP BY severity, log_level",
)
def _(t: Inputs):
    return metrics.errors_by_severity(t.logs)


@register(
    "errors_by_hour",
    """SELECT CAST("timestamp" AS DATE) AS date, CAST(hour("timestamp") AS INTEGER) AS hour, count(*) AS error_count
       FROM errors GROUP BY 1, 2""",
)
def _(t: Inputs):
    return metrics.errors_by_hour(t.logs)


@register(
    "errors_by_day",
    'SELECT CAST("timestamp" AS DATE) AS date, count(*) AS error_count FROM errors GROUP BY 1',
)
def _(t: Inputs):
    return metrics.errors_by_day(t.logs)


@register(
    "error_trends",
    """SELECT date_trunc('hour', "timestamp") AS time_window, count(*) AS error_count FROM errors GROUP BY 1""",
)
def _(t: Inputs):
    return metrics.error_trends(t.logs)


@register(
    "error_trends_5m",
    """SELECT time_bucket(INTERVAL 5 MINUTE, "timestamp") AS time_window, count(*) AS error_count
       FROM errors GROUP BY 1""",
)
def _(t: Inputs):
    return metrics.error_trends(t.logs, "5m")


@register(
    "error_trends_half_hour_offset",
    """SELECT date_trunc('hour', "timestamp" - INTERVAL 30 MINUTE) + INTERVAL 30 MINUTE AS time_window,
       count(*) AS error_count FROM errors GROUP BY 1""",
)
def _(t: Inputs):
    return metrics.error_trends(t.logs, "1h", offset="30 minutes")


@register(
    "errors_per_ip",
    "SELECT ip_address, count(*) AS error_count FROM errors WHERE ip_address <> '' GROUP BY ip_address",
)
def _(t: Inputs):
    return metrics.errors_per_ip(t.logs)


@register(
    "errors_per_service",
    "SELECT service_name, count(*) AS error_count FROM errors WHERE service_name <> '' GROUP BY service_name",
)
def _(t: Inputs):
    return metrics.errors_per_service(t.logs)


@register("level_counts", "SELECT log_level, count(*) AS count FROM parsed GROUP BY log_level")
def _(t: Inputs):
    return metrics.level_counts(t.logs)


DISTINCTS = """count(DISTINCT nullif(ip_address, '')) AS unique_ips,
       count(DISTINCT nullif(service_name, '')) AS unique_services,
       count(DISTINCT CASE WHEN log_level = 'ERROR' THEN error_type END) AS unique_error_types"""


@register("distinct_counts", f"SELECT {DISTINCTS} FROM parsed")
def _(t: Inputs):
    return metrics.distinct_counts(t.logs)


# The record's numbers and every level, as rows of (item, value).
SUMMARY_SQL = f"""
WITH r AS (SELECT count(*) AS total_logs, count(*) FILTER (log_level = 'ERROR') AS total_errors,
                  round(count(*) FILTER (log_level = 'ERROR') / count(*), 6) AS error_rate, {DISTINCTS} FROM parsed)
SELECT item, CAST(value AS DOUBLE) AS value FROM (
  SELECT 'total_logs' AS item, total_logs AS value FROM r UNION ALL SELECT 'total_errors', total_errors FROM r
  UNION ALL SELECT 'error_rate', error_rate FROM r UNION ALL SELECT 'unique_ips', unique_ips FROM r
  UNION ALL SELECT 'unique_services', unique_services FROM r
  UNION ALL SELECT 'unique_error_types', unique_error_types FROM r
  UNION ALL SELECT 'level ' || log_level, count(*) FROM parsed GROUP BY log_level)"""


def summary_items(record: DataFrame, levels: DataFrame) -> DataFrame:
    """The summary record and the level counts in the long form of ``SUMMARY_SQL``."""
    pairs = [F.struct(F.lit(name).alias("item"), F.round(F.col(name).cast("double"), 6).alias("value")) for name in record.columns]
    named = levels.select(F.concat(F.lit("level "), "log_level").alias("item"), F.col("count").cast("double").alias("value"))
    return record.select(F.inline(F.array(*pairs))).unionByName(named)


@register("summary_stats", SUMMARY_SQL)
def _(t: Inputs):
    return summary_items(metrics.summary(t.logs), metrics.level_counts(t.logs))


@register(
    "kpis",
    """SELECT count(*) AS total_logs, count(*) FILTER (log_level = 'ERROR') AS total_errors,
       count(*) FILTER (log_level = 'WARN') AS total_warnings,
       round(count(*) FILTER (log_level = 'ERROR') / count(*) * 100, 6) AS error_rate_pct FROM parsed""",
)
def _(t: Inputs):
    return metrics.kpis(t.logs).withColumn("error_rate_pct", F.round("error_rate_pct", 6))


@register(
    "level_split",
    """SELECT CASE WHEN log_level IN ('WARN', 'ERROR') THEN log_level ELSE 'INFO' END AS level, count(*) AS count
       FROM parsed GROUP BY 1""",
)
def _(t: Inputs):
    return metrics.level_split(t.logs)


# The SQL form of every trend bucket.
BUCKETS = {
    "minute": """date_trunc('minute', "timestamp")""",
    "hour": """date_trunc('hour', "timestamp")""",
    "day": """date_trunc('day', "timestamp")""",
    "week": """CAST(date_trunc('week', "timestamp") + INTERVAL 6 DAY AS TIMESTAMP)""",
    "month": """CAST(last_day("timestamp") AS TIMESTAMP)""",
}


def _trend(granularity: str):
    return lambda t: metrics.trend(t.logs, granularity)


for _granularity, _bucket in BUCKETS.items():
    register(
        f"trend_{_granularity}",
        f"""SELECT CAST({_bucket} AS TIMESTAMP) AS bucket, log_level, count(*) AS count FROM parsed
            WHERE log_level IN ('ERROR', 'WARN') GROUP BY 1, 2""",
    )(_trend(_granularity))


@register(
    "auto_granularity",
    """WITH s AS (SELECT CAST(floor((epoch(max("timestamp")) - epoch(min("timestamp"))) / 86400) AS BIGINT) AS d
                  FROM parsed)
       SELECT d AS span_days, CASE WHEN d > 30 THEN 'day' ELSE 'hour' END AS granularity FROM s""",
)
def _(t: Inputs):
    return metrics.auto_granularity(t.logs)


PEAK_SQL = """
WITH h AS (SELECT date_trunc('hour', "timestamp") AS peak_hour, count(*) AS error_count FROM errors GROUP BY 1)
SELECT CAST(peak_hour AS TIMESTAMP) AS peak_hour, error_count,
       strftime(peak_hour, '%Y-%m-%d %H:00') || ' - ' || strftime(peak_hour + INTERVAL 1 HOUR, '%H:00') AS hour_range
FROM h ORDER BY error_count DESC, peak_hour LIMIT 1"""


@register("peak_error_hour", PEAK_SQL)
def _(t: Inputs):
    return metrics.peak_error_hour(t.logs)


@register(
    "most_frequent_error",
    "SELECT message, n AS count FROM message_counts ORDER BY n DESC, message LIMIT 1",
)
def _(t: Inputs):
    return ranking.most_frequent_error(t.logs)


PERIODS = (
    (datetime(2024, 1, 8), datetime(2024, 1, 15)),
    (datetime(2024, 1, 1), datetime(2024, 1, 8)),
)


def _period(test: str, name: str) -> str:
    return f"""SELECT '{name}' AS metric,
      CAST(count(*) FILTER ({test} AND "timestamp" >= '2024-01-08' AND "timestamp" < '2024-01-15') AS DOUBLE) AS current,
      CAST(count(*) FILTER ({test} AND "timestamp" >= '2024-01-01' AND "timestamp" < '2024-01-08') AS DOUBLE) AS previous
      FROM parsed"""


@register(
    "kpi_trend",
    f"""WITH t AS ({_period("true", "total_logs")}), e AS ({_period("log_level = 'ERROR'", "total_errors")}),
    w AS ({_period("log_level = 'WARN'", "total_warnings")}),
    m AS (SELECT * FROM t UNION ALL SELECT * FROM e UNION ALL SELECT * FROM w UNION ALL
          SELECT 'error_rate_pct', e.current / t.current * 100, e.previous / t.previous * 100 FROM e, t)
    SELECT metric, round(current, 6) AS current, round(previous, 6) AS previous,
           round(current - previous, 6) AS diff, round((current - previous) * 100 / previous, 6) AS pct_change,
           CASE WHEN current > previous THEN 'up' WHEN current < previous THEN 'down' ELSE 'flat' END AS direction
    FROM m""",
)
def _(t: Inputs):
    change = metrics.period_change(t.logs, *PERIODS)
    return change.withColumns({n: F.round(n, 6) for n in ("current", "previous", "diff", "pct_change")})


@register(
    "error_first_last_seen",
    """SELECT message, min("timestamp") AS first_seen, max("timestamp") AS last_seen, count(*) AS count
       FROM errors GROUP BY message""",
)
def _(t: Inputs):
    return metrics.first_last_seen(t.logs)


@register(
    "level_values",
    "SELECT DISTINCT log_level FROM parsed UNION SELECT unnest(['INFO', 'WARN', 'ERROR', 'DEBUG']) AS log_level",
)
def _(t: Inputs):
    return metrics.level_values(t.logs)


@register("service_values", "SELECT DISTINCT service_name FROM parsed")
def _(t: Inputs):
    return metrics.service_values(t.logs)


@register(
    "time_bounds",
    """SELECT min("timestamp") AS first_ts, max("timestamp") AS last_ts,
       CAST(CAST(max("timestamp") AS DATE) - INTERVAL 7 DAY AS DATE) AS default_start,
       CAST(max("timestamp") AS DATE) AS default_end FROM parsed""",
)
def _(t: Inputs):
    return metrics.time_bounds(t.logs)


@register(
    "top_n_errors",
    """SELECT error_type, message, count(*) AS count FROM errors GROUP BY 1, 2
       ORDER BY count DESC, error_type, message LIMIT 10""",
)
def _(t: Inputs):
    return ranking.top_n_errors(t.logs, 10)


def _top(n: int) -> str:
    return f"SELECT message, n AS count FROM message_counts ORDER BY n DESC, message LIMIT {n}"


@register("top5_messages", _top(5))
def _(t: Inputs):
    return ranking.top_messages(t.logs, 5)


@register("top20_messages", _top(20))
def _(t: Inputs):
    return ranking.top_messages(t.logs, 20)


@register(
    "top_errors_relative",
    f"""WITH top AS ({_top(5)})
        SELECT message, count, round(count * 100 / (SELECT max(count) FROM top), 6) AS pct_of_top FROM top""",
)
def _(t: Inputs):
    return ranking.top_errors_relative(t.logs, 5).withColumn("pct_of_top", F.round("pct_of_top", 6))


@register(
    "latest_logs",
    """SELECT event_id, "timestamp", log_level, message FROM parsed
       ORDER BY "timestamp" DESC, event_id LIMIT 100""",
)
def _(t: Inputs):
    return ranking.latest_logs(t.logs, 100, "event_id").select("event_id", "timestamp", "log_level", "message")


ROLLING = """count(*) OVER (PARTITION BY {key} ORDER BY "timestamp"
             RANGE BETWEEN INTERVAL '3599.999999 seconds' PRECEDING AND CURRENT ROW)"""


@register(
    "rolling_hour_count",
    f"""SELECT event_id, event_type, "timestamp", {ROLLING.format(key="event_type")} AS rolling_count FROM parsed""",
)
def _(t: Inputs):
    rows = t.logs.select("event_id", "event_type", "timestamp")
    return rolling.with_rolling_count(rows, "event_type")


@register(
    "rolling_points",
    f"""WITH r AS (SELECT message, "timestamp", {ROLLING.format(key="message")} AS rolling_count FROM errors)
        SELECT message, "timestamp", count(*) AS row_count, max(rolling_count) AS rolling_count
        FROM r GROUP BY 1, 2""",
)
def _(t: Inputs):
    return rolling.rolling_count(t.logs.filter("log_level = 'ERROR'"), "message")
