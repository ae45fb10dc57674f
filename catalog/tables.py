"""Log, alert and history tables derived from ``events``: once as DataFrames, once as SQL, kept next to each other."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.operators.rules import with_alert_id


def fresh_name() -> str:
    return f"run-{uuid.uuid4().hex}"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def logs(rows: DataFrame) -> DataFrame:
    """One log row per event."""
    user, event = F.col("user_id"), F.col("event_id")
    number = F.regexp_extract("props", "([0-9]+)", 1)
    ip = F.concat(F.lit("10.0."), (user % 4).cast("string"), F.lit("."), (user % 250).cast("string"))
    level = (
        F.when(F.col("event_type") == "error", "ERROR")
        .when(F.col("event_type") == "purchase", "WARN")
        .when(F.col("event_type") == "signup", "DEBUG")
        .when((F.col("event_type") == "view") & (event % 10 == 0), "CRITICAL")
        .otherwise("INFO")
    )
    service = F.concat(F.lit("svc-"), (user % 6).cast("string"))
    kind = event % 9
    message = (
        F.when(kind == 0, F.concat(F.lit("Connection refused to service: "), service, F.lit(" at "), ip))
        .when(kind == 1, F.concat(F.lit("java.net.SocketTimeoutException: read "), number))
        .when(kind == 2, F.concat(F.lit("request timeout after "), number, F.lit("s")))
        .when(kind == 3, F.lit("user unauthorized for GET /v1/users"))
        .when(kind == 4, F.lit("page not found"))
        .when(kind == 5, F.lit("permission denied 403"))
        .when(kind == 6, F.concat(F.lit("job failed with code "), number))
        .when(kind == 7, F.lit("cache refreshed"))
        .otherwise(F.lit("   "))
    )
    return rows.select(
        "event_id",
        "event_type",
        F.col("ts").cast("timestamp").alias("timestamp"),
        level.alias("log_level"),
        ip.alias("ip_address"),
        service.alias("service_name"),
        message.alias("message"),
    )


def raw_logs(rows: DataFrame) -> DataFrame:
    """Log rows as they might arrive: some without timestamp or level, levels in odd spellings."""
    event = F.col("event_id")
    spelled = (
        F.when(event % 89 == 0, F.lit(None))
        .when(F.col("log_level") == "WARN", F.when(event % 2 == 0, " Warning ").otherwise("warn"))
        .when(F.col("event_type") == "click", F.lit("combo"))
        .otherwise(F.lower("log_level"))
    )
    known = F.when(event % 97 != 0, F.col("timestamp"))
    return rows.withColumns({"timestamp": known, "log_level": spelled})


def alerts(rows: DataFrame) -> DataFrame:
    """One alert per error row."""
    kind = F.col("event_id") % 4
    alert_type = (
        F.when(kind == 0, "HIGH_ERROR_RATE")
        .when(kind == 1, "HIGH_ERROR_COUNT")
        .when(kind == 2, "CRITICAL_ERRORS")
        .otherwise("FREQUENT_ERRORS")
    )
    return with_alert_id(
        rows.filter(F.col("log_level") == "ERROR").select(
            F.col("timestamp").alias("alert_ts"),
            F.concat(F.lit("user-"), F.substring("service_name", 5, 1)).alias("username"),
            alert_type.alias("alert_type"),
            F.lit("CRITICAL").alias("severity"),
            F.concat(F.lit("Alert on: "), "message").alias("message"),
            F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("details"),
            F.create_map(F.lit("event"), F.col("event_id").cast("string")).alias("metrics"),
        )
    )


def history(rows: DataFrame) -> DataFrame:
    """One analysis per service and day."""
    return (
        rows.withColumn("day", F.to_date("timestamp").cast("string"))
        .groupBy("service_name", "day")
        .agg(
            F.max("timestamp").alias("analysis_ts"),
            F.count_if(F.col("log_level") == "ERROR").alias("num_errors"),
            F.count_if(F.col("log_level") == "WARN").alias("num_warnings"),
        )
        .select(
            F.concat_ws("/", "service_name", "day").alias("record_id"),
            F.col("service_name").alias("username"),
            "analysis_ts",
            F.concat(F.lit("events-"), "day", F.lit(".csv")).alias("file_name"),
            "num_errors",
            "num_warnings",
            F.concat_ws("/", F.lit("snapshots"), "service_name", "day").alias("data_path"),
        )
    )


# The same tables in SQL.
SQL = r"""
logs AS (
  SELECT event_id, event_type, ts AS "timestamp",
    CASE WHEN event_type = 'error' THEN 'ERROR' WHEN event_type = 'purchase' THEN 'WARN'
         WHEN event_type = 'signup' THEN 'DEBUG' WHEN event_type = 'view' AND event_id % 10 = 0 THEN 'CRITICAL'
         ELSE 'INFO' END AS log_level,
    '10.0.' || (user_id % 4) || '.' || (user_id % 250) AS ip_address,
    'svc-' || (user_id % 6) AS service_name,
    CASE event_id % 9
      WHEN 0 THEN 'Connection refused to service: svc-' || (user_id % 6) || ' at 10.0.' || (user_id % 4) || '.'
                  || (user_id % 250)
      WHEN 1 THEN 'java.net.SocketTimeoutException: read ' || regexp_extract(props, '([0-9]+)', 1)
      WHEN 2 THEN 'request timeout after ' || regexp_extract(props, '([0-9]+)', 1) || 's'
      WHEN 3 THEN 'user unauthorized for GET /v1/users'
      WHEN 4 THEN 'page not found'
      WHEN 5 THEN 'permission denied 403'
      WHEN 6 THEN 'job failed with code ' || regexp_extract(props, '([0-9]+)', 1)
      WHEN 7 THEN 'cache refreshed'
      ELSE '   ' END AS message
  FROM events),
raw AS (
  SELECT event_id, event_type, CASE WHEN event_id % 97 <> 0 THEN "timestamp" END AS "timestamp",
    CASE WHEN event_id % 89 = 0 THEN NULL
         WHEN log_level = 'WARN' THEN CASE WHEN event_id % 2 = 0 THEN ' Warning ' ELSE 'warn' END
         WHEN event_type = 'click' THEN 'combo' ELSE lower(log_level) END AS log_level,
    ip_address, service_name, message
  FROM logs),
parsed AS (
  SELECT event_id, event_type, "timestamp", log_level,
    CASE log_level WHEN 'ERROR' THEN 3 WHEN 'WARN' THEN 2 WHEN 'INFO' THEN 1 WHEN 'DEBUG' THEN 0 ELSE 1 END AS severity,
    trim(message) AS message,
    CASE WHEN regexp_matches(message, '(?i)(exception|error|failed|failure)')
           THEN regexp_extract(message, '(?i)(\w+Exception|\w+Error|\w+Failure)', 1)
         WHEN regexp_matches(message, '(?i)(timeout|time out)') THEN 'TimeoutError'
         WHEN regexp_matches(message, '(?i)(connection|connect)') THEN 'ConnectionError'
         WHEN regexp_matches(message, '(?i)(authentication|auth|unauthorized)') THEN 'AuthenticationError'
         WHEN regexp_matches(message, '(?i)(not found|404)') THEN 'NotFoundError'
         WHEN regexp_matches(message, '(?i)(permission|forbidden|403)') THEN 'PermissionError'
         ELSE 'UnknownError' END AS error_type,
    ip_address, service_name,
    regexp_extract(message, '(GET|POST|PUT|DELETE|PATCH)\s+([/\w-]+)', 2) AS endpoint_path
  FROM logs),
errors AS (SELECT * FROM parsed WHERE log_level = 'ERROR'),
message_counts AS (SELECT message, count(*) AS n FROM errors GROUP BY message),
alerts AS (
  SELECT "timestamp" AS alert_ts, 'user-' || substr(service_name, 5, 1) AS username,
    CASE event_id % 4 WHEN 0 THEN 'HIGH_ERROR_RATE' WHEN 1 THEN 'HIGH_ERROR_COUNT' WHEN 2 THEN 'CRITICAL_ERRORS'
         ELSE 'FREQUENT_ERRORS' END AS alert_type,
    'CRITICAL' AS severity, 'Alert on: ' || message AS message, 'event ' || event_id AS details
  FROM logs WHERE log_level = 'ERROR'),
history AS (
  SELECT service_name || '/' || CAST("timestamp" AS DATE) AS record_id, service_name AS username,
    max("timestamp") AS analysis_ts, 'events-' || CAST("timestamp" AS DATE) || '.csv' AS file_name,
    count(*) FILTER (log_level = 'ERROR') AS num_errors, count(*) FILTER (log_level = 'WARN') AS num_warnings,
    'snapshots/' || service_name || '/' || CAST("timestamp" AS DATE) AS data_path
  FROM logs GROUP BY service_name, CAST("timestamp" AS DATE))
"""


def with_tables(sql: str) -> str:
    """A query with the common tables in front; further common tables may come as a leading ``WITH``."""
    sql = sql.strip()
    if sql.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {SQL.strip()},\n{sql[len('WITH RECURSIVE '):]}"
    if sql.upper().startswith("WITH "):
        return f"WITH {SQL.strip()},\n{sql[len('WITH '):]}"
    return f"WITH {SQL.strip()}\n{sql}"
