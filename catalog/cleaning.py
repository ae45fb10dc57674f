"""Cleaning steps and column derivation."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from catalog.registry import Inputs, register
from emberlog.config import BATCH, INTERACTIVE
from emberlog.operators import clean
from emberlog.plans.parse import parse_logs, parse_logs_interactive


@register(
    "columns_lowercase",
    'SELECT event_id AS lineid, "timestamp" AS time, log_level AS level FROM logs',
)
def _(t: Inputs):
    mixed = t.messages.select(
        F.col("event_id").alias("LineId"), F.col("timestamp").alias("Time"), F.col("log_level").alias("Level")
    )
    return clean.lower_columns(mixed)


@register("columns_dedup", "SELECT event_id, ip_address AS ip FROM logs")
def _(t: Inputs):
    doubled = t.logs.select("event_id", F.col("ip_address").alias("IP"), F.col("service_name").alias("ip"))
    return clean.drop_duplicate_columns(doubled)


@register(
    "columns_alias",
    "SELECT event_id, log_level, message, event_type AS error_type FROM logs",
)
def _(t: Inputs):
    named = t.messages.select(
        "event_id",
        F.col("log_level").alias("level"),
        F.col("message").alias("content"),
        F.col("event_type").alias("eventtemplate"),
    )
    return clean.rename_aliases(named)


@register(
    "clean_null_rows",
    """SELECT event_id, "timestamp", message FROM raw WHERE "timestamp" IS NOT NULL OR trim(message) <> ''""",
)
def _(t: Inputs):
    return clean.clean_null_rows(t.raw).select("event_id", "timestamp", "message")


# Per shape of timestamp text: how to print it, and how far it resolves.
SHAPES = (
    ("yyyy-MM-dd HH:mm:ss", "second"),
    ("yyyy-MM-dd HH:mm:ss.SSS", "millisecond"),
    ("yyyy-MM-dd'T'HH:mm:ss", "second"),
    ("yyyy-MM-dd", "day"),
    ("yy/MM/dd HH:mm:ss", "second"),
    ("MMM d HH:mm:ss", "second"),
    ("MMM  d HH:mm:ss", "second"),
)


@register(
    "normalize_timestamp",
    """SELECT event_id, CASE event_id % 8 WHEN 1 THEN date_trunc('millisecond', "timestamp")
         WHEN 3 THEN CAST(date_trunc('day', "timestamp") AS TIMESTAMP) WHEN 7 THEN NULL
         ELSE date_trunc('second', "timestamp") END AS "timestamp" FROM logs""",
)
def _(t: Inputs):
    shape = F.col("event_id") % 8
    text = F.when(shape == 7, F.lit("yesterday"))
    for i, (pattern, _unit) in enumerate(SHAPES):
        text = text.when(shape == i, F.date_format("timestamp", pattern))
    raw = t.messages.withColumn("timestamp", text)
    return clean.normalize_timestamps(raw, default_year=2024).select("event_id", "timestamp")


@register(
    "time_parts",
    """SELECT event_id, CAST(hour("timestamp") AS INTEGER) AS hour, CAST(day("timestamp") AS INTEGER) AS day,
       CAST(month("timestamp") AS INTEGER) AS month, CAST(year("timestamp") AS INTEGER) AS year,
       CAST("timestamp" AS DATE) AS date FROM raw""",
)
def _(t: Inputs):
    return clean.add_time_parts(t.raw).select("event_id", "hour", "day", "month", "year", "date")


@register("drop_null_ts", 'SELECT event_id, "timestamp" FROM raw WHERE "timestamp" IS NOT NULL')
def _(t: Inputs):
    return clean.drop_null_timestamps(t.raw).select("event_id", "timestamp")


@register(
    "standardize_level",
    "SELECT event_id, coalesce(trim(upper(log_level)), 'INFO') AS log_level FROM raw",
)
def _(t: Inputs):
    return clean.standardize_levels(t.raw).select("event_id", "log_level")


INTERACTIVE_LEVEL = """CASE coalesce(trim(upper(log_level)), 'UNKNOWN') WHEN 'WARNING' THEN 'WARN' WHEN 'COMBO' THEN 'INFO'
       ELSE coalesce(trim(upper(log_level)), 'UNKNOWN') END"""


@register("level_alias", f"SELECT event_id, {INTERACTIVE_LEVEL} AS log_level FROM raw")
def _(t: Inputs):
    levels = clean.standardize_levels(t.raw, INTERACTIVE.default_level, INTERACTIVE.level_aliases)
    return levels.select("event_id", "log_level")


@register("severity", "SELECT event_id, log_level, severity FROM parsed")
def _(t: Inputs):
    return clean.add_severity(t.messages).select("event_id", "log_level", "severity")


@register(
    "severity_custom",
    "SELECT event_id, CASE log_level WHEN 'CRITICAL' THEN 4 ELSE severity END AS severity FROM parsed",
)
def _(t: Inputs):
    profile = replace(BATCH, severity_map={**BATCH.severity_map, "CRITICAL": 4})
    return parse_logs(t.messages, profile).select("event_id", "severity")


@register("extract_error_type", "SELECT event_id, error_type FROM parsed")
def _(t: Inputs):
    return clean.add_error_type(t.messages).select("event_id", "error_type")


@register(
    "extract_error_type_given",
    """SELECT event_id, CASE WHEN event_type = 'click' THEN error_type ELSE event_type END AS error_type
       FROM parsed""",
)
def _(t: Inputs):
    given = F.when(F.col("event_type") == "click", F.lit("  ")).otherwise(F.col("event_type"))
    return clean.add_error_type(t.messages.withColumn("error_type", given)).select("event_id", "error_type")


@register(
    "extract_ip",
    r"SELECT event_id, regexp_extract(message, '\b(?:\d{1,3}\.){3}\d{1,3}\b', 0) AS ip_address FROM logs",
)
def _(t: Inputs):
    return clean.add_entities(t.messages).select("event_id", "ip_address")


@register(
    "extract_service",
    r"""SELECT event_id, regexp_extract(message, '(?i)(service|api|endpoint)[:\s]+([\w/-]+)', 2) AS service_name
        FROM logs""",
)
def _(t: Inputs):
    return clean.add_entities(t.messages).select("event_id", "service_name")


@register("extract_endpoint", "SELECT event_id, endpoint_path FROM parsed")
def _(t: Inputs):
    return clean.add_entities(t.messages).select("event_id", "endpoint_path")


@register("message_trim", "SELECT event_id, trim(message) AS message FROM logs")
def _(t: Inputs):
    return clean.trim_message(t.messages).select("event_id", "message")


CANONICAL = ("event_id", "timestamp", "log_level", "severity", "message", "error_type", "ip_address", "service_name",
             "endpoint_path", "hour", "day", "month", "year", "date")


@register(
    "parse_logs",
    """SELECT r.event_id, r."timestamp", l.level AS log_level,
         CASE l.level WHEN 'ERROR' THEN 3 WHEN 'WARN' THEN 2 WHEN 'INFO' THEN 1 WHEN 'DEBUG' THEN 0 ELSE 1 END AS severity,
         p.message, p.error_type, p.ip_address, p.service_name, p.endpoint_path,
         CAST(hour(r."timestamp") AS INTEGER) AS hour, CAST(day(r."timestamp") AS INTEGER) AS day,
         CAST(month(r."timestamp") AS INTEGER) AS month, CAST(year(r."timestamp") AS INTEGER) AS year,
         CAST(r."timestamp" AS DATE) AS date
       FROM raw r JOIN parsed p ON r.event_id = p.event_id
       JOIN (SELECT event_id, coalesce(trim(upper(log_level)), 'INFO') AS level FROM raw) l ON l.event_id = r.event_id
       WHERE r."timestamp" IS NOT NULL OR trim(r.message) <> ''""",
)
def _(t: Inputs):
    return parse_logs(t.raw).select(*CANONICAL)


@register(
    "parse_logs_interactive",
    f"""SELECT event_id, "timestamp", {INTERACTIVE_LEVEL} AS log_level, message FROM raw
        WHERE "timestamp" IS NOT NULL""",
)
def _(t: Inputs):
    return parse_logs_interactive(t.raw).select("event_id", "timestamp", "log_level", "message")
