"""The append-only alert table and its text form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.schema import ALERTS
from emberlog.sources.log_table import read_if_exists


def append_alerts(alerts: DataFrame, path: str) -> None:
    """Append stamped alert rows."""
    alerts.select(*ALERTS.fieldNames()).write.mode("append").parquet(path)


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """The alert table, empty where there is none yet."""
    return read_if_exists(spark, path, ALERTS)


def alert_lines(alerts: DataFrame) -> DataFrame:
    """Alerts as ``[time] [severity] type: message`` lines."""
    when = F.date_format("alert_ts", "yyyy-MM-dd HH:mm:ss")
    line = F.format_string("[%s] [%s] %s: %s", when, "severity", "alert_type", "message")
    return alerts.select(line.alias("value"))


def append_alert_lines(alerts: DataFrame, path: str) -> None:
    alert_lines(alerts).write.mode("append").text(path)
