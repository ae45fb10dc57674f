"""Streaming queries: the whole log table goes through a drop folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import Inputs, register
from catalog.sources import short_year, structured
from emberlog.streaming import drop_folder


@register(
    "stream_error_trends",
    """SELECT date_trunc('hour', "timestamp") AS time_window, count(*) AS error_count FROM errors GROUP BY 1""",
)
def _(t: Inputs):
    # Half of the rows come in files with another order of columns.
    base = t.scratch()
    first = F.col("event_id") % 2 == 0
    structured(t, f"{base}/drop/a", t.messages.filter(first))
    short_year(t, f"{base}/drop/b", t.messages.filter(~first))
    drop_folder.start_folder_trends(t.spark, f"{base}/drop", f"{base}/trends", f"{base}/checkpoint").awaitTermination()
    return drop_folder.read_folder_trends(t.spark, f"{base}/trends")


@register(
    "stream_alert_dedup",
    """
    WITH RECURSIVE sending(username, alert_type, sent) AS (
      SELECT username, alert_type, min(alert_ts) FROM alerts GROUP BY ALL
      UNION ALL
      SELECT s.username, s.alert_type, (SELECT min(a.alert_ts) FROM alerts a WHERE a.username = s.username
          AND a.alert_type = s.alert_type AND a.alert_ts >= s.sent + INTERVAL 3600 SECONDS)
      FROM sending s WHERE s.sent IS NOT NULL)
    SELECT username, alert_type, sent AS alert_ts FROM sending WHERE sent IS NOT NULL
    """,
)
def _(t: Inputs):
    # Alerts arrive file by file in an order that has nothing to do with their times.
    base = t.scratch()
    shuffled = t.alerts.repartition(4, F.xxhash64("alert_id"))
    shuffled.write.parquet(f"{base}/alerts")
    stream = t.spark.readStream.schema(t.alerts.schema).option("maxFilesPerTrigger", 2).parquet(f"{base}/alerts")
    out = f"{base}/kept"
    drop_folder.start_alert_dedup(stream, out, f"{base}/checkpoint", lateness_s=40 * 86_400).awaitTermination()
    drop_folder.release_held(t.spark, out, t.alerts.schema)
    return drop_folder.read_sent_alerts(t.spark, out).select("username", "alert_type", "alert_ts")
