"""Queries over the alert table and the analysis-history table."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlog.functions.timestamps import instant
from emberlog.operators.filters import all_of
from emberlog.operators.metrics import count_rows
from emberlog.operators.ranking import top_messages
from emberlog.sinks.scratch import stored


def alert_history(
    alerts: DataFrame,
    username: str,
    first: date | None = None,
    last: date | None = None,
    limit: int = 100,
) -> DataFrame:
    """A user's newest alerts, optionally of whole days only."""
    parts = [F.col("username") == username]
    if first:
        parts.append(F.col("alert_ts") >= instant(datetime.combine(first, time.min)))
    if last:
        parts.append(F.col("alert_ts") < instant(datetime.combine(last + timedelta(days=1), time.min)))
    return alerts.filter(all_of(parts)).orderBy(F.desc("alert_ts"), "alert_id").limit(limit)


def recent_alerts(alerts: DataFrame, limit: int = 20) -> DataFrame:
    """The newest alerts of everyone."""
    return alerts.orderBy(F.desc("alert_ts"), "alert_id").limit(limit)


def alert_summary(alerts: DataFrame) -> DataFrame:
    """Alerts per type, with the number of all alerts on every row; the newest ones are ``recent_alerts(alerts, 10)``."""
    per_type = alerts.groupBy("alert_type").agg(count_rows().alias("count"))
    total = per_type.agg(F.sum("count")).scalar()
    return per_type.withColumn("total_alerts", total).orderBy(
        F.desc("count"), "alert_type"
    )


def alert_overview(alerts: DataFrame, latest: int = 10) -> DataFrame:
    """The whole summary in rows: a ``total`` row, a ``type`` row per type, and ``latest`` rows of the newest alerts."""
    kind = F.lit(None).cast("string")
    per_type = alert_summary(alerts).select(
        F.lit("type").alias("part"), "alert_type", "count", F.lit(None).cast("timestamp").alias("alert_ts"), kind.alias("message")
    )
    total = alerts.agg(count_rows().alias("count")).select(
        F.lit("total").alias("part"), kind.alias("alert_type"), "count", F.lit(None).cast("timestamp").alias("alert_ts"),
        kind.alias("message"),
    )
    newest = recent_alerts(alerts, latest).select(
        F.lit("latest").alias("part"), "alert_type", F.lit(1).cast("bigint").alias("count"), "alert_ts", "message"
    )
    return total.unionByName(per_type).unionByName(newest)


def alerts_for_top_errors(alerts: DataFrame, logs: DataFrame, n: int = 5) -> DataFrame:
    """Alerts whose details or message contain one of the ``n`` most frequent error messages that aren't blank.

    The messages reach the filter as one array of at most ``n`` strings, so the alerts are never shuffled.
    """
    said = logs.filter(F.trim("message") != "")
    wanted = top_messages(said, n).agg(F.collect_list("message")).scalar()
    text = F.concat_ws(" ", F.coalesce("details", F.lit("")), F.coalesce("message", F.lit("")))
    tagged = alerts.withColumn("_wanted", wanted).withColumn("_text", text)
    hit = F.exists("_wanted", lambda message: F.contains(F.col("_text"), message))
    return tagged.filter(hit).drop("_wanted", "_text")


def in_cooldown(
    alerts: DataFrame, username: str, at: datetime | None = None, cooldown_s: int = 3600
) -> Column:
    """Whether the user's latest alert is less than ``cooldown_s`` old, as a scalar for the interactive rules."""
    moment = F.current_timestamp() if at is None else instant(at)
    latest = alerts.filter((F.col("username") == username) & (F.col("alert_ts") <= moment))
    age_us = F.unix_micros(moment) - F.unix_micros(F.max("alert_ts"))
    return latest.agg(F.coalesce(age_us < cooldown_s * 1_000_000, F.lit(False))).scalar()


def _next_times(times: DataFrame, cooldown: int) -> DataFrame:
    """(key, time, next): the first of a key's real times that is at least the cooldown later, null if there is none.

    ``times`` has (key, time, real). Time is cut into slots of one cooldown. What is looked for lies in the slot after the time's
    own, or else is the first time of the next slot that has any, so windows hold the rows of one slot, or one row per slot.
    """
    slot = F.floor(F.col("at") / cooldown).cast("long")
    here = times.filter("real").select("key", F.col("time").alias("at"), F.lit(1).alias("kind"), "time")
    asked = times.select("key", (F.col("time") + cooldown).alias("at"), F.lit(0).alias("kind"), "time")
    both = here.unionByName(asked).withColumn("slot", slot)
    # From the latest to the earliest: the time passed last is the first one at or after a row.
    passed = Window.partitionBy("key", "slot").orderBy(F.desc("at"), F.desc("kind"))
    is_time = F.col("kind") == 1
    found = F.last(F.when(is_time, F.col("at")), ignorenulls=True).over(passed.rowsBetween(Window.unboundedPreceding, 0))
    firsts = both.groupBy("key", "slot").agg(F.min(F.when(is_time, F.col("at"))).alias("first"))
    beyond = Window.partitionBy("key").orderBy(F.desc("slot")).rowsBetween(Window.unboundedPreceding, -1)
    firsts = firsts.select("key", "slot", F.last("first", ignorenulls=True).over(beyond).alias("beyond"))
    return (
        both.withColumn("found", found)
        .filter("kind = 0")
        .join(firsts, ["key", "slot"])
        .select("key", "time", F.coalesce("found", "beyond").alias("next"))
    )


def sending_times(times: DataFrame, cooldown: int, last: DataFrame | None = None) -> DataFrame:
    """(key, time) of those of the distinct ``times`` (key, time) that send: each the first at least the cooldown after the one before.

    ``last`` (key, time) has the sending before them, where there was one. The chain of a key is followed by pointer doubling:
    every time points to the next sending after it if it were one itself; in each round the times known to send are joined by
    those that the pointers lead to, and pointers are joined to themselves, so they lead twice as far. The rounds follow the
    logarithm of the longest chain, rows are spread by (key, time), and nothing is gathered by key.
    """
    every = times.select("key", "time", F.lit(True).alias("real"))
    if last is not None:
        every = every.unionByName(last.select("key", "time", F.lit(False).alias("real")))
    # Where there was a sending before, the chain begins with it.
    start = every.groupBy("key").agg(
        F.coalesce(F.min(F.when(~F.col("real"), F.col("time"))), F.min("time")).alias("time"),
        F.min("real").alias("sends"),
    )
    # A time that equals the earlier sending's is a node of its own, which no chain can reach.
    pointers = _next_times(every, cooldown).filter("next IS NOT NULL").distinct()
    pointers, reached = stored(pointers), stored(start)
    while not pointers.isEmpty():
        # What a round adds is as far along the chain as all that was known before is long, so there are no repeats.
        led = reached.join(pointers, ["key", "time"]).select("key", F.col("next").alias("time"), F.lit(True).alias("sends"))
        reached = stored(reached.unionByName(led))
        further = pointers.select("key", F.col("time").alias("next"), F.col("next").alias("after"))
        pointers = stored(pointers.join(further, ["key", "next"]).select("key", "time", F.col("after").alias("next")))
    return reached.filter("sends").select("key", "time")


def key_of(*names: str) -> Column:
    """Columns as one text that is never null and differs where they do."""
    parts = [F.coalesce(F.concat(F.char_length(name).cast("string"), F.lit(":"), F.col(name)), F.lit("-")) for name in names]
    return F.concat(*parts)


def replay_cooldown(alerts: DataFrame, cooldown_s: int = 3600, tick_s: int = 60) -> DataFrame:
    """Mark which alerts of a log would have been ``sent`` had the cooldown been applied all along.

    Rules are checked once per tick, at the time of the tick's first alert, and all alerts of one check share its fate: a
    user's check sends if the last sending one is at least ``cooldown_s`` earlier. Alerts without a user are one user's.
    Neither a user's alerts nor their checks are gathered (see ``sending_times``).
    """
    tick = F.floor(F.unix_seconds("alert_ts") / tick_s).cast("long")
    ticked = alerts.withColumns({"_tick": tick, "_key": key_of("username")})
    checks = ticked.filter("alert_ts IS NOT NULL").groupBy(F.col("_key").alias("key"), "_tick")
    checks = checks.agg(F.min(F.unix_micros("alert_ts")).alias("time"))
    sent = sending_times(checks.select("key", "time"), cooldown_s * 1_000_000)
    sent = sent.select(F.col("key").alias("_key"), F.floor(F.col("time") / (tick_s * 1_000_000)).cast("long").alias("_tick"))
    sent = sent.withColumn("sent", F.lit(True))
    marked = ticked.join(sent, ["_key", "_tick"], "left")
    return marked.select(*alerts.columns, F.coalesce("sent", F.lit(False)).alias("sent"))


def history_list(history: DataFrame, username: str, limit: int = 50) -> DataFrame:
    """A user's newest analyses."""
    newest = history.filter(F.col("username") == username).orderBy(F.desc("analysis_ts"), "record_id")
    return newest.limit(limit)
