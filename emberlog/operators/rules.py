"""Alert rules. Threshold rules share one metrics row; frequency and burst rules share the error messages.

Every rule yields alert rows (none when it does not fire), so rules are put together by union.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlog.config import Thresholds
from emberlog.functions.timestamps import instant
from emberlog.operators.filters import filter_errors
from emberlog.operators.metrics import count_rows, level_totals, ratio
from emberlog.operators.ranking import top_messages
from emberlog.operators.rolling import bursts
from emberlog.sources.log_table import read_if_exists

FIELDS = ("alert_type", "severity", "message", "details", "metrics")


def _text(column: Column) -> Column:
    return column.cast("string")


def _metrics(**values: Column) -> Column:
    pairs = [part for name, value in values.items() for part in (F.lit(name), _text(value))]
    return F.create_map(*pairs)


def _alert(alert_type: str, severity: str, message: Column, details: Column, metrics: Column) -> Column:
    return F.struct(
        F.lit(alert_type).alias("alert_type"),
        F.lit(severity).alias("severity"),
        message.alias("message"),
        details.alias("details"),
        metrics.alias("metrics"),
    )


def _fired(df: DataFrame, *rules: tuple[Column, Column]) -> DataFrame:
    """Alert rows of those rules whose condition holds, from a one-row table."""
    candidates = F.array(*[F.when(condition, alert) for condition, alert in rules])
    return df.select(F.inline(F.filter(candidates, lambda alert: alert.isNotNull())))


def _percent(fraction: Column) -> Column:
    return F.format_string("%.2f%%", fraction * 100)


def threshold_alerts(totals: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """Batch rules on the metrics row: error rate above, error count above, severe errors at least the limit."""
    rate = ratio(F.col("total_errors"), F.col("total_logs"))
    errors, severe = F.col("total_errors"), F.col("critical_errors")
    # Alert types, severities and wording of the batch rules.
    return _fired(
        totals,
        (
            rate > limits.error_rate,
            _alert(
                "HIGH_ERROR_RATE",
                "CRITICAL",
                F.concat(
                    F.lit("Error rate "),
                    _percent(rate),
                    F.lit(f" exceeds threshold {limits.error_rate:.2%}"),
                ),
                F.lit(""),
                _metrics(total_logs=F.col("total_logs"), total_errors=errors),
            ),
        ),
        (
            errors > limits.error_count,
            _alert(
                "HIGH_ERROR_COUNT",
                "CRITICAL",
                F.concat(
                    F.lit("Total error count "), _text(errors), F.lit(f" exceeds threshold {limits.error_count}")
                ),
                F.lit(""),
                _metrics(total_errors=errors),
            ),
        ),
        (
            severe >= limits.critical_count,
            _alert(
                "CRITICAL_ERRORS",
                "CRITICAL",
                F.concat(
                    F.lit("Found "),
                    _text(severe),
                    F.lit(f" critical errors (threshold: {limits.critical_count})"),
                ),
                F.lit(""),
                _metrics(critical_errors=severe),
            ),
        ),
    )


def rate_alerts(
    totals: DataFrame, top_text: DataFrame, in_cooldown: Column, limits: Thresholds = Thresholds()
) -> DataFrame:
    """Interactive rules on the metrics row: error and CRITICAL share in percent above the limit."""
    total, errors, criticals = F.col("total_logs"), F.col("total_errors"), F.col("total_critical")
    error_pct, critical_pct = ratio(errors, total) * 100, ratio(criticals, total) * 100
    may_fire = ~F.col("cooling")
    listed = F.coalesce(F.col("top_text"), F.lit(""))
    # Alert types, severities and wording of the interactive rate rules.
    return _fired(
        totals.withColumns({"top_text": top_text.scalar(), "cooling": in_cooldown}),
        (
            may_fire & (error_pct > limits.error_rate_pct),
            _alert(
                "High Error Rate",
                "Critical",
                F.format_string("High Error Rate Detected: %.2f%%", error_pct),
                F.concat(F.format_string("Total Logs: %d\nError Count: %d\n", total, errors), listed),
                _metrics(total_logs=total, total_errors=errors),
            ),
        ),
        (
            may_fire & (critical_pct > limits.critical_rate_pct),
            _alert(
                "High Critical Rate",
                "Critical",
                F.format_string(
                    f"Critical Log Rate Exceeds {limits.critical_rate_pct}%%: %.2f%%", critical_pct
                ),
                F.concat(F.format_string("Total: %d, Criticals: %d\n", total, criticals), listed),
                _metrics(total_logs=total, total_critical=criticals),
            ),
        ),
    )


def frequent_messages(df: DataFrame, above: int = 5) -> DataFrame:
    """Every error message seen more than ``above`` times, with its count."""
    return (
        filter_errors(df)
        .filter(F.col("message").isNotNull())
        .groupBy("message")
        .agg(count_rows().alias("count"))
        .filter(F.col("count") > above)
    )


def _ranked_lines(line: str) -> Column:
    """One line of text per collected (message, count), most frequent first."""
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("count")).alias("minus"), "message", "count")))
    return F.array_join(F.transform(ranked, lambda r: F.format_string(line, r["message"], r["count"])), "\n")


def top_errors_text(df: DataFrame, n: int = 20) -> DataFrame:
    """One row and column: the most frequent error messages as text lines, null without errors."""
    lines = F.concat(F.lit("Top Errors:\n"), _ranked_lines("- %s (%d)"))
    return top_messages(df, n).agg(F.when(count_rows() > 0, lines).alias("top_text"))


def _leading(frequent: DataFrame, n: int, line: str) -> DataFrame:
    """One row: lines and leader of the ``n`` most frequent messages."""
    top = frequent.orderBy(F.desc("count"), "message").limit(n)
    leader = F.min(F.struct((-F.col("count")).alias("minus"), "message", "count"))
    return top.agg(count_rows().alias("listed"), _ranked_lines(line).alias("lines"), leader.alias("first"))


def frequent_alert(df: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """Batch rule: error messages above the limit; text and number of patterns cover the top ones."""
    leading = _leading(frequent_messages(df, limits.frequent_count), limits.frequent_listed, "- %s: %d")
    one = F.format_string("Frequent Error: %s (%d times)", "first.message", "first.count")
    many = F.format_string(
        f"Multiple Frequent Errors Detected (%d distinct types > {limits.frequent_count} occ.)", "listed"
    )
    details = F.concat(F.lit(f"Errors occurring > {limits.frequent_count} times:\n"), "lines", F.lit("\n"))
    headline = F.when(F.col("listed") > 1, many).otherwise(one)
    # Alert type, severity and wording of the batch frequency rule.
    return _fired(
        leading,
        (
            F.col("listed") > 0,
            _alert(
                "FREQUENT_ERRORS",
                "CRITICAL",
                F.concat(headline, F.lit("\n\n"), details),
                F.lit(""),
                _metrics(patterns=F.col("listed"), top_count=F.col("first.count")),
            ),
        ),
    )


def frequent_pattern_alert(
    df: DataFrame, in_cooldown: Column, limits: Thresholds = Thresholds()
) -> DataFrame:
    """Interactive rule: all error messages above the limit. The messages are the rows of ``frequent_details``."""
    frequent = frequent_messages(df, limits.frequent_count)
    leader = F.min(F.struct((-F.col("count")).alias("minus"), "message", "count"))
    leading = frequent.agg(count_rows().alias("patterns"), leader.alias("first")).withColumn("cooling", in_cooldown)
    one = F.format_string("Frequent Error Detected: %s (%d times)", "first.message", "first.count")
    many = F.format_string("Multiple Frequent Errors Detected (%d types)", "patterns")
    # Alert type, severity and wording of the interactive frequency rule.
    return _fired(
        leading,
        (
            (F.col("patterns") > 0) & ~F.col("cooling"),
            _alert(
                "Frequent Error Pattern",
                "Critical",
                F.when(F.col("patterns") > 1, many).otherwise(one),
                F.lit(f"Errors occurring > {limits.frequent_count} times"),
                _metrics(patterns=F.col("patterns"), top_count=F.col("first.count")),
            ),
        ),
    )


def frequent_details(df: DataFrame, alerts: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """(alert_id, rank, message, count) of every message behind the stamped frequency alert among one check's ``alerts``.

    Equal counts share a rank, one more than the number of messages with a greater count. Ranks come from the
    distinct counts, whose number grows with the root of the number of rows.
    """
    frequent = frequent_messages(df, limits.frequent_count)
    greater = Window.orderBy(F.desc("count")).rowsBetween(Window.unboundedPreceding, -1)
    ranks = frequent.groupBy("count").agg(count_rows().alias("n")).select(
        "count", (F.coalesce(F.sum("n").over(greater), F.lit(0)) + 1).alias("rank")
    )
    fired = alerts.filter(F.col("alert_type") == "Frequent Error Pattern").agg(F.max("alert_id"))
    named = frequent.join(ranks, "count").withColumn("alert_id", fired.scalar())
    return named.filter(F.col("alert_id").isNotNull()).select("alert_id", "rank", "message", "count")


def burst_alert(df: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """Interactive rule: of the messages that burst, the one most frequent in total. Not subject to cooldown."""
    found = bursts(
        filter_errors(df), threshold=limits.burst_count, window_s=limits.burst_window_s
    )
    first = found.orderBy(F.desc("total"), "message").limit(1)
    # Alert type, severity and wording of the burst rule.
    return _fired(
        first,
        (
            F.lit(True),
            _alert(
                "Error Burst",
                "Critical",
                F.format_string("Alert: Error Burst Detected - '%s' (%d/hr)", "message", "max_burst"),
                F.format_string("Error '%s' occurred %d times in a single hour window.", "message", "max_burst"),
                _metrics(burst_rate=F.col("max_burst"), total=F.col("total")),
            ),
        ),
    )


def batch_alerts(df: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """All batch rules."""
    return threshold_alerts(level_totals(df), limits).unionByName(frequent_alert(df, limits))


def interactive_alerts(
    df: DataFrame,
    limits: Thresholds = Thresholds(),
    in_cooldown: Column | None = None,
    force: bool = False,
) -> DataFrame:
    """All interactive rules. ``force`` ignores the cooldown and reports a check without findings as Info."""
    cooling = F.lit(False) if force or in_cooldown is None else in_cooldown
    totals = level_totals(df)
    alerts = (
        rate_alerts(totals, top_errors_text(df, limits.top_listed), cooling, limits)
        .unionByName(frequent_pattern_alert(df, cooling, limits))
        .unionByName(burst_alert(df, limits))
    )
    if not force:
        return alerts
    # The record of a forced check without findings.
    nothing = _alert(
        "Manual Check",
        "Info",
        F.lit("Manual Alert History Check"),
        F.lit(""),
        F.create_map().cast("map<string,string>"),
    )
    # At most one row per rule is gathered here.
    found = alerts.agg(F.collect_list(F.struct(*FIELDS)).alias("found")).withColumn(
        "total_logs", totals.select("total_logs").scalar()
    )
    quiet = (F.size("found") == 0) & (F.col("total_logs") > 0)
    return found.select(F.inline(F.when(quiet, F.array(nothing)).otherwise(F.col("found"))))


def stamp(alerts: DataFrame, at: datetime | None = None, username: str | None = None) -> DataFrame:
    """Alert-table rows: when, for whom, and a stable id over the content."""
    moment = F.current_timestamp() if at is None else instant(at)
    stamped = alerts.withColumns(
        {"alert_ts": moment, "username": F.lit(username).cast("string")}
    )
    return with_alert_id(stamped)


def with_alert_id(alerts: DataFrame) -> DataFrame:
    """Name each alert by its content; a null differs from an empty text."""
    parts = (F.unix_micros("alert_ts").cast("string"), "username", "alert_type", "message", "details")
    marked = [F.coalesce(F.concat(F.lit("="), part), F.lit("-")) for part in parts]
    return alerts.withColumn("alert_id", F.sha2(F.concat_ws("|", *marked), 256)).select(
        "alert_id", "alert_ts", "username", "alert_type", "severity", "message", "details", "metrics"
    )


def changed_since_check(df: DataFrame, last_count: int | Column = -1) -> DataFrame:
    """One row: the current row count and whether it differs from the one of the last check."""
    last = last_count if isinstance(last_count, Column) else F.lit(last_count)
    return df.agg(count_rows().alias("total_logs")).withColumn("changed", ~F.col("total_logs").eqNullSafe(last))


def check_for_change(df: DataFrame, base: str, username: str | None = None, at: datetime | None = None) -> DataFrame:
    """Compare the row count with the user's last check below ``base`` and append this check there.

    One row: total_logs, changed. The first check is a change. A check that is repeated after a failure adds its own row.
    """
    spark = df.sparkSession
    checks = read_if_exists(spark, f"{base}/checks", "username string, checked_at timestamp, total_logs long")
    last = checks.filter(F.col("username").eqNullSafe(username)).agg(F.max_by("total_logs", "checked_at"))
    row = changed_since_check(df, last.scalar()).first()
    moment = F.current_timestamp() if at is None else instant(at)
    found = spark.createDataFrame([(row.total_logs, row.changed)], "total_logs long, changed boolean")
    noted = found.select(F.lit(username).cast("string").alias("username"), moment.alias("checked_at"), "total_logs")
    noted.write.mode("append").parquet(f"{base}/checks")
    return found
