"""Counts, rates, breakdowns and trends.

Everything here is a hash aggregate with map-side combination, so a hot key costs no more than any other.
Breakdowns come most frequent first, series in time order; equals are ordered by their key.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.config import STANDARD_LEVELS
from emberlog.functions.timestamps import bucket, instant, window_length
from emberlog.operators.filters import filter_errors, is_critical_error, is_error, is_filled, is_level


def count_rows() -> Column:
    return F.count(F.lit(1))


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole``, 0.0 for an empty whole."""
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def level_totals(df: DataFrame) -> DataFrame:
    """One row: all rows, errors, warnings, CRITICAL rows and severe errors. Serves the KPIs and threshold rules."""
    severe = F.count_if(is_critical_error()) if "severity" in df.columns else F.count_if(is_error())
    return df.agg(
        count_rows().alias("total_logs"),
        F.count_if(is_error()).alias("total_errors"),
        F.count_if(is_level("WARN")).alias("total_warnings"),
        F.count_if(is_level("CRITICAL")).alias("total_critical"),
        severe.alias("critical_errors"),
    )


def total_logs(df: DataFrame) -> DataFrame:
    return df.agg(count_rows().alias("total_logs"))


def error_count(df: DataFrame) -> DataFrame:
    return filter_errors(df).agg(count_rows().alias("total_errors"))


def error_rate(df: DataFrame) -> DataFrame:
    return df.agg(ratio(F.count_if(is_error()), count_rows()).alias("error_rate"))


def errors_by_type(df: DataFrame) -> DataFrame:
    return filter_errors(df).groupBy("error_type").agg(count_rows().alias("count")).orderBy(
        F.desc("count"), "error_type"
    )


def errors_by_severity(df: DataFrame) -> DataFrame:
    counted = filter_errors(df).groupBy("severity", "log_level").agg(count_rows().alias("count"))
    return counted.orderBy(F.desc("severity"), "log_level")


def errors_by_hour(df: DataFrame) -> DataFrame:
    ts = F.col("timestamp")
    by = (F.to_date(ts).alias("date"), F.hour(ts).alias("hour"))
    return filter_errors(df).groupBy(*by).agg(count_rows().alias("error_count")).orderBy("date", "hour")


def errors_by_day(df: DataFrame) -> DataFrame:
    return (
        filter_errors(df)
        .groupBy(F.to_date("timestamp").alias("date"))
        .agg(count_rows().alias("error_count"))
        .orderBy("date")
    )


def error_trends(df: DataFrame, size: str = "1h", offset: str | None = None) -> DataFrame:
    """Errors per tumbling window, named by the window's start; ``offset`` shifts the alignment."""
    span = F.window("timestamp", window_length(size), startTime=offset)
    return (
        filter_errors(df)
        .groupBy(span.alias("span"))
        .agg(count_rows().alias("error_count"))
        .select(F.col("span.start").alias("time_window"), "error_count")
        .orderBy("time_window")
    )


def errors_per(df: DataFrame, column: str) -> DataFrame:
    """Errors per filled value of a column."""
    return (
        filter_errors(df)
        .filter(is_filled(column))
        .groupBy(column)
        .agg(count_rows().alias("error_count"))
        .orderBy(F.desc("error_count"), column)
    )


def errors_per_ip(df: DataFrame) -> DataFrame:
    return errors_per(df, "ip_address")


def errors_per_service(df: DataFrame) -> DataFrame:
    return errors_per(df, "service_name")


def level_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("log_level").agg(count_rows().alias("count"))


def distinct_counts(df: DataFrame, approximate: bool = False) -> DataFrame:
    """One row: distinct filled addresses and services, and distinct types of errors.

    Exact by default, at the price of shuffling the distinct values; ``approximate`` keeps a fixed-size sketch.
    """
    values = {
        "unique_ips": F.nullif("ip_address", F.lit("")),
        "unique_services": F.nullif("service_name", F.lit("")),
        "unique_error_types": F.when(is_error(), F.col("error_type")),
    }
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*[count(value).alias(name) for name, value in values.items()])


def summary(df: DataFrame, approximate: bool = False) -> DataFrame:
    """The one-row summary record: totals, error rate and distinct counts. The levels are the ``level_counts`` table."""
    uniques = distinct_counts(df, approximate)
    totals = level_counts(df).agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("total_logs"),
        F.coalesce(F.sum(F.when(is_error(), F.col("count"))), F.lit(0)).alias("total_errors"),
    )
    return totals.withColumn("uniques", uniques.select(F.struct(*uniques.columns)).scalar()).select(
        "total_logs",
        "total_errors",
        ratio(F.col("total_errors"), F.col("total_logs")).alias("error_rate"),
        "uniques.*",
    )


def kpis(df: DataFrame) -> DataFrame:
    """One row: total, errors, warnings and the error rate in percent."""
    return level_totals(df).select(
        "total_logs",
        "total_errors",
        "total_warnings",
        (ratio(F.col("total_errors"), F.col("total_logs")) * 100).alias("error_rate_pct"),
    )


def level_split(df: DataFrame) -> DataFrame:
    """Three rows: INFO (everything that is neither error nor warning), WARN and ERROR."""
    rest = F.col("total_logs") - F.col("total_errors") - F.col("total_warnings")
    rows = [("INFO", rest), ("WARN", F.col("total_warnings")), ("ERROR", F.col("total_errors"))]
    structs = [F.struct(F.lit(name).alias("level"), value.alias("count")) for name, value in rows]
    return level_totals(df).select(F.inline(F.array(*structs)))


def trend(df: DataFrame, granularity: str = "hour") -> DataFrame:
    """ERROR and WARN rows per time bucket, buckets without any left out."""
    return (
        df.filter(F.col("log_level").isin("ERROR", "WARN") & F.col("timestamp").isNotNull())
        .groupBy(bucket(F.col("timestamp"), granularity).alias("bucket"), "log_level")
        .agg(count_rows().alias("count"))
        .orderBy("bucket", "log_level")
    )


def time_bounds(df: DataFrame) -> DataFrame:
    """One row: first and last timestamp, and the default range of the seven days up to the last one."""
    return df.agg(F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts")).select(
        "first_ts",
        "last_ts",
        F.date_sub(F.to_date("last_ts"), 7).alias("default_start"),
        F.to_date("last_ts").alias("default_end"),
    )


def auto_granularity(df: DataFrame) -> DataFrame:
    """One row: ``day`` for data spanning more than 30 whole days, otherwise ``hour``."""
    seconds = F.unix_seconds("last_ts") - F.unix_seconds("first_ts")
    days = F.floor(seconds / 86400)
    return time_bounds(df).select(
        days.alias("span_days"), F.when(days > 30, F.lit("day")).otherwise(F.lit("hour")).alias("granularity")
    )


def peak_error_hour(df: DataFrame) -> DataFrame:
    """At most one row: the hour with most errors, the earliest of equals, with its printable range."""
    hour = F.date_trunc("hour", F.col("timestamp"))
    until = F.col("peak_hour") + F.expr("INTERVAL 1 HOUR")
    return (
        filter_errors(df)
        .filter(F.col("timestamp").isNotNull())
        .groupBy(hour.alias("peak_hour"))
        .agg(count_rows().alias("error_count"))
        .orderBy(F.desc("error_count"), "peak_hour")
        .limit(1)
        .withColumn(
            "hour_range",
            F.concat_ws(
                " - ",
                F.date_format("peak_hour", "yyyy-MM-dd HH:00"),
                F.date_format(until, "HH:00"),
            ),
        )
    )


def period_change(
    df: DataFrame, current: tuple[datetime, datetime], previous: tuple[datetime, datetime]
) -> DataFrame:
    """KPIs of a period against an earlier one: values, difference, percent change and direction per metric.

    Periods are half open. Both are counted in one pass over the rows of either.
    """

    def inside(period: tuple[datetime, datetime]) -> Column:
        start, end = period
        return (F.col("timestamp") >= instant(start)) & (F.col("timestamp") < instant(end))

    now, before = inside(current), inside(previous)
    either = now | before
    if "date" in df.columns:
        first, last = min(current[0], previous[0]), max(current[1], previous[1])
        either = either & F.col("date").between(F.lit(first.date()), F.lit(last.date()))
    tests = {"total_logs": F.lit(True), "total_errors": is_error(), "total_warnings": is_level("WARN")}
    counted = df.filter(either).agg(
        *[F.count_if(now & test).cast("double").alias(f"{name}_now") for name, test in tests.items()],
        *[F.count_if(before & test).cast("double").alias(f"{name}_before") for name, test in tests.items()],
    )

    def metric(name: str, value_now: Column, value_before: Column) -> Column:
        return F.struct(
            F.lit(name).alias("metric"), value_now.alias("current"), value_before.alias("previous")
        )

    def percent(when: str) -> Column:
        return ratio(F.col(f"total_errors_{when}"), F.col(f"total_logs_{when}")) * 100

    rows = [metric(name, F.col(f"{name}_now"), F.col(f"{name}_before")) for name in tests]
    rows.append(metric("error_rate_pct", percent("now"), percent("before")))
    diff = F.col("current") - F.col("previous")
    return (
        counted.select(F.inline(F.array(*rows)))
        .withColumn("diff", diff)
        .withColumn("pct_change", F.try_divide(F.col("diff") * 100, F.col("previous")))
        .withColumn(
            "direction",
            F.when(F.col("previous") != 0, F.when(diff > 0, "up").when(diff < 0, "down").otherwise("flat")),
        )
    )


def first_last_seen(df: DataFrame) -> DataFrame:
    """First and last occurrence and the count of every error message."""
    return (
        filter_errors(df)
        .groupBy("message")
        .agg(
            F.min("timestamp").alias("first_seen"),
            F.max("timestamp").alias("last_seen"),
            count_rows().alias("count"),
        )
    )


def level_values(df: DataFrame) -> DataFrame:
    """Every level that is standard or occurs."""
    levels = F.array(*[F.lit(level) for level in STANDARD_LEVELS])
    standard = df.sparkSession.range(1).select(F.explode(levels).alias("log_level"))
    occurring = df.select("log_level").filter(F.col("log_level").isNotNull()).distinct()
    return occurring.unionByName(standard).distinct().orderBy("log_level")


def service_values(df: DataFrame) -> DataFrame:
    """Every service that occurs."""
    return df.select("service_name").filter(F.col("service_name").isNotNull()).distinct().orderBy("service_name")
