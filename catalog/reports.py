"""The report set, its cube form, and the downloadable reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.aggregates import SUMMARY_SQL, summary_items
from catalog.registry import Inputs, register
from emberlog.plans import reports
from emberlog.sinks.reports import TIMESTAMP_FORMAT

# Every report as rows of (report, key, count); a key is its columns joined by '|'.
LONG_SQL = """
SELECT 'errors_by_type' AS report, error_type AS key, count(*) AS count FROM errors GROUP BY 1, 2
UNION ALL SELECT 'errors_by_hour', CAST("timestamp" AS DATE) || '|' || hour("timestamp"), count(*) FROM errors GROUP BY 1, 2
UNION ALL SELECT * FROM (SELECT 'top_n_errors', error_type || '|' || message, count(*) AS n FROM errors
                         GROUP BY error_type, message ORDER BY n DESC, error_type, message LIMIT 10)
UNION ALL SELECT 'errors_per_ip', ip_address, count(*) FROM errors WHERE ip_address <> '' GROUP BY 1, 2
UNION ALL SELECT 'errors_per_service', service_name, count(*) FROM errors WHERE service_name <> '' GROUP BY 1, 2
UNION ALL SELECT 'error_trends', strftime("timestamp", '%Y-%m-%d %H:00:00'), count(*) FROM errors GROUP BY 1, 2
UNION ALL SELECT 'errors_by_day', CAST(CAST("timestamp" AS DATE) AS VARCHAR), count(*) FROM errors GROUP BY 1, 2
UNION ALL SELECT 'errors_by_severity', severity || '|' || log_level, count(*) FROM errors GROUP BY 1, 2"""


# A written empty text is `""`; with this null marker, which no file contains, it is read back as such.
NO_NULL = "\u0001"


def long_form(results: dict[str, DataFrame]) -> DataFrame:
    shape = {report.name: report for report in reports.REPORTS}

    def rows(name: str, df: DataFrame) -> DataFrame:
        key = F.concat_ws("|", *[F.col(key).cast("string") for key in shape[name].keys])
        return df.select(
            F.lit(name).alias("report"), key.alias("key"), F.col(shape[name].count).cast("long").alias("count")
        )

    return reduce(lambda a, b: a.unionByName(b), [rows(name, df) for name, df in results.items()])


@register("run_all", LONG_SQL)
def _(t: Inputs):
    return long_form(reports.run_all(t.logs))


@register("counts_cube", LONG_SQL.replace("ORDER BY n DESC, error_type, message LIMIT 10", ""))
def _(t: Inputs):
    # All reports in full, in one pass over the cube.
    shape = reports.REPORTS
    key = F.coalesce(*[
        F.when(F.col("report") == r.name, F.concat_ws("|", *[F.col(k).cast("string") for k in r.keys])) for r in shape
    ])
    filled = reduce(lambda a, b: a & b, [(F.col("report") != r.name) | (F.col(r.keys[0]) != "") for r in shape if r.filled])
    known = (F.col("report") != "error_trends") | F.col("time_window").isNotNull()
    return reports.counts_cube(t.logs).filter(filled & known).select("report", key.alias("key"), "count")


@register("report_bundle", LONG_SQL)
def _(t: Inputs):
    out = t.scratch()
    reports.export_all(t.logs, out)
    results = {}
    for report in reports.REPORTS:
        path = f"{out}/{report.form}/{report.folder or report.name}"
        # Dates and times are compared as the text in the files.
        columns = ", ".join(f"`{name}` string" for name in (*report.keys, report.count))
        reader = t.spark.read.schema(columns)
        csv = reader.option("header", True).option("nullValue", NO_NULL)
        read = csv.csv(path) if report.form == "csv" else reader.json(path)
        if report.name == "error_trends":
            read = read.withColumn("time_window", F.substring("time_window", 1, 19))
        results[report.name] = read
    return long_form(results)


@register("export_summary", SUMMARY_SQL)
def _(t: Inputs):
    out = t.scratch()
    path = reports.export_summary(t.logs, out)
    schema = """total_logs long, total_errors long, error_rate double, unique_ips long, unique_services long,
                unique_error_types long"""
    levels = t.spark.read.schema("log_level string, count long").json(f"{out}/json/level_counts")
    return summary_items(t.spark.read.schema(schema).json(path), levels)


@register(
    "report_csv_summary",
    """WITH h AS (SELECT date_trunc('hour', "timestamp") AS peak, count(*) AS n FROM errors GROUP BY 1
                  ORDER BY n DESC, peak LIMIT 1),
       m AS (SELECT message, n FROM message_counts ORDER BY n DESC, message LIMIT 1)
       SELECT count(*) AS total_logs, count(*) FILTER (log_level = 'ERROR') AS total_errors,
         count(*) FILTER (log_level = 'WARN') AS total_warnings,
         printf('%.2f%%', count(*) FILTER (log_level = 'ERROR') / count(*) * 100) AS error_rate,
         (SELECT strftime(peak, '%Y-%m-%d %H:00') || ' - ' || strftime(peak + INTERVAL 1 HOUR, '%H:00') || ' (Count: '
                 || n || ')' FROM h) AS peak_error_time,
         (SELECT replace(replace(message, ',', ';'), chr(10), ' ') || ' (Count: ' || n || ')' FROM m)
           AS most_frequent_error
       FROM parsed""",
)
def _(t: Inputs):
    return reports.report_summary(t.logs)


@register(
    "report_csv_detail",
    'SELECT "timestamp", log_level, service_name, error_type, message FROM errors',
)
def _(t: Inputs):
    out = t.scratch()
    _head, rows = reports.export_detail(t.logs, out, "csv")
    schema = "timestamp timestamp, log_level string, service_name string, error_type string, message string"
    reader = t.spark.read.schema(schema).option("header", True).option("escape", '"').option("nullValue", NO_NULL)
    return reader.option("timestampFormat", TIMESTAMP_FORMAT).csv(rows)


@register(
    "report_json_meta",
    """SELECT count(*) AS total_logs, count(*) FILTER (log_level = 'ERROR') AS total_errors,
         count(*) FILTER (log_level = 'WARN') AS total_warnings,
         round(count(*) FILTER (log_level = 'ERROR') / count(*) * 100, 2) AS error_rate_percent,
         (SELECT '[' || string_agg('{"message":"' || message || '","count":' || n || '}', ',' ORDER BY n DESC, message) || ']'
          FROM (SELECT message, n FROM message_counts ORDER BY n DESC, message LIMIT 5)) AS top_errors
       FROM parsed""",
)
def _(t: Inputs):
    return reports.report_meta(t.logs).select("report_meta.*", F.to_json("top_errors").alias("top_errors"))


@register(
    "report_json_rows",
    """SELECT strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS "timestamp", log_level, error_type, message FROM errors""",
)
def _(t: Inputs):
    _head, rows = reports.export_detail(t.logs, t.scratch(), "json")
    read = t.spark.read.schema("timestamp string, log_level string, error_type string, message string").json(rows)
    return read.withColumn("timestamp", F.substring("timestamp", 1, 19))
