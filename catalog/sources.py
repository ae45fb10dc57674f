"""Readers and round trips. Every query writes the whole log table as text files and reads them with the engine."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalog.registry import Inputs, register
from emberlog.config import BATCH, INTERACTIVE
from emberlog.operators import clean, metrics
from emberlog.operators.metrics import count_rows
from emberlog.plans.batch import ingest, ingest_interactive
from emberlog.plans.parse import parse_logs, parse_logs_interactive
from emberlog.sinks import history, reports
from emberlog.sources import keyword_index, rollups
from emberlog.sources.csv_logs import list_files, read_csv_logs, read_rejects
from emberlog.sources.log_table import ingest_new, read_ingested, read_parsed, write_parsed

SYSLOG_YEAR = replace(BATCH, default_year=2024)


def as_text(t: Inputs, path: str, rows: DataFrame, **columns: Column) -> str:
    """Write the given columns of the log table as CSV files."""
    shaped = rows.select(*[column.alias(name) for name, column in columns.items()])
    reports.export_csv(shaped, path, single_file=False)
    return path


def structured(t: Inputs, path: str, rows: DataFrame) -> str:
    return as_text(
        t,
        path,
        rows,
        LineId=F.col("event_id"),
        Date=F.date_format("timestamp", "yyyy-MM-dd"),
        Time=F.date_format("timestamp", "HH:mm:ss"),
        Level=F.col("log_level"),
        Content=F.col("message"),
    )


def short_year(t: Inputs, path: str, rows: DataFrame) -> str:
    return as_text(
        t,
        path,
        rows,
        level=F.col("log_level"),
        date=F.date_format("timestamp", "yy/MM/dd"),
        time=F.date_format("timestamp", "HH:mm:ss"),
        content=F.col("message"),
        lineid=F.col("event_id"),
    )


def basic(t: Inputs, path: str, rows: DataFrame) -> str:
    return as_text(
        t,
        path,
        rows,
        timestamp=F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"),
        log_level=F.col("log_level"),
        message=F.col("message"),
        IP=F.col("ip_address"),
        ip=F.lit("second column of that name"),
        service=F.col("service_name"),
        LineId=F.col("event_id"),
    )


def line_id(df: DataFrame) -> DataFrame:
    return df.withColumn("event_id", F.col("lineid").cast("long"))


@register(
    "scan_csv",
    """SELECT CAST(event_id AS VARCHAR) AS lineid, strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS "timestamp", log_level,
       message, ip_address AS ip, service_name AS service FROM logs""",
)
def _(t: Inputs):
    path = basic(t, t.scratch(), t.rows)
    return read_csv_logs(t.spark, path).select("lineid", "timestamp", "log_level", "message", "ip", "service")


@register(
    "scan_rejects",
    """
    WITH lines AS (SELECT event_id, event_id % 5 = 1 AS long, event_id % 7 = 2 AS short, strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS ts,
                          log_level, replace(message, '"', '""') AS said FROM logs)
    SELECT CASE WHEN short THEN log_level || ',"' || said || ', quoted"'
                ELSE ts || ',' || log_level || ',' || said || ', node 7,' || event_id END AS record,
           CASE WHEN short THEN 'short' ELSE 'long' END AS reason, CASE WHEN short THEN 2 ELSE 5 END AS fields, 4 AS expected,
           CAST(NULL AS VARCHAR) AS lineid, CAST(NULL AS VARCHAR) AS message
    FROM lines WHERE long OR short
    UNION ALL
    SELECT NULL, NULL, NULL, NULL, CAST(event_id AS VARCHAR), message || ', quoted' FROM logs
    WHERE event_id % 5 <> 1 AND event_id % 7 <> 2
    """,
)
def _(t: Inputs):
    # A fifth of the records has a comma too many, a seventh lacks fields; with the rows they are all there is.
    path, said = t.scratch(), F.replace("message", F.lit('"'), F.lit('""'))
    event = F.col("event_id")
    ts, quoted = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"), F.concat(F.lit('"'), said, F.lit(', quoted"'))
    number = event.cast("string")
    line = (
        F.when(event % 7 == 2, F.concat_ws(",", "log_level", quoted))
        .when(event % 5 == 1, F.concat_ws(",", ts, "log_level", F.concat(said, F.lit(", node 7")), number))
        .otherwise(F.concat_ws(",", ts, "log_level", quoted, number))
    )
    shaped = t.rows.select((event % 16).alias("part"), F.lit(1).alias("place"), line.alias("value"))
    heads = shaped.select("part").distinct().select("part", F.lit(0).alias("place"), F.lit("timestamp,log_level,message,LineId").alias("value"))
    lines = shaped.unionByName(heads).repartition("part").sortWithinPartitions("part", "place")
    lines.select("part", "value").write.partitionBy("part").text(path)
    found = {"glob": "*.txt", "recursive": True, "strict": True}
    rejects = read_rejects(t.spark, path, **found).drop("source_file")
    rows = read_csv_logs(t.spark, path, **found).select("lineid", "message")
    return rejects.unionByName(rows, allowMissingColumns=True)


@register(
    "ts_from_date_time",
    """SELECT event_id, date_trunc('millisecond', "timestamp") AS "timestamp" FROM logs""",
)
def _(t: Inputs):
    path = as_text(
        t,
        t.scratch(),
        t.messages,
        LineId=F.col("event_id"),
        Date=F.date_format("timestamp", "yyyy-MM-dd"),
        Time=F.date_format("timestamp", "HH:mm:ss,SSS"),
    )
    return line_id(clean.normalize_timestamps(read_csv_logs(t.spark, path))).select("event_id", "timestamp")


@register("ts_bracketed", """SELECT event_id, date_trunc('second', "timestamp") AS "timestamp" FROM logs""")
def _(t: Inputs):
    path = as_text(
        t,
        t.scratch(),
        t.messages,
        LineId=F.col("event_id"),
        Date=F.date_format("timestamp", "'['yyyy-MM-dd"),
        Time=F.date_format("timestamp", "HH:mm:ss']'"),
    )
    raw = read_csv_logs(t.spark, path, INTERACTIVE)
    return line_id(clean.normalize_timestamps(raw)).select("event_id", "timestamp")


@register("ts_syslog", """SELECT event_id, date_trunc('second', "timestamp") AS "timestamp" FROM logs""")
def _(t: Inputs):
    path = as_text(
        t,
        t.scratch(),
        t.messages,
        LineId=F.col("event_id"),
        Month=F.date_format("timestamp", "MMM"),
        Date=F.date_format("timestamp", "d"),
        Time=F.date_format("timestamp", "HH:mm:ss"),
    )
    raw = read_csv_logs(t.spark, path)
    return line_id(clean.normalize_timestamps(raw, SYSLOG_YEAR.default_year)).select("event_id", "timestamp")


def three_headers(t: Inputs) -> str:
    """The log table in three file shapes with different headers, by event type."""
    base, rows, kind = t.scratch(), t.rows, F.col("event_type")
    structured(t, f"{base}/structured", rows.filter(kind == "click"))
    short_year(t, f"{base}/short_year", rows.filter(kind.isin("view", "signup")))
    basic(t, f"{base}/basic", rows.filter(~kind.isin("click", "view", "signup")))
    return base


MERGED_SQL = """SELECT event_id, date_trunc('second', "timestamp") AS "timestamp", log_level, trim(message) AS message,
       CASE WHEN event_type NOT IN ('click', 'view', 'signup') THEN ip_address END AS ip_address FROM logs"""


@register("scan_multi_merge", MERGED_SQL)
def _(t: Inputs):
    raw = read_csv_logs(t.spark, three_headers(t), recursive=True)
    return line_id(parse_logs(raw)).select("event_id", "timestamp", "log_level", "message", "ip_address")


@register(
    "scan_parquet",
    """SELECT event_id, "timestamp", log_level, severity, message, error_type, CAST("timestamp" AS DATE) AS date
       FROM parsed""",
)
def _(t: Inputs):
    path = f"{t.scratch()}/parsed"
    write_parsed(t.logs, path)
    columns = ("event_id", "timestamp", "log_level", "severity", "message", "error_type", "date")
    return read_parsed(t.spark, path).select(*columns)


@register(
    "incremental_new_files",
    """SELECT date_trunc('second', "timestamp") AS "timestamp", log_level, trim(message) AS message, error_type
       FROM parsed""",
)
def _(t: Inputs):
    base, drop, rows = t.scratch(), t.scratch(), t.messages
    # Two drops: the second run only sees the files of the second one.
    structured(t, f"{drop}/first", rows.filter("event_type = 'error'"))
    ingest_new(t.spark, base, f"{drop}/first")
    short_year(t, f"{drop}/second", rows.filter("event_type <> 'error'"))
    ingest_new(t.spark, base, [f"{drop}/first", f"{drop}/second"])
    return read_ingested(t.spark, base).select("timestamp", "log_level", "message", "error_type")


@register(
    "scan_blank_first_line",
    """SELECT CAST(event_id AS VARCHAR) AS lineid, strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS "timestamp", log_level,
       message FROM logs""",
)
def _(t: Inputs):
    # Every file begins with blank lines; the writer of text lines keeps the order within a folder.
    path, fields = t.scratch(), ("timestamp", "log_level", "message", "lineid")
    shaped = t.rows.select(
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("timestamp"), "log_level", "message",
        F.col("event_id").alias("lineid"), (F.col("event_id") % 16).alias("part"),
    )
    line = F.to_csv(F.struct(*fields), {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})
    data = shaped.select("part", F.lit(1).alias("place"), line.alias("value"))
    heads = data.select("part").distinct().select(
        "part", F.lit(0).alias("place"), F.concat(F.lit("\n  \n"), F.lit(",".join(fields))).alias("value")
    )
    lines = data.unionByName(heads).repartition("part").sortWithinPartitions("part", "place")
    lines.select("part", "value").write.partitionBy("part").text(path)
    return read_csv_logs(t.spark, path, glob="*.txt", recursive=True).select("lineid", "timestamp", "log_level", "message")


def changed(t: Inputs, after_each: Callable[[str], None] = lambda base: None) -> str:
    """A log table whose first files, of errors only, were replaced under their names by files with all rows."""
    base, drop, spare = t.scratch(), t.scratch(), t.scratch()
    # Dealt alike, so that each file of the first run has one with its rows and more in the second.
    parts = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    structured(t, drop, t.messages.filter("event_type = 'error'").repartition(parts, "event_id"))
    ingest_new(t.spark, base, drop)
    after_each(base)
    structured(t, spare, t.messages.repartition(parts, "event_id"))
    replace_files(t, spare, drop)
    ingest_new(t.spark, base, drop)
    after_each(base)
    return base


@register(
    "incremental_changed_file",
    """SELECT date_trunc('second', "timestamp") AS "timestamp", log_level, trim(message) AS message, error_type
       FROM parsed""",
)
def _(t: Inputs):
    return read_ingested(t.spark, changed(t)).select("timestamp", "log_level", "message", "error_type")


def rolled(t: Inputs) -> str:
    return changed(t, lambda base: rollups.refresh(t.spark, base))


@register(
    "trend_incremental",
    """SELECT date_trunc('hour', "timestamp") AS bucket, log_level, count(*) AS count FROM parsed
       WHERE log_level IN ('ERROR', 'WARN') GROUP BY 1, 2""",
)
def _(t: Inputs):
    return rollups.trend(t.spark, rolled(t))


@register(
    "errors_by_type_incremental",
    "SELECT error_type, count(*) AS count FROM errors GROUP BY error_type",
)
def _(t: Inputs):
    return rollups.errors_by_type(t.spark, rolled(t))


@register(
    "first_last_seen_incremental",
    """SELECT message, date_trunc('second', min("timestamp")) AS first_seen, date_trunc('second', max("timestamp")) AS last_seen,
       count(*) AS count FROM errors GROUP BY message""",
)
def _(t: Inputs):
    return rollups.first_last_seen(t.spark, rolled(t))


@register(
    "distinct_sketches",
    r"""SELECT count(DISTINCT nullif(regexp_extract(message, '\b(?:\d{1,3}\.){3}\d{1,3}\b', 0), '')) AS unique_ips,
        count(DISTINCT error_type) FILTER (log_level = 'ERROR') AS unique_error_types, TRUE AS close FROM parsed""",
)
def _(t: Inputs):
    # The exact counts, and whether the estimates of the stored sketches are within three standard errors.
    base = rolled(t)
    names = ("unique_ips", "unique_error_types")
    exact = metrics.distinct_counts(read_ingested(t.spark, base)).select(F.lit(True).alias("exact"), *names)
    estimated = rollups.distinct_between(t.spark, base).select(F.lit(False).alias("exact"), *names)
    bound = 3 * 1.04 / 2 ** (rollups.SKETCH_BITS / 2)
    both = exact.unionByName(estimated).agg(
        *(F.max(F.when(F.col("exact") == kind, F.col(name))).alias(f"{name}_{kind}") for name in names for kind in (True, False))
    )
    close = [F.abs(F.col(f"{name}_False") - F.col(f"{name}_True")) <= bound * F.col(f"{name}_True") for name in names]
    return both.select(*(F.col(f"{name}_True").alias(name) for name in names), (close[0] & close[1]).alias("close"))


@register(
    "search_keyword_skipping",
    """SELECT date_trunc('second', "timestamp") AS "timestamp", log_level, trim(message) AS message FROM parsed
       WHERE contains(lower(trim(message)), 'timeout') OR contains(lower(log_level), 'timeout')""",
)
def _(t: Inputs):
    base = changed(t, lambda table: keyword_index.refresh(t.spark, table))
    return keyword_index.search_keyword(t.spark, base, " TimeOut").select("timestamp", "log_level", "message")


def replace_files(t: Inputs, source: str, target: str) -> None:
    """Put the data files of ``source`` in the places and under the names of those of ``target``, and what is left beside them."""
    path = t.spark._jvm.org.apache.hadoop.fs.Path
    new, old = (sorted(list_files(t.spark, folder)) for folder in (source, target))
    if len(new) < len(old):
        raise ValueError(f"{len(new)} files can't replace {len(old)}")
    files = path(target).getFileSystem(t.spark._jsc.hadoopConfiguration())
    for k, name in enumerate(new):
        place = path(old[k]) if k < len(old) else path(target, path(name).getName())
        files.delete(place, False)
        files.rename(path(name), place)


@register(
    "ingest",
    r"""SELECT event_id, date_trunc('second', "timestamp") AS "timestamp", log_level, severity, message, error_type,
        regexp_extract(message, '\b(?:\d{1,3}\.){3}\d{1,3}\b', 0) AS ip_address, endpoint_path FROM parsed""",
)
def _(t: Inputs):
    parsed = line_id(ingest(t.spark, structured(t, t.scratch(), t.messages)))
    return parsed.select(
        "event_id", "timestamp", "log_level", "severity", "message", "error_type", "ip_address", "endpoint_path"
    )


@register(
    "ingest_interactive",
    """SELECT event_id, date_trunc('second', "timestamp") AS "timestamp", log_level, message FROM logs""",
)
def _(t: Inputs):
    parsed = line_id(ingest_interactive(t.spark, short_year(t, t.scratch(), t.messages)))
    return parsed.select("event_id", "timestamp", "log_level", "message")


MIXED_LAYOUTS = (
    "yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd HH:mm:ss", "M/d/yyyy h:mm:ss a", "MMM d, yyyy HH:mm:ss", "MMMM d, yyyy h:mm:ss a",
    "d-MMM-yyyy HH:mm:ss", "d MMM yyyy HH:mm:ss", "d MMMM yyyy HH:mm:ss", "EEE MMM d HH:mm:ss yyyy", "yyyy-MM-dd h:mm:ss a",
    "yy/MM/dd HH:mm:ss",
)


@register("normalize_timestamp_interactive", """SELECT event_id, date_trunc('second', "timestamp") AS "timestamp" FROM logs""")
def _(t: Inputs):
    written = [
        F.when(F.col("event_id") % len(MIXED_LAYOUTS) == k, F.date_format("timestamp", layout))
        for k, layout in enumerate(MIXED_LAYOUTS)
    ]
    mixed = t.rows.select("event_id", F.coalesce(*written).alias("timestamp"))
    return parse_logs_interactive(mixed).select("event_id", "timestamp")


@register("history_load", 'SELECT event_id, "timestamp", log_level, message FROM parsed')
def _(t: Inputs):
    base = t.scratch()
    record = history.record_analysis(t.logs, base, "user-1", ["events.csv"])
    return history.load_snapshot(t.spark, base, record).select("event_id", "timestamp", "log_level", "message")


@register(
    "history_as_of",
    """SELECT date_trunc('second', "timestamp") AS "timestamp", log_level, trim(message) AS message FROM parsed
       WHERE event_type = 'error'""",
)
def _(t: Inputs):
    # Recorded before the files were replaced, loaded after.
    base, records = t.scratch(), []

    def record(table: str) -> None:
        records.append(history.record_ingested(t.spark, base, table, "user-1", ["events.csv"]))

    changed(t, record)
    return history.load_snapshot(t.spark, base, records[0]).select("timestamp", "log_level", "message")


@register(
    "history_record",
    """SELECT 'user-1' AS username, 'a.csv, b.csv' AS file_name, count(*) FILTER (log_level = 'ERROR') AS num_errors,
       count(*) FILTER (log_level = 'WARN') AS num_warnings FROM parsed""",
)
def _(t: Inputs):
    base = t.scratch()
    history.record_analysis(t.logs, base, "user-1", ["a.csv", "b.csv"])
    rows = history.read_history(t.spark, base)
    return rows.select("username", "file_name", "num_errors", "num_warnings")


@register(
    "export_csv",
    "SELECT ip_address, count(*) AS error_count FROM errors WHERE ip_address <> '' GROUP BY ip_address",
)
def _(t: Inputs):
    path = f"{t.scratch()}/csv"
    reports.export_csv(metrics.errors_per_ip(t.logs), path)
    return t.spark.read.schema("ip_address string, error_count long").option("header", True).csv(path)


@register(
    "export_json",
    """SELECT date_trunc('hour', "timestamp") AS time_window, count(*) AS error_count FROM errors GROUP BY 1""",
)
def _(t: Inputs):
    path = f"{t.scratch()}/json"
    reports.export_json(metrics.error_trends(t.logs), path)
    reader = t.spark.read.schema("time_window timestamp, error_count long")
    return reader.option("timestampFormat", reports.TIMESTAMP_FORMAT).json(path)


@register(
    "export_json_array",
    """SELECT epoch_ms(CAST(CAST("timestamp" AS DATE) AS TIMESTAMP)) AS date, count(*) AS error_count
       FROM errors GROUP BY 1""",
)
def _(t: Inputs):
    path = f"{t.scratch()}/json"
    reports.export_json_array(metrics.errors_by_day(t.logs), path)
    array = F.from_json("value", "array<struct<date: long, error_count: long>>")
    return t.spark.read.text(path).select(F.inline(array))


@register(
    "export_parquet",
    'SELECT CAST("timestamp" AS DATE) AS date, log_level, count(*) AS count FROM parsed GROUP BY 1, 2',
)
def _(t: Inputs):
    path = f"{t.scratch()}/parquet"
    write_parsed(t.logs, path)
    return t.spark.read.parquet(path).groupBy("date", "log_level").agg(count_rows().alias("count"))
