"""The standard report set, either as separate lazy tables or from one scan of the error rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.config import DETAIL_COLUMNS
from emberlog.functions.text import spaced_on_one_line
from emberlog.operators import metrics, ranking
from emberlog.operators.filters import filter_errors
from emberlog.schema import project_existing
from emberlog.sinks.reports import export_csv, export_json, export_parquet
from emberlog.sources.log_table import write_parsed


@dataclass(frozen=True)
class Report:
    """A standard report: its grouping in the cube, output form and order."""

    name: str
    keys: tuple[str, ...]
    count: str
    order: tuple[str, ...]
    form: str
    filled: bool = False
    folder: str | None = None


# The report set with its column names and file forms.
REPORTS = (
    Report("errors_by_type", ("error_type",), "count", ("-count", "error_type"), "csv"),
    Report("errors_by_hour", ("date", "hour"), "error_count", ("date", "hour"), "csv"),
    Report("top_n_errors", ("error_type", "message"), "count", ("-count", "error_type", "message"), "csv",
           folder="top_errors"),
    Report("errors_per_ip", ("ip_address",), "error_count", ("-error_count", "ip_address"), "csv", filled=True),
    Report("errors_per_service", ("service_name",), "error_count", ("-error_count", "service_name"), "csv",
           filled=True),
    Report("error_trends", ("time_window",), "error_count", ("time_window",), "json"),
    Report("errors_by_day", ("date",), "error_count", ("date",), "json"),
    Report("errors_by_severity", ("severity", "log_level"), "count", ("-severity", "log_level"), "json"),
)
CUBE_KEYS = tuple(dict.fromkeys(key for report in REPORTS for key in report.keys))


def run_all(df: DataFrame, top_n: int = 10, window: str = "1h") -> dict[str, DataFrame]:
    """All eight reports as independent lazy tables."""
    return {
        "errors_by_type": metrics.errors_by_type(df),
        "errors_by_severity": metrics.errors_by_severity(df),
        "errors_by_hour": metrics.errors_by_hour(df),
        "errors_by_day": metrics.errors_by_day(df),
        "top_n_errors": ranking.top_n_errors(df, top_n),
        "error_trends": metrics.error_trends(df, window),
        "errors_per_ip": metrics.errors_per_ip(df),
        "errors_per_service": metrics.errors_per_service(df),
    }


def counts_cube(df: DataFrame, window: str = "1h") -> DataFrame:
    """Error counts of all eight groupings from one scan: ``report``, every grouping column, ``count``.

    Only error rows are multiplied by the grouping sets, and they are combined before the shuffle.
    """
    ts = F.col("timestamp")
    # A row without a timestamp belongs to no window but to every other report. `window` drops such rows, so their
    # place is taken by a stand-in instant and the start put back to null.
    stand_in = F.coalesce(ts, F.timestamp_seconds(F.lit(0)))
    rows = (
        filter_errors(df)
        .withColumns({"_known": ts.isNotNull(), "_ts": stand_in})
        .withColumn("_span", F.window("_ts", metrics.window_length(window)))
        .select(
            "error_type",
            "message",
            "severity",
            "log_level",
            "ip_address",
            "service_name",
            F.to_date(ts).alias("date"),
            F.hour(ts).alias("hour"),
            F.when(F.col("_known"), F.col("_span.start")).alias("time_window"),
        )
    )
    sets = [[F.col(key) for key in report.keys] for report in REPORTS]
    grouped = rows.groupingSets(sets, *[F.col(key) for key in CUBE_KEYS]).agg(
        F.grouping_id(*CUBE_KEYS).alias("_set"), metrics.count_rows().alias("count")
    )
    names = {_set_id(report.keys): report.name for report in REPORTS}
    name = F.element_at(F.create_map(*[F.lit(part) for pair in names.items() for part in pair]), F.col("_set"))
    return grouped.select(name.alias("report"), *CUBE_KEYS, "count")


def _set_id(keys: tuple[str, ...]) -> int:
    """Spark's grouping id: one bit per cube column from the left, set where the column is grouped away."""
    bits = "".join("0" if key in keys else "1" for key in CUBE_KEYS)
    return int(bits, 2)


def _ordered(df: DataFrame, order: tuple[str, ...]) -> DataFrame:
    return df.orderBy(*[F.desc(key[1:]) if key.startswith("-") else F.asc(key) for key in order])


def from_cube(cube: DataFrame, top_n: int = 10) -> dict[str, DataFrame]:
    """The eight reports cut out of a cube, which should have been written or cached before."""
    reports = {}
    for report in REPORTS:
        rows = cube.filter(F.col("report") == report.name)
        if report.filled:
            rows = rows.filter(F.col(report.keys[0]) != "")
        if report.name == "error_trends":
            rows = rows.filter(F.col("time_window").isNotNull())
        rows = _ordered(rows.select(*report.keys, F.col("count").alias(report.count)), report.order)
        reports[report.name] = rows.limit(top_n) if report.name == "top_n_errors" else rows
    return reports


def export_reports(reports: dict[str, DataFrame], out: str) -> list[str]:
    """Write each report to ``csv/<name>`` or ``json/<name>``; the paths written."""
    written = []
    for report in REPORTS:
        if report.name not in reports:
            continue
        path = f"{out}/{report.form}/{report.folder or report.name}"
        export = export_csv if report.form == "csv" else export_json
        export(reports[report.name], path, single_file=report.name == "top_n_errors")
        written.append(path)
    return written


def export_summary(df: DataFrame, out: str) -> str:
    """Write the summary record as one JSON object, and the rows of every level beside it."""
    path = f"{out}/json/summary"
    export_json(metrics.summary(df), path, single_file=True)
    export_json(metrics.level_counts(df), f"{out}/json/level_counts")
    return path


def export_all(df: DataFrame, out: str, top_n: int = 10, parsed_path: str | None = None) -> list[str]:
    """Everything: the cube from one scan, the reports cut from it, the summary, optionally the parsed table."""
    cube_path = f"{out}/parquet/error_counts"
    counts_cube(df).hint("rebalance", "report").write.mode("overwrite").partitionBy("report").parquet(cube_path)
    cube = df.sparkSession.read.parquet(cube_path)
    written = [cube_path, *export_reports(from_cube(cube, top_n), out), export_summary(df, out)]
    if parsed_path:
        write_parsed(df, parsed_path)
        written.append(parsed_path)
    return written


def report_summary(df: DataFrame) -> DataFrame:
    """The one-row head of the downloadable report: totals, rate, peak hour and most frequent error."""
    peak = metrics.peak_error_hour(df)
    frequent = ranking.most_frequent_error(df)
    peak_text = F.format_string("%s (Count: %d)", "hour_range", "error_count")
    frequent_text = F.format_string("%s (Count: %d)", spaced_on_one_line(F.col("message")), "count")
    return metrics.kpis(df).select(
        "total_logs",
        "total_errors",
        "total_warnings",
        F.format_string("%.2f%%", "error_rate_pct").alias("error_rate"),
        F.coalesce(peak.select(peak_text).scalar(), F.lit("N/A")).alias("peak_error_time"),
        F.coalesce(frequent.select(frequent_text).scalar(), F.lit("N/A")).alias("most_frequent_error"),
    )


def error_detail(df: DataFrame) -> DataFrame:
    """Error rows with the detail columns that exist."""
    return project_existing(filter_errors(df), DETAIL_COLUMNS)


def report_meta(df: DataFrame, top: int = 5) -> DataFrame:
    """The one-row head of the JSON report: a struct of totals and an array of the top error messages."""
    leaders = F.array_sort(F.collect_list(F.struct((-F.col("count")).alias("minus"), "message", "count")))
    plain = F.transform(leaders, lambda r: F.struct(r["message"].alias("message"), r["count"].alias("count")))
    return metrics.kpis(df).select(
        F.struct(
            "total_logs",
            "total_errors",
            "total_warnings",
            F.round("error_rate_pct", 2).alias("error_rate_percent"),
        ).alias("report_meta"),
        ranking.top_messages(df, top).agg(plain).scalar().alias("top_errors"),
    )


def export_detail(df: DataFrame, out: str, form: str = "csv") -> list[str]:
    """Head and error rows of the downloadable report, as two outputs; the rows stay in many files."""
    head_path, rows_path = f"{out}/{form}/report_head", f"{out}/{form}/report_rows"
    if form == "csv":
        export_csv(report_summary(df), head_path, single_file=True)
        export_csv(error_detail(df), rows_path)
    elif form == "json":
        export_json(report_meta(df), head_path, single_file=True)
        rows = error_detail(df)
        export_json(rows.withColumn("timestamp", F.col("timestamp").cast("string")), rows_path)
    else:
        export_parquet(report_summary(df), head_path)
        export_parquet(error_detail(df), rows_path)
    return [head_path, rows_path]
