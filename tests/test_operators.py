"""Filters, metrics and ranking on hand-made rows."""

from __future__ import annotations

from datetime import date, datetime, time

import pytest
from pyspark.sql import functions as F

from emberlog.operators import clean, filters, metrics, ranking
from emberlog.operators.filters import SearchFilter
from emberlog.plans import reports
from tests.conftest import tuples

EMPTY = "timestamp timestamp, log_level string, severity int, message string, error_type string, ip_address string, service_name string"


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], EMPTY)


def ids(df):
    return sorted(int(r.lineid) for r in df.select("lineid").collect())


def test_sample_counts(sample):
    assert tuples(metrics.level_totals(sample)) == [(10, 4, 2, 1, 4)]
    assert tuples(metrics.error_rate(sample)) == [(0.4,)]
    assert tuples(metrics.kpis(sample)) == [(10, 4, 2, 40.0)]
    assert tuples(metrics.level_split(sample)) == [("INFO", 4), ("WARN", 2), ("ERROR", 4)]
    row = metrics.summary(sample).first()
    assert dict(tuples(metrics.level_counts(sample))) == {"INFO": 3, "WARN": 2, "ERROR": 4, "CRITICAL": 1}
    assert (row.total_logs, row.total_errors, row.error_rate) == (10, 4, 0.4)
    assert (row.unique_ips, row.unique_services, row.unique_error_types) == (1, 1, 4)


def test_breakdowns_add_up_to_the_errors(sample):
    results = reports.run_all(sample)
    for name in ("errors_by_type", "errors_by_hour", "errors_by_day", "error_trends", "errors_by_severity"):
        count = next(r.count for r in reports.REPORTS if r.name == name)
        assert sum(row[count] for row in results[name].collect()) == 4, name
    for name in ("errors_per_ip", "errors_per_service"):
        assert sum(row["error_count"] for row in results[name].collect()) <= 4, name


def test_order_of_results(sample):
    assert tuples(metrics.errors_by_type(sample)) == [
        ("", 1),
        ("QueueFullException", 1),
        ("TimeoutError", 1),
        ("UnknownError", 1),
    ]
    assert tuples(metrics.errors_by_hour(sample)) == [
        (date(2026, 3, 1), 9, 2),
        (date(2026, 3, 1), 10, 1),
        (date(2026, 3, 2), 8, 1),
    ]
    assert tuples(metrics.errors_by_day(sample)) == [(date(2026, 3, 1), 3), (date(2026, 3, 2), 1)]
    assert tuples(metrics.error_trends(sample, "1d")) == [(datetime(2026, 3, 1), 3), (datetime(2026, 3, 2), 1)]
    assert [m for _, m, _ in tuples(ranking.top_n_errors(sample, 2))] == [
        "disk failed to mount",
        "QueueFullException while adding",
    ]


def test_empty_table(empty):
    assert tuples(metrics.error_rate(empty)) == [(0.0,)]
    assert tuples(metrics.kpis(empty)) == [(0, 0, 0, 0.0)]
    row = metrics.summary(empty).first()
    assert (row.total_logs, row.total_errors, row.error_rate) == (0, 0, 0.0)
    assert tuples(metrics.level_counts(empty)) == []
    assert tuples(metrics.peak_error_hour(empty)) == []
    assert tuples(metrics.auto_granularity(empty)) == [(None, "hour")]
    head = reports.report_summary(empty).first()
    assert (head.peak_error_time, head.most_frequent_error) == ("N/A", "N/A")
    assert tuples(reports.report_meta(empty).select("report_meta.total_logs", "top_errors")) == [(0, [])]
    assert [row[0] for row in metrics.level_values(empty).collect()] == ["DEBUG", "ERROR", "INFO", "WARN"]


def test_no_level_is_left_out(spark, tmp_path):
    many = spark.range(3000).select(
        F.concat(F.lit("L"), "id").alias("log_level"), *(F.lit("x").alias(c) for c in ("ip_address", "service_name", "error_type"))
    )
    reports.export_summary(many, str(tmp_path))
    levels = spark.read.json(f"{tmp_path}/json/level_counts")
    assert levels.count() == 3000 and spark.read.json(f"{tmp_path}/json/summary").first().total_logs == 3000


def test_approximate_distinct_counts(sample):
    assert tuples(metrics.distinct_counts(sample, approximate=True)) == tuples(metrics.distinct_counts(sample))


def test_granularity_switches_after_thirty_days(spark):
    def granularity(*moments):
        return metrics.auto_granularity(spark.createDataFrame([(m,) for m in moments], "timestamp timestamp")).first()

    start = datetime(2024, 1, 1, 12)
    assert tuple(granularity(start, datetime(2024, 2, 1, 11, 59, 59))) == (30, "hour")
    assert tuple(granularity(start, datetime(2024, 2, 1, 12))) == (31, "day")


def test_peak_hour(sample):
    assert tuples(metrics.peak_error_hour(sample)) == [
        (datetime(2026, 3, 1, 9), 2, "2026-03-01 09:00 - 10:00")
    ]


def test_period_change(sample):
    rows = metrics.period_change(
        sample,
        (datetime(2026, 3, 2), datetime(2026, 3, 3)),
        (datetime(2026, 3, 1), datetime(2026, 3, 2)),
    )
    got = {r.metric: tuple(r)[1:] for r in rows.collect()}
    assert got["total_logs"] == (4.0, 6.0, -2.0, pytest.approx(-100 / 3), "down")
    assert got["total_errors"] == (1.0, 3.0, -2.0, pytest.approx(-200 / 3), "down")
    assert got["total_warnings"] == (1.0, 1.0, 0.0, 0.0, "flat")
    assert got["error_rate_pct"] == (25.0, 50.0, -25.0, -50.0, "down")
    before = (datetime(2025, 1, 1), datetime(2025, 1, 2))
    none = metrics.period_change(sample, (datetime(2026, 3, 2), datetime(2026, 3, 3)), before).first()
    assert (none.previous, none.pct_change, none.direction) == (0.0, None, None)


def test_day_filter_includes_the_last_fraction_of_a_second(spark):
    moments = [datetime(2024, 1, 1, 23, 59, 59, 999999), datetime(2024, 1, 2), datetime(2023, 12, 31, 23, 59, 59)]
    df = spark.createDataFrame([(m,) for m in moments], "timestamp timestamp")
    assert tuples(df.filter(filters.in_days(df.columns, date(2024, 1, 1), date(2024, 1, 1)))) == [(moments[0],)]


def test_day_time_bounds():
    day = date(2024, 1, 1)
    assert filters.day_time_bounds(day) == (datetime(2024, 1, 1), datetime(2024, 1, 1, 23, 59, 59, 999999))
    assert filters.day_time_bounds(day, start=time(10), end=time(9)) is None
    later = filters.day_time_bounds(day, date(2024, 1, 2), time(10), time(9))
    assert later == (datetime(2024, 1, 1, 10), datetime(2024, 1, 2, 9))


def test_keyword_is_literal_unless_asked(sample):
    assert ids(filters.search_logs(sample, "10.1.2")) == [8]
    assert ids(filters.search_logs(sample, "q.e")) == []
    assert ids(filters.search_logs(sample, "q.e", regex=True)) == [5, 6]
    assert ids(filters.search_logs(sample, " WARN ")) == [2, 7]
    assert ids(filters.search_logs(sample, "(")) == []
    assert len(ids(filters.search_logs(sample, "  "))) == 10


def test_search_combines_conditions(sample):
    chosen = SearchFilter(
        time_range=(datetime(2026, 3, 1, 9, 1, 2), datetime(2026, 3, 2)), levels=("ERROR", "WARN"), services=("", "x")
    )
    assert ids(filters.search_logs(sample, filters=chosen)) == [3, 4, 5, 7]
    assert tuples(filters.search_counts(sample, "queue", chosen)) == [(1, 10)]


def test_filter_data(sample):
    assert len(ids(filters.filter_data(sample))) == 10
    assert len(ids(filters.filter_data(sample, choice="All"))) == 10
    assert ids(filters.filter_data(sample, choice="TimeoutError")) == [3]
    assert ids(filters.filter_data(sample.drop("error_type"), choice="queue drained")) == [6]
    assert ids(filters.filter_data(sample, levels=["error", "critical"])) == [3, 4, 5, 8, 10]
    assert ids(filters.filter_data(sample, (date(2026, 3, 2), date(2026, 3, 2)), services=["pricing"])) == [9]


def test_examples_and_seen(sample):
    again = sample.unionByName(sample)
    assert filters.error_examples(again, "disk failed to mount").count() == 2
    assert filters.error_examples(again, "disk failed to mount", 1).count() == 1
    seen = {r.message: r for r in metrics.first_last_seen(again).collect()}
    assert seen["disk failed to mount"]["count"] == 2
    assert len(seen) == 4


def test_duplicate_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["Ip", "IP", "x"])
    assert tuples(clean.drop_duplicate_columns(df)) == [(1, 3)]
    assert clean.drop_duplicate_columns(df).columns == ["ip", "x"]


def test_alias_does_not_replace_a_canonical_column(spark):
    df = spark.createDataFrame([("a", "b")], ["level", "log_level"])
    assert clean.rename_aliases(df).columns == ["level", "log_level"]


def test_top_relative(spark):
    rows = [("ERROR", m) for m in ["a"] * 4 + ["b"] * 3 + ["c"]]
    df = spark.createDataFrame(rows, "log_level string, message string")
    assert tuples(ranking.top_errors_relative(df, 2)) == [("a", 4, 100.0), ("b", 3, 75.0)]
    assert tuples(ranking.most_frequent_error(df)) == [("a", 4)]
