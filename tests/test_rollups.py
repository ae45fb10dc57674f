"""Aggregates kept batch by batch, records of the log table without copies, and file-skipping search."""

from __future__ import annotations

import os
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import HEADER, SAMPLE, tuples
from emberlog.operators import filters, heavy, metrics, rules
from emberlog.sinks import history
from emberlog.sources import keyword_index, log_table, rollups


@pytest.fixture
def table(spark, write_csv, tmp_path):
    """A log table of two batches, rolled up after each; the second replaces a file of the first."""
    base, drop = str(tmp_path / "log table"), str(tmp_path / "drop")
    write_csv("drop/a.csv", HEADER, *SAMPLE[:5])
    write_csv("drop/b.csv", HEADER, *SAMPLE[5:])
    log_table.ingest_new(spark, base, drop)
    rollups.refresh(spark, base)
    keyword_index.refresh(spark, base)
    first = history.record_ingested(spark, str(tmp_path / "records"), base, "ann", ["a.csv", "b.csv"])
    path = write_csv("drop/a.csv", HEADER, *SAMPLE[:3], ["11", "2026-03-03", "01:00:00", "ERROR", "New", "late Zebra row"],
                     ["12", "", "", "ERROR", "New", ""])
    os.utime(path, (2_000_000_000, 2_000_000_000))
    log_table.ingest_new(spark, base, drop)
    return base, first


REPORTS = ("errors_by_type", "errors_by_severity", "errors_by_hour", "errors_by_day", "errors_per_service", "errors_per_ip", "first_last_seen")


def test_reports_are_those_of_a_recount(spark, table):
    base, _ = table
    assert len(rollups.refresh(spark, base)) == 1 and rollups.refresh(spark, base) == []
    rows = log_table.read_ingested(spark, base)
    for name in REPORTS:
        want, got = getattr(metrics, name)(rows), getattr(rollups, name)(spark, base)
        assert got.columns == want.columns
        assert sorted(tuples(got), key=str) == sorted(tuples(want), key=str), name
    for granularity in ("minute", "hour", "day", "week", "month"):
        assert sorted(tuples(rollups.trend(spark, base, granularity))) == sorted(tuples(metrics.trend(rows, granularity)))
    assert tuples(rollups.distinct_between(spark, base)) == tuples(metrics.distinct_counts(rows))
    one_day = rows.filter(F.col("date") == "2026-03-02")
    day = date(2026, 3, 2)
    assert tuples(rollups.distinct_between(spark, base, day, day)) == tuples(metrics.distinct_counts(one_day))


def test_batches_not_rolled_up_yet_leave_the_earlier_state(spark, table):
    base, record = table
    got = sorted(tuples(rollups.first_last_seen(spark, base), "message"))
    assert ("disk failed to mount",) in got and ("late Zebra row",) not in got


def test_only_new_batches_are_read(spark, table):
    base, _ = table
    first = spark.read.parquet(f"{base}/rollups/done").first().batch_id
    log_table.read_ingested(spark, base).count()
    # Without the first batch's rows the refresh of the second still works.
    os.rename(f"{base}/logs/batch_id={first}", f"{base}/logs/_{first}")
    assert len(rollups.refresh(spark, base)) == 1
    assert ("late Zebra row",) in tuples(rollups.first_last_seen(spark, base), "message")


def test_empty_table(spark, tmp_path):
    base = str(tmp_path / "none")
    assert rollups.refresh(spark, base) == [] and keyword_index.refresh(spark, base) == []
    for name in REPORTS:
        assert getattr(rollups, name)(spark, base).count() == 0
    assert tuples(rollups.distinct_between(spark, base)) == [(0, 0, 0)]
    assert keyword_index.search_keyword(spark, base, "word").count() == 0


def test_sketch_error(spark, tmp_path):
    rows = spark.range(200_000).selectExpr(
        "'f' || id % 3 AS source_file", "TIMESTAMP'2024-01-01' AS timestamp", "'ERROR' AS log_level", "3 AS severity",
        "'m' AS message", "'type' || id % 7 AS error_type", "'10.' || id % 50000 AS ip_address", "'s' AS service_name",
        "date_add(DATE'2024-01-01', CAST(id % 5 AS INT)) AS date",
    )
    base = str(tmp_path)
    rollups._partials(rows)["sketches"].write.parquet(f"{base}/rollups/sketches/batch_id=b1")
    spark.createDataFrame([("b1",)], rollups.DONE).write.parquet(f"{base}/rollups/done")
    found = rollups.distinct_between(spark, base).first()
    assert abs(found.unique_ips - 50000) < 3 * 1.04 / 64 * 50000 and found.unique_error_types == 7


def test_record_without_a_copy(spark, table, tmp_path):
    base, record = table
    records = str(tmp_path / "records")
    row = history.read_history(spark, records).first()
    assert (row.num_errors, row.num_warnings, row.file_name) == (4, 2, "a.csv, b.csv")
    assert history.load_snapshot(spark, records, record).count() == 10
    assert log_table.read_ingested(spark, base).count() == 10 and not os.path.exists(f"{records}/snapshots")
    second = history.record_ingested(spark, records, base, "ann", ["a.csv"])
    messages = tuples(history.load_snapshot(spark, records, second), "message")
    assert ("late Zebra row",) in messages and ("disk failed to mount",) not in messages
    assert history.load_snapshot(spark, records, "unknown") is None
    empty = history.record_ingested(spark, records, str(tmp_path / "no table"), "ann", [])
    assert history.load_snapshot(spark, records, empty).count() == 0


def test_search_skips_files_and_finds_the_same_rows(spark, table):
    base, _ = table
    columns = ("timestamp", "log_level", "message")
    rows = log_table.read_ingested(spark, base).select(*columns, "service_name").cache()
    for _ in range(2):  # with the second batch not indexed, and indexed
        for query in ("zebra", "CONNECTION timeout", "error", "no such words", "e", "", " 10.1.2.3 "):
            want = filters.search_logs(rows, query)
            got = keyword_index.search_keyword(spark, base, query)
            assert sorted(tuples(got, *columns), key=str) == sorted(tuples(want, *columns), key=str), query
        keyword_index.refresh(spark, base)
    rows.unpersist()
    logs = [path for path in log_table.read_ingested(spark, base).inputFiles() if "/logs/" in path]
    read = [path for path in keyword_index.search_keyword(spark, base, "Zebra").inputFiles() if "/logs/" in path]
    assert len(logs) > 3 and len(read) == 1
    assert keyword_index.possible_files(spark, base, "no such words").count() == 0


@pytest.mark.parametrize("cells", [1, 64, heavy.CELLS])
def test_heavy_messages(spark, cells):
    rows = [("ERROR", f"rare {k}") for k in range(500)] + [("ERROR", f"often {k % 4}") for k in range(40)]
    rows += [("ERROR", None)] * 9 + [("INFO", "info")] * 9 + [("ERROR", "six")] * 6 + [("ERROR", "five")] * 5 + [("ERROR", "")] * 7
    df = spark.createDataFrame(rows, "log_level string, message string")
    assert sorted(tuples(heavy.heavy_messages(df, 5, cells))) == sorted(tuples(rules.frequent_messages(df, 5)))


def test_rare_messages_are_not_shuffled(spark):
    df = spark.range(300_000).selectExpr("'ERROR' AS log_level", "IF(id % 10 = 0, 'often', 'rare ' || id) AS message")
    first, second = heavy._cells(F.col("message"), heavy.CELLS)
    cells = df.select(F.explode(F.array(first, second)).alias("cell")).groupBy("cell").count().filter("count > 5").select("cell")
    left = df.join(cells, first == cells.cell, "left_semi").join(cells, second == cells.cell, "left_semi")
    assert left.filter("message <> 'often'").count() < 100
    assert tuples(heavy.heavy_messages(df)) == [("often", 30_000)]


def test_containment_of_many_patterns(spark):
    draw = random.Random(3)
    texts = ["".join(draw.choice("abé ") for _ in range(draw.choice([0, 1, 3, 40, 700]))) for _ in range(150)] + [None, "a+b (c)"]
    patterns = [t[k : k + draw.choice([1, 2, 9, 12, 13, 300])] for t in texts[:120] if t for k in (0, len(t) // 2)]
    patterns += ["", None, "zzz", "(c)", "a", "a", "absent pattern of length"]
    got = heavy.texts_containing(
        spark.createDataFrame([(t,) for t in texts], "text string"), spark.createDataFrame([(p,) for p in patterns], "pattern string")
    )
    want = {(t, p) for t in texts if t for p in patterns if p and p in t}
    found = tuples(got)
    assert len(found) == len(set(found)) and set(found) == want
    none = spark.createDataFrame([], "pattern string")
    assert heavy.texts_containing(spark.createDataFrame([("x",)], "text string"), none).count() == 0
