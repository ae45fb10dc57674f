from __future__ import annotations

import csv
from pathlib import Path

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("emberlog-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def write_csv(tmp_path):
    """Write a CSV file below the test's folder; its path."""

    def write(name: str, header: list[str], *rows: list[str]) -> str:
        path = Path(tmp_path) / name
        path.parent.mkdir(parents=True, exist_ok=True)
        with open(path, "w", newline="") as file:
            csv.writer(file, lineterminator="\n").writerows([header, *rows])
        return str(path)

    return write


HEADER = ["LineId", "Date", "Time", "Level", "Component", "Content"]

# Ten rows: four errors, two warnings, four others.
SAMPLE = [
    ["1", "2026-03-01", "09:00:01", "INFO", "Gate", "session opened for ann"],
    ["2", "2026-03-01", "09:00:30", "warn", "Gate", "slow answer from store"],
    ["3", "2026-03-01", "09:01:02", "ERROR", "Store", "store connection timeout"],
    ["4", "2026-03-01", "09:59:59", " error ", "Store", "disk failed to mount"],
    ["5", "2026-03-01", "10:00:00", "ERROR", "Queue", "QueueFullException while adding"],
    ["6", "2026-03-01", "10:20:00", "INFO", "Queue", "queue drained"],
    ["7", "2026-03-02", "00:00:00", "WARN", "Cache", "cache nearly full"],
    ["8", "2026-03-02", "08:15:00", "ERROR", "Cache", "no route to 10.1.2.3"],
    ["9", "2026-03-02", "08:16:00", "", "Cache", "service: pricing answered GET /v2/prices"],
    ["10", "2026-03-02", "08:17:00", "CRITICAL", "Cache", "heap exhausted"],
]


@pytest.fixture
def sample(spark, write_csv):
    """The parsed sample."""
    from emberlog.plans.batch import ingest

    return ingest(spark, write_csv("sample/log.csv", HEADER, *SAMPLE))


def tuples(df, *columns):
    return [tuple(row) for row in (df.select(*columns) if columns else df).collect()]
