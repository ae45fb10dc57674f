"""The whole batch run: ingest, parse and persist once, then reports, summary and alerts from the Parquet table."""

from __future__ import annotations

import argparse
import logging
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from emberlog.config import BATCH, INTERACTIVE, ParseProfile, Thresholds
from emberlog.functions.timestamps import instant
from emberlog.operators.rules import batch_alerts, stamp
from emberlog.plans.parse import parse_logs, parse_logs_interactive
from emberlog.plans.reports import export_all
from emberlog.schema import validate_schema
from emberlog.sinks.alerts import append_alert_lines, append_alerts
from emberlog.sources.csv_logs import read_csv_logs, read_rejects
from emberlog.sources.log_table import read_parsed, write_parsed

log = logging.getLogger(__name__)


def ingest(
    spark: SparkSession, paths: str | list[str], profile: ParseProfile = BATCH, interactive: bool = False
) -> DataFrame:
    """Raw CSV paths to a parsed table, lazily."""
    raw = read_csv_logs(spark, paths, profile)
    if not validate_schema(raw, ["message"]):
        log.warning("there is neither a message nor a content column: %s", raw.columns)
    return parse_logs_interactive(raw, profile) if interactive else parse_logs(raw, profile)


def ingest_interactive(
    spark: SparkSession, paths: str | list[str], profile: ParseProfile = INTERACTIVE
) -> DataFrame:
    return ingest(spark, paths, profile, interactive=True)


@dataclass(frozen=True)
class BatchResult:
    parsed_path: str
    alerts_path: str
    written: list[str]


def run_batch(
    spark: SparkSession,
    paths: str | list[str],
    out: str,
    profile: ParseProfile = BATCH,
    limits: Thresholds = Thresholds(),
    top_n: int = 10,
    at: datetime | None = None,
    username: str | None = None,
) -> BatchResult:
    """Run everything. The raw text is parsed once; all results come from the columnar table. Records that don't fit their file's
    header are found by a second reading and written to ``rejects``."""
    parsed_path, alerts_path = f"{out}/parsed", f"{out}/alerts"
    write_parsed(ingest(spark, paths, profile), parsed_path)
    read_rejects(spark, paths).write.mode("overwrite").parquet(f"{out}/rejects")
    parsed = read_parsed(spark, parsed_path)
    written = export_all(parsed, f"{out}/reports", top_n)
    # The moment is fixed here, so that the lines are those of this run's alerts.
    moment = at or datetime.now(timezone.utc)
    append_alerts(stamp(batch_alerts(parsed, limits), moment, username), alerts_path)
    alerts = spark.read.parquet(alerts_path)
    of_run = alerts.filter((alerts.alert_ts == instant(moment)) & alerts.username.eqNullSafe(username))
    append_alert_lines(of_run.dropDuplicates(["alert_id"]), f"{out}/alert_lines")
    return BatchResult(parsed_path, alerts_path, written)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="emberlog", description="Parse CSV logs and write reports and alerts.")
    parser.add_argument("paths", nargs="+", help="CSV files or directories")
    parser.add_argument("--out", required=True, help="output directory")
    parser.add_argument("--top-n", type=int, default=10)
    parser.add_argument("--default-year", type=int, default=BATCH.default_year)
    args = parser.parse_args(argv)
    spark = (
        SparkSession.builder.appName("emberlog").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    profile = ParseProfile(default_year=args.default_year)
    result = run_batch(spark, args.paths, args.out, profile, top_n=args.top_n)
    for path in (result.parsed_path, result.alerts_path, *result.written):
        print(path)
