"""Analysis history: one row per analysis, and its rows as a Parquet snapshot or as the batches of the log table that it saw.

Batches of the log table are never changed, so a list of them is a snapshot without a copy. They must be kept as long as
a record names them.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.functions.timestamps import instant
from emberlog.operators.filters import is_error, is_level
from emberlog.schema import HISTORY
from emberlog.sources.log_table import INGESTED, finished_batches, read_if_exists, read_ingested, read_parsed, write_parsed

SEEN = "record_id string, batch_id string"


def display_name(files: Sequence[str]) -> str:
    """Label for a set of files. Up to two names are listed, at most 50 characters shown."""
    label = ", ".join(files) if len(files) < 3 else f"{len(files)} files"
    return label if len(label) <= 50 else label[:47] + "..."


def history_row(
    snapshot: DataFrame, record_id: str, username: str, file_name: str, data_path: str, at: datetime
) -> DataFrame:
    """The one history row of a snapshot, counted in one pass."""
    return snapshot.agg(
        F.count_if(is_error()).alias("num_errors"), F.count_if(is_level("WARN")).alias("num_warnings")
    ).select(
        F.lit(record_id).alias("record_id"),
        F.lit(username).alias("username"),
        instant(at).alias("analysis_ts"),
        F.lit(file_name).alias("file_name"),
        "num_errors",
        "num_warnings",
        F.lit(data_path).alias("data_path"),
    )


def record_analysis(
    df: DataFrame, base: str, username: str, files: Sequence[str], at: datetime | None = None
) -> str:
    """Write a snapshot and append its history row, counted from the snapshot; the record's id."""
    spark = df.sparkSession
    record_id = uuid.uuid4().hex
    data_path = f"{base}/snapshots/{record_id}"
    if "date" in df.columns and dict(df.dtypes)["date"] == "date":
        write_parsed(df, data_path)
    else:
        df.write.parquet(data_path)
    row = history_row(
        spark.read.parquet(data_path),
        record_id,
        username,
        display_name(files),
        data_path,
        at or datetime.now(timezone.utc),
    )
    row.coalesce(1).write.mode("append").parquet(f"{base}/history")
    return record_id


def record_ingested(
    spark: SparkSession, base: str, table: str, username: str, files: Sequence[str], at: datetime | None = None
) -> str:
    """Append the history row of the log table ``table`` as it is now, and name the finished batches it is made of; the record's
    id. No rows are copied; the counts read the level column alone."""
    record_id, batches = uuid.uuid4().hex, finished_batches(spark, table)
    seen = spark.createDataFrame([(record_id, batch_id) for batch_id in batches], SEEN)
    seen.coalesce(1).write.mode("append").parquet(f"{base}/seen")
    rows = read_ingested(spark, table, batches=batches) if batches else spark.createDataFrame([], "log_level string")
    when = at or datetime.now(timezone.utc)
    row = history_row(rows, record_id, username, display_name(files), table, when)
    row.coalesce(1).write.mode("append").parquet(f"{base}/history")
    return record_id


def read_history(spark: SparkSession, base: str) -> DataFrame:
    """The history table, empty where there is none yet."""
    return read_if_exists(spark, f"{base}/history", HISTORY)


def load_snapshot(spark: SparkSession, base: str, record_id: str) -> DataFrame | None:
    """The rows of a recorded analysis, None for an unknown record."""
    found = read_history(spark, base).filter(F.col("record_id") == record_id).select("data_path").first()
    if found is None:
        return None
    if found.data_path == f"{base}/snapshots/{record_id}":
        return read_parsed(spark, found.data_path)
    seen = read_if_exists(spark, f"{base}/seen", SEEN).filter(F.col("record_id") == record_id)
    batches = sorted(row.batch_id for row in seen.select("batch_id").toLocalIterator())
    return read_ingested(spark, found.data_path, batches=batches) if batches else spark.createDataFrame([], INGESTED)
