"""Structured Streaming over a drop folder of CSV logs, and over alerts.

Results are written as plain Parquet, one directory per micro-batch. A repeated micro-batch overwrites its own
directory, so a lost executor or a restart cannot count anything twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from emberlog.config import BATCH, ParseProfile
from emberlog.functions.timestamps import window_length
from emberlog.operators.alert_log import key_of, sending_times
from emberlog.operators.filters import filter_errors
from emberlog.operators.metrics import count_rows
from emberlog.plans.parse import parse_logs
from emberlog.sources.csv_logs import (
    file_headers,
    file_states,
    group_by_header,
    list_files,
    path_key,
    read_grouped,
    standard_columns,
)
from emberlog.sources.log_table import read_if_exists

# What Spark's source of whole files yields.
FILES = "path string, modificationTime timestamp, length bigint, content binary"
TRIED = "path string, read boolean"
LAST = "username string, alert_type string, last bigint"


def read_stream(
    spark: SparkSession,
    path: str,
    columns: list[str],
    profile: ParseProfile = BATCH,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Parsed rows of every CSV file that is or will be in the folder; a file with another header fails the stream."""
    schema = T.StructType([T.StructField(name.lower(), T.StringType()) for name in columns])
    reader = spark.readStream.schema(schema).option("header", True).option("quote", '"').option("escape", '"')
    reader = reader.option("enforceSchema", False)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return parse_logs(standard_columns(reader.csv(path), profile), profile)


def windowed_errors(logs: DataFrame, size: str = "1h", lateness: str = "1 day") -> DataFrame:
    """Running error count per tumbling window; windows older than ``lateness`` leave the state."""
    return (
        filter_errors(logs)
        .withWatermark("timestamp", lateness)
        .groupBy(F.window("timestamp", window_length(size)).alias("span"))
        .agg(count_rows().alias("error_count"))
        .select(F.col("span.start").alias("time_window"), "error_count")
    )


def start_error_trends(
    logs: DataFrame, out: str, checkpoint: str, size: str = "1h", lateness: str = "1 day", once: bool = True
) -> StreamingQuery:
    """Keep the trend below ``out`` up to date; ``once`` handles what is there and then ends."""

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    writer = (
        windowed_errors(logs, size, lateness)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )
    return (writer.trigger(availableNow=True) if once else writer).start()


def read_error_trends(spark: SparkSession, out: str) -> DataFrame:
    """The latest count of every window."""
    return (
        spark.read.parquet(out)
        .groupBy("time_window")
        .agg(F.max_by("error_count", "batch").alias("error_count"))
        .orderBy("time_window")
    )


def start_folder_trends(
    spark: SparkSession,
    path: str,
    out: str,
    checkpoint: str,
    size: str = "1h",
    profile: ParseProfile = BATCH,
    max_files_per_trigger: int | None = None,
    once: bool = True,
) -> StreamingQuery:
    """The error trend of a drop folder whose files may have different headers.

    The stream is that of the files' paths; each micro-batch reads its files by their headers, as ingest does, and
    writes their counts per window. ``read_folder_trends`` adds them up.

    A file that is still empty or can't be read yet is not lost, though the stream has seen its path: ``files/batch=n`` lists the
    files of a micro-batch, with the empty ones that the stream passes over, and whether they were read. The next micro-batch tries
    the others again. So does every start, by doing the latest micro-batch once more where one of its files has become readable.
    """

    def count(files: list[str], batch_id: int) -> None:
        groups = group_by_header(spark, files)
        logs = parse_logs(read_grouped(spark, groups, profile), profile)
        span = F.window("timestamp", window_length(size))
        counts = filter_errors(logs).groupBy(span.alias("span")).agg(count_rows().alias("error_count"))
        counts = counts.select(F.col("span.start").alias("time_window"), "error_count")
        counts.write.mode("overwrite").parquet(f"{out}/counts/batch={batch_id}")
        read = {file for group in groups.values() for file in group}
        filled = {path_key(row.path) for row in file_states(spark, path, None, True).select("path").toLocalIterator()}
        empty = [file for file in list_files(spark, path, None, True) if path_key(file) not in filled]
        known = {path_key(file): (file, file in read) for file in [*empty, *files]}
        listed = spark.createDataFrame(sorted(known.values()), TRIED)
        listed.coalesce(1).write.mode("overwrite").parquet(f"{out}/files/batch={batch_id}")

    def tried(batch_id: int) -> DataFrame:
        return read_if_exists(spark, f"{out}/files/batch={batch_id}", TRIED)

    def write(rows: DataFrame, batch_id: int) -> None:
        again = tried(batch_id - 1).filter("NOT read").select("path")
        count(sorted({row.path for row in rows.unionByName(again).toLocalIterator()}), batch_id)

    latest = read_if_exists(spark, f"{out}/files", f"{TRIED}, batch int").agg(F.max("batch")).first()[0]
    if latest is not None:
        waiting = [row.path for row in tried(latest).filter("NOT read").toLocalIterator()]
        if waiting and not file_headers(spark, waiting).isEmpty():
            count(sorted(row.path for row in tried(latest).toLocalIterator()), latest)

    reader = spark.readStream.format("binaryFile").schema(FILES).option("recursiveFileLookup", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    paths = reader.load(path).select(F.col("_metadata.file_path").alias("path"))
    writer = paths.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if once else writer).start()


def read_folder_trends(spark: SparkSession, out: str) -> DataFrame:
    """The count of every window."""
    return (
        spark.read.parquet(f"{out}/counts")
        .groupBy("time_window")
        .agg(F.sum("error_count").alias("error_count"))
        .orderBy("time_window")
    )


def without_repeats(alerts: DataFrame, last: DataFrame, cooldown_s: int = 3600) -> DataFrame:
    """Alerts that are sent, given (username, alert_type, last) in microseconds of what was sent before.

    Per user and alert type, an alert is sent if none was sent less than the cooldown before it; of alerts of one instant
    the one with the least id. No task gathers the alerts of a user and type (see ``sending_times``).
    """
    key = key_of("username", "alert_type").alias("key")
    timed = alerts.withColumns({"_key": key, "_time": F.unix_micros("alert_ts")})
    times = timed.filter("_time IS NOT NULL").select(F.col("_key").alias("key"), F.col("_time").alias("time")).distinct()
    # Only the keys that have alerts are followed.
    known = last.select(key, F.col("last").alias("time")).join(times.select("key").distinct(), "key", "left_semi")
    sent = sending_times(times, cooldown_s * 1_000_000, known).withColumnsRenamed({"key": "_key", "time": "_time"})
    chosen = timed.join(sent, ["_key", "_time"]).groupBy("_key", "_time").agg(F.min_by(F.struct(*alerts.columns), "alert_id").alias("a"))
    return chosen.select("a.*")


def start_alert_dedup(
    alerts: DataFrame,
    out: str,
    checkpoint: str,
    cooldown_s: int = 3600,
    lateness_s: int = 0,
    once: bool = True,
) -> StreamingQuery:
    """Write the alerts of a stream that are not repeats within the cooldown below ``out/sent``.

    Alerts may arrive out of order by up to ``lateness_s``: an alert is held until the watermark, the latest time seen less
    ``lateness_s``, has reached it, so the same alerts are sent however they arrive and are cut into micro-batches. An alert behind
    the watermark of an earlier micro-batch can't be judged any more; it is kept in ``out/late``. ``release_held`` ends the waiting.

    The state is in tables, one directory for each micro-batch n: ``out/held`` (alerts), ``out/last`` (the last sending of every user
    and type), ``out/seen`` (the watermark). A repeated micro-batch begins from those of n - 1.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        _dedup_batch(rows, out, batch_id, cooldown_s, lateness_s)

    writer = alerts.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if once else writer).start()


def _dedup_batch(rows: DataFrame, out: str, batch_id: int, cooldown_s: int, lateness_s: int | None) -> None:
    """One micro-batch of ``start_alert_dedup``; a lateness of None releases what is held."""
    spark = rows.sparkSession

    def before(table: str, schema) -> DataFrame:
        return read_if_exists(spark, f"{out}/{table}/batch={batch_id - 1}", schema)

    def put(df: DataFrame, table: str) -> None:
        df.write.mode("overwrite").parquet(f"{out}/{table}/batch={batch_id}")

    time = F.unix_micros("alert_ts")
    passed = before("seen", "watermark bigint").agg(F.max("watermark")).first()[0]
    on_time = rows if passed is None else rows.filter(time > passed)
    put(rows.filter("false") if passed is None else rows.filter(time <= passed), "late")
    waiting = before("held", rows.schema).unionByName(on_time)
    latest = waiting.agg(F.max(time)).first()[0]
    known = [mark for mark in (passed, None if latest is None else latest - (lateness_s or 0) * 1_000_000) if mark is not None]
    watermark = max(known, default=None)
    ready = waiting.filter(F.lit(False) if watermark is None else time <= watermark)
    last = before("last", LAST)
    put(without_repeats(ready, last, cooldown_s), "sent")
    sent = spark.read.schema(rows.schema).parquet(f"{out}/sent/batch={batch_id}")
    newest = last.unionByName(sent.select("username", "alert_type", time.alias("last")))
    put(newest.groupBy("username", "alert_type").agg(F.max("last").alias("last")), "last")
    put(waiting.filter(F.lit(True) if watermark is None else time > watermark), "held")
    put(spark.createDataFrame([(watermark,)], "watermark bigint").coalesce(1), "seen")


def release_held(spark: SparkSession, out: str, schema: T.StructType, cooldown_s: int = 3600) -> None:
    """Judge what a stopped ``start_alert_dedup`` still holds, as if no earlier alert could arrive any more.

    The results take the place of the next micro-batch; a stream that goes on afterwards needs a fresh ``out``.
    """
    latest = read_if_exists(spark, f"{out}/seen", "watermark bigint, batch int").agg(F.max("batch")).first()[0]
    if latest is not None:
        _dedup_batch(spark.createDataFrame([], schema), out, latest + 1, cooldown_s, None)


def read_sent_alerts(spark: SparkSession, out: str) -> DataFrame:
    """All alerts that were sent."""
    return spark.read.parquet(f"{out}/sent").drop("batch")


def read_late_alerts(spark: SparkSession, out: str) -> DataFrame:
    """Alerts that came after their time had been passed by more than the lateness."""
    return spark.read.parquet(f"{out}/late").drop("batch")
