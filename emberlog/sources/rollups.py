"""Aggregates of the log table that are kept up to date batch by batch.

``refresh`` reads only the batches it has not seen and writes, per batch and source file, small partial results below
``rollups``: counts per minute, level, type and service; errors per address; first and last time of every error message; and a
sketch of the distinct values of each day. When a file is ingested again, its earlier partials no longer count, so a changed file
costs a reading of its new batch alone. Partials of a batch are one directory, which a repeated run overwrites; it counts
once ``rollups/done`` names it.

The reports have the rows and columns of their namesakes in ``metrics``, in no order; null and empty values count alike. Batches without rows leave no
partials. Reports are exact except ``distinct_between``, whose standard error is about ``1.04 / sqrt(2 ** SKETCH_BITS)``.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.functions.timestamps import bucket
from emberlog.operators.filters import is_error, is_filled
from emberlog.sources.log_table import INGESTED, MANIFEST, as_ingested, read_if_exists

PLACE = "source_file string, batch_id string"
COUNTS = f"minute timestamp, log_level string, severity int, error_type string, service_name string, n long, {PLACE}"
ADDRESSES = f"ip_address string, n long, {PLACE}"
MESSAGES = f"message string, first_seen timestamp, last_seen timestamp, n long, {PLACE}"
SKETCHES = f"date date, ips binary, services binary, error_types binary, {PLACE}"
DONE = "batch_id string"
#: Binary logarithm of the sketches' registers: 4 KB for a file's day, 1.6 % standard error.
SKETCH_BITS = 12


def _partials(rows: DataFrame) -> dict[str, DataFrame]:
    errors = rows.filter(is_error())
    by_message = errors.groupBy("source_file", "message")
    by_address = errors.filter(is_filled("ip_address")).groupBy("source_file", "ip_address")

    def sketch(name: str, condition: Column) -> Column:
        # A letter in front, as a sketch passes over empty texts.
        return F.hll_sketch_agg(F.when(condition, F.concat(F.lit("v"), name)), F.lit(SKETCH_BITS))

    return {
        "counts": rows.groupBy(
            "source_file", F.date_trunc("minute", "timestamp").alias("minute"), "log_level", "severity", "error_type", "service_name"
        ).agg(F.count("*").alias("n")),
        "addresses": by_address.agg(F.count("*").alias("n")),
        "messages": by_message.agg(
            F.min("timestamp").alias("first_seen"), F.max("timestamp").alias("last_seen"), F.count("*").alias("n")
        ),
        "sketches": rows.groupBy("source_file", "date").agg(
            sketch("ip_address", is_filled("ip_address")).alias("ips"),
            sketch("service_name", is_filled("service_name")).alias("services"),
            sketch("error_type", is_error()).alias("error_types"),
        ),
    }


def refresh(spark: SparkSession, base: str) -> list[str]:
    """Partial results of the finished batches that have none yet; the ids of these batches."""
    done = read_if_exists(spark, f"{base}/rollups/done", DONE)
    finished = read_if_exists(spark, f"{base}/manifest", MANIFEST).select("batch_id").distinct()
    fresh = sorted(row.batch_id for row in finished.join(done, "batch_id", "left_anti").toLocalIterator())
    for batch_id in fresh:
        # A reader of one directory: no other batch is listed or read.
        rows = spark.read.schema(INGESTED).parquet(f"{base}/logs/batch_id={batch_id}")
        for name, partial in _partials(rows).items():
            partial.write.mode("overwrite").parquet(f"{base}/rollups/{name}/batch_id={batch_id}")
        spark.createDataFrame([(batch_id,)], DONE).coalesce(1).write.mode("append").parquet(f"{base}/rollups/done")
    return fresh


def read_rollup(spark: SparkSession, base: str, name: str, schema: str) -> DataFrame:
    """The partials of every source file as of its latest batch that has partials."""
    done = sorted(row.batch_id for row in read_if_exists(spark, f"{base}/rollups/done", DONE).distinct().toLocalIterator())
    return as_ingested(spark, base, read_if_exists(spark, f"{base}/rollups/{name}", schema), done)


def _counts(spark: SparkSession, base: str) -> DataFrame:
    return read_rollup(spark, base, "counts", COUNTS)


def _errors_by(spark: SparkSession, base: str, *keys: Column | str, name: str = "error_count") -> DataFrame:
    return _counts(spark, base).filter(is_error()).groupBy(*keys).agg(F.sum("n").alias(name))


def errors_by_type(spark: SparkSession, base: str) -> DataFrame:
    return _errors_by(spark, base, "error_type", name="count")


def errors_by_severity(spark: SparkSession, base: str) -> DataFrame:
    return _errors_by(spark, base, "severity", "log_level", name="count")


def errors_by_hour(spark: SparkSession, base: str) -> DataFrame:
    return _errors_by(spark, base, F.to_date("minute").alias("date"), F.hour("minute").alias("hour"))


def errors_by_day(spark: SparkSession, base: str) -> DataFrame:
    return _errors_by(spark, base, F.to_date("minute").alias("date"))


def errors_per_service(spark: SparkSession, base: str) -> DataFrame:
    return _errors_by(spark, base, "service_name").filter(is_filled("service_name"))


def errors_per_ip(spark: SparkSession, base: str) -> DataFrame:
    return read_rollup(spark, base, "addresses", ADDRESSES).groupBy("ip_address").agg(F.sum("n").alias("error_count"))


def trend(spark: SparkSession, base: str, granularity: str = "hour") -> DataFrame:
    """ERROR and WARN rows per time bucket, buckets without any left out."""
    counts = _counts(spark, base).filter(F.col("log_level").isin("ERROR", "WARN") & F.col("minute").isNotNull())
    return counts.groupBy(bucket(F.col("minute"), granularity).alias("bucket"), "log_level").agg(F.sum("n").alias("count"))


def first_last_seen(spark: SparkSession, base: str) -> DataFrame:
    """First and last occurrence and the count of every error message."""
    return (
        read_rollup(spark, base, "messages", MESSAGES)
        .groupBy("message")
        .agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), F.sum("n").alias("count"))
    )


def distinct_between(spark: SparkSession, base: str, first: date | None = None, last: date | None = None) -> DataFrame:
    """One row: estimated distinct addresses, services and types of errors of the days from ``first`` to ``last``, both included.
    An open end takes all days; without either, rows without a time count too."""
    sketches = read_rollup(spark, base, "sketches", SKETCHES)
    sketches = sketches.filter(F.col("date") >= F.lit(first)) if first else sketches
    sketches = sketches.filter(F.col("date") <= F.lit(last)) if last else sketches
    names = {"ips": "unique_ips", "services": "unique_services", "error_types": "unique_error_types"}
    return sketches.agg(
        *(
            F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(name)), F.lit(0)).alias(shown)
            for name, shown in names.items()
        )
    )
