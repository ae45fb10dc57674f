"""The parsed log table on disk, and incremental ingest into it.

Layout below a base directory:

* ``logs/batch_id=…/date=…`` — parsed rows. Inside a file rows are ordered by level, so that a query on errors
  skips most row groups by their statistics.
* ``manifest`` — one small row per source file that was read. A batch counts as soon as its manifest rows are there;
  what a batch that died half way has left behind is never read. A file that was skipped as empty or unreadable has no
  row, so the next run tries it again.
* ``rejects/batch_id=…`` — records that don't fit the header of their file, with their text.
* ``superseded`` — (source_file, batch_id, by_batch) of files that changed and were ingested again: rows of the earlier
  batch no longer count once the later one does.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from emberlog.config import BATCH, ParseProfile
from emberlog.plans.parse import parse_logs
from emberlog.schema import PARSED
from emberlog.sources.csv_logs import (
    REJECTS,
    file_states,
    group_by_header,
    read_grouped,
    rejects_of_groups,
    same_file_key,
)

FILE = "path string, modified timestamp, bytes long"
MANIFEST = f"{FILE}, batch_id string, ingested timestamp"
FILE_COLUMNS = ["path", "modified", "bytes"]
SUPERSEDED = "source_file string, batch_id string, by_batch string"
INGESTED = T.StructType(
    [*PARSED.fields, T.StructField("source_file", T.StringType()), T.StructField("batch_id", T.StringType())]
)


def write_parsed(df: DataFrame, path: str, mode: str = "overwrite", rebalance: bool = True) -> None:
    """Write parsed logs partitioned by date and ordered by level inside files.

    ``rebalance`` evens out file sizes: small dates share a task, a hot date is split over many. Switch it off when
    the input already comes in date order.
    """
    balanced = df.hint("rebalance", "date") if rebalance else df
    ordered = balanced.sortWithinPartitions("date", "log_level", "timestamp")
    ordered.write.mode(mode).partitionBy("date").parquet(path)


def read_parsed(spark: SparkSession, path: str) -> DataFrame:
    """A parsed table as written, canonical columns first; absent ones are null."""
    df = spark.read.parquet(path)
    canonical = [name for name in PARSED.fieldNames() if name in df.columns]
    return df.select(*canonical, *[name for name in df.columns if name not in canonical])


def read_if_exists(spark: SparkSession, path: str, schema) -> DataFrame:
    """A Parquet table, or an empty one of the given schema where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def new_files(spark: SparkSession, base: str, paths: str | list[str], glob: str | None = "*.csv") -> DataFrame:
    """Source files (path, modified, bytes) that are not in the manifest with their present time and length."""
    manifest = read_if_exists(spark, f"{base}/manifest", MANIFEST).select(*FILE_COLUMNS)
    # A state that is unknown matches nothing, so such a file is read again rather than never.
    return file_states(spark, paths, glob).join(manifest, FILE_COLUMNS, "left_anti")


def ingest_new(
    spark: SparkSession,
    base: str,
    paths: str | list[str],
    profile: ParseProfile = BATCH,
    glob: str | None = "*.csv",
) -> str | None:
    """Parse the files not yet ingested into a new batch; its id, or None if there was nothing to read."""
    fresh = {row.path: row for row in new_files(spark, base, paths, glob).toLocalIterator()}
    groups = group_by_header(spark, sorted(fresh))
    read = [fresh[path] for files in groups.values() for path in files]
    if not read:
        return None
    batch_id = f"b{uuid.uuid4().hex}"
    raw = read_grouped(spark, groups, profile, keep_path=True)
    write_parsed(parse_logs(raw, profile), f"{base}/logs/batch_id={batch_id}", mode="errorifexists")
    rejects_of_groups(spark, groups).write.mode("errorifexists").parquet(f"{base}/rejects/batch_id={batch_id}")
    rows = spark.createDataFrame(read, FILE)
    earlier = read_if_exists(spark, f"{base}/manifest", MANIFEST).join(rows.select("path"), "path", "left_semi")
    replaced = earlier.select(same_file_key(F.col("path")).alias("source_file"), "batch_id", F.lit(batch_id).alias("by_batch"))
    if not replaced.isEmpty():
        replaced.distinct().write.mode("append").parquet(f"{base}/superseded")
    rows = rows.withColumns({"batch_id": F.lit(batch_id), "ingested": F.current_timestamp()})
    rows.coalesce(1).write.mode("append").parquet(f"{base}/manifest")
    return batch_id


def finished_batches(spark: SparkSession, base: str) -> list[str]:
    manifest = read_if_exists(spark, f"{base}/manifest", MANIFEST)
    return sorted(row.batch_id for row in manifest.select("batch_id").distinct().toLocalIterator())


def as_ingested(spark: SparkSession, base: str, rows: DataFrame, batches: list[str] | None = None) -> DataFrame:
    """Rows with (source_file, batch_id) that belong to the latest finished batch of their file; ``batches`` are all that count."""
    finished = finished_batches(spark, base) if batches is None else batches
    rows = rows.filter(F.col("batch_id").isin(finished))
    replaced = read_if_exists(spark, f"{base}/superseded", SUPERSEDED).filter(F.col("by_batch").isin(finished))
    if replaced.isEmpty():
        return rows
    return rows.join(replaced.select("source_file", "batch_id").distinct(), ["source_file", "batch_id"], "left_anti")


def read_ingested(
    spark: SparkSession, base: str, extra_columns: bool = False, batches: list[str] | None = None
) -> DataFrame:
    """Rows of every source file as of its latest finished batch.

    Batches are picked by their directories. Only where files have been superseded are their rows taken out by a join.
    The canonical columns are read by their known schema. ``extra_columns`` adds the pass-through columns of all
    batches, which means looking at the schema of every file first. ``batches`` gives the table as it was when those were
    the finished ones.
    """
    reader = spark.read
    if extra_columns:
        rows = reader.option("mergeSchema", True).parquet(f"{base}/logs")
    else:
        rows = reader.schema(INGESTED).parquet(f"{base}/logs")
    return as_ingested(spark, base, rows, batches)


def read_ingested_rejects(spark: SparkSession, base: str) -> DataFrame:
    """The rejects of every source file as of its latest finished batch."""
    return as_ingested(spark, base, read_if_exists(spark, f"{base}/rejects", f"{REJECTS}, batch_id string"))
