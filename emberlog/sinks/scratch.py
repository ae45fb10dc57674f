"""Tables that a job writes for itself on storage that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, or else the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch"
    return f"{base.rstrip('/')}/emberlog-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The rows written as a table and read from it, so that loops don't grow their plans and lost executors cost no recomputing."""
    folder = shared_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
