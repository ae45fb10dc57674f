"""Table schemas and column checks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW = T.StructType([T.StructField(name, T.StringType()) for name in ("timestamp", "log_level", "message")])

PARSED = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("log_level", T.StringType()),
        T.StructField("severity", T.IntegerType()),
        T.StructField("message", T.StringType()),
        T.StructField("error_type", T.StringType()),
        T.StructField("ip_address", T.StringType()),
        T.StructField("service_name", T.StringType()),
        T.StructField("endpoint_path", T.StringType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("day", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("date", T.DateType()),
    ]
)

ALERTS = T.StructType(
    [
        T.StructField("alert_id", T.StringType()),
        T.StructField("alert_ts", T.TimestampType()),
        T.StructField("username", T.StringType()),
        T.StructField("alert_type", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("details", T.StringType()),
        T.StructField("metrics", T.MapType(T.StringType(), T.StringType())),
    ]
)

HISTORY = T.StructType(
    [
        T.StructField("record_id", T.StringType()),
        T.StructField("username", T.StringType()),
        T.StructField("analysis_ts", T.TimestampType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("num_errors", T.LongType()),
        T.StructField("num_warnings", T.LongType()),
        T.StructField("data_path", T.StringType()),
    ]
)


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    """Required columns that ``df`` lacks, compared case-insensitively."""
    present = {name.lower() for name in df.columns}
    return [name for name in required if name.lower() not in present]


def validate_schema(df: DataFrame, required: Iterable[str], strict: bool = False) -> bool:
    """Whether all required columns are there; ``strict`` raises and names the absent ones."""
    absent = missing_columns(df, required)
    if absent and strict:
        raise ValueError(f"missing columns {absent}; available: {df.columns}")
    return not absent


def ensure_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add every absent column of ``schema`` as a typed null."""
    absent = set(missing_columns(df, schema.fieldNames()))
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in schema if f.name in absent})


def project_existing(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[name for name in wanted if name in df.columns])
