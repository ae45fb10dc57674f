"""Row cleaning and column derivation, one step per function."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlog.config import SEVERITY
from emberlog.functions import levels, text, timestamps
from emberlog.schema import RAW, ensure_columns

# Alternative column names.
ALIASES = {"level": "log_level", "content": "message", "eventtemplate": "error_type"}
ENTITY_ALIASES = {"ip": "ip_address", "service": "service_name", "endpoint": "endpoint_path"}


def lower_columns(df: DataFrame) -> DataFrame:
    """All column names in lower case."""
    return df.toDF(*[name.lower() for name in df.columns])


def unique_names(names: list[str]) -> list[str | None]:
    """Lower-cased names with ``None`` in place of every repeated one, so that the first of a name is kept."""
    lowered = [name.strip().lower() for name in names]
    return [name if name not in lowered[:i] else None for i, name in enumerate(lowered)]


def drop_duplicate_columns(df: DataFrame) -> DataFrame:
    """Lower-cased columns, keeping the first of every name."""
    names = unique_names(df.columns)
    kept = [name for name in names if name is not None]
    positional = df.toDF(*[f"_{i}" for i in range(len(names))])
    chosen = [F.col(f"_{i}").alias(name) for i, name in enumerate(names) if name is not None]
    return positional.select(*chosen) if len(kept) < len(names) else df.toDF(*kept)


def rename_aliases(df: DataFrame, aliases: Mapping[str, str] = ALIASES) -> DataFrame:
    """Give aliased columns their canonical name unless that name is already taken."""
    wanted = {old: new for old, new in aliases.items() if old in df.columns and new not in df.columns}
    return df.withColumnsRenamed(wanted)


def assemble_timestamp(df: DataFrame, strip_brackets: bool = False) -> DataFrame:
    """Add a text ``timestamp`` built from month/date/time or date/time where there is none."""
    has = set(df.columns)
    if "timestamp" in has or not {"date", "time"} <= has:
        return df
    if "month" in has:
        joined = timestamps.join_month_day_time(F.col("month"), F.col("date"), F.col("time"))
    else:
        joined = timestamps.join_date_time(F.col("date"), F.col("time"), strip_brackets)
    return df.withColumn("timestamp", joined)


def usable_row() -> Column:
    """Row test: a timestamp or a non-blank message is there."""
    return F.col("timestamp").isNotNull() | F.coalesce(F.trim("message") != "", F.lit(False))


def clean_null_rows(df: DataFrame, observation: Observation | None = None) -> DataFrame:
    """Drop rows with neither a timestamp nor message text.

    An ``observation`` receives ``rows_seen`` and ``rows_kept`` as a by-product of whichever action runs next.
    """
    df = ensure_columns(df, RAW)
    if observation is not None:
        df = df.observe(
            observation,
            F.count(F.lit(1)).alias("rows_seen"),
            F.count_if(usable_row()).alias("rows_kept"),
        )
    return df.filter(usable_row())


def normalize_timestamps(df: DataFrame, default_year: int = 2025, extra_layouts: bool = False) -> DataFrame:
    """Parse a text ``timestamp``; a column that is a timestamp already is left alone."""
    if isinstance(df.schema["timestamp"].dataType, T.StringType):
        parsed = timestamps.parse_timestamp(F.col("timestamp"), default_year, extra_layouts)
        return df.withColumn("timestamp", parsed)
    return df.withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def add_time_parts(df: DataFrame) -> DataFrame:
    """Hour, day, month, year and date of the timestamp, replacing raw columns of these names."""
    return df.withColumns(timestamps.time_parts(F.col("timestamp")))


def drop_null_timestamps(df: DataFrame) -> DataFrame:
    """Only rows with a timestamp."""
    return df.dropna(subset=["timestamp"])


def standardize_levels(
    df: DataFrame, default: str = "INFO", aliases: Mapping[str, str] | None = None
) -> DataFrame:
    """Normalised ``log_level``, added when absent."""
    df = ensure_columns(df, T.StructType([T.StructField("log_level", T.StringType())]))
    return df.withColumn("log_level", levels.normalize_level(F.col("log_level"), default, aliases))


def add_severity(df: DataFrame, severities: Mapping[str, int] = SEVERITY) -> DataFrame:
    """Numeric ``severity`` of the level."""
    return df.withColumn("severity", levels.severity_of(F.col("log_level"), severities))


def add_error_type(df: DataFrame, blank_as_unknown: bool = False) -> DataFrame:
    """``error_type``: the ingested one where not blank, else derived from the message."""
    given = F.col("error_type") if "error_type" in df.columns else None
    return df.withColumn("error_type", text.error_type_of(F.col("message"), given, blank_as_unknown))


def add_entities(df: DataFrame, strict_ip: bool = False) -> DataFrame:
    """``ip_address``, ``service_name`` and ``endpoint_path``: existing, renamed, or read from the message."""
    df = rename_aliases(df, ENTITY_ALIASES)
    message = F.col("message")
    derived = {
        "ip_address": text.ip_address_of(message, strict_ip),
        "service_name": text.service_of(message),
        "endpoint_path": text.endpoint_of(message),
    }
    return df.withColumns({name: column for name, column in derived.items() if name not in df.columns})


def trim_message(df: DataFrame) -> DataFrame:
    """Trimmed ``message``; an absent column becomes ``''``."""
    if "message" not in df.columns:
        return df.withColumn("message", F.lit(""))
    return df.withColumn("message", F.trim("message"))
