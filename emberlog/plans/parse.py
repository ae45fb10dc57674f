"""From raw columns to the canonical log table, as one lazy plan without any action."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from emberlog.config import BATCH, INTERACTIVE, ParseProfile
from emberlog.operators import clean
from emberlog.schema import PARSED, RAW, ensure_columns


def parse_logs(
    df: DataFrame, profile: ParseProfile = BATCH, observation: Observation | None = None
) -> DataFrame:
    """Batch parse: every canonical column, then the pass-through ones."""
    had_message = "message" in df.columns
    df = clean.clean_null_rows(ensure_columns(df, RAW), observation)
    df = clean.normalize_timestamps(df, profile.default_year, profile.extra_layouts)
    df = clean.add_time_parts(df)
    df = clean.standardize_levels(df, profile.default_level, profile.level_aliases)
    df = clean.add_severity(df, profile.severity_map)
    df = clean.add_error_type(df, profile.blank_as_unknown)
    df = clean.add_entities(df, profile.strict_ip)
    df = clean.trim_message(df) if had_message else df.withColumn("message", F.lit(""))
    canonical = PARSED.fieldNames()
    return df.select(*canonical, *[name for name in df.columns if name not in canonical])


def parse_logs_interactive(
    df: DataFrame, profile: ParseProfile = INTERACTIVE, observation: Observation | None = None
) -> DataFrame:
    """Interactive parse: entity names, levels and timestamps, dropping rows whose timestamp does not parse.

    An ``observation`` receives ``rows_seen`` and ``rows_kept`` as a by-product of whichever action runs next.
    """
    df = clean.rename_aliases(df, clean.ENTITY_ALIASES)
    if "timestamp" in df.columns:
        df = clean.normalize_timestamps(df, profile.default_year, profile.extra_layouts)
        if observation is not None:
            seen, kept = F.count(F.lit(1)).alias("rows_seen"), F.count("timestamp").alias("rows_kept")
            df = df.observe(observation, seen, kept)
        df = clean.drop_null_timestamps(df)
    return clean.standardize_levels(df, profile.default_level, profile.level_aliases)
