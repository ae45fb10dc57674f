"""Log levels and severities as Column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from emberlog.config import OTHER_SEVERITY, SEVERITY


def map_values(value: Column, mapping: Mapping[str, object], otherwise: Column) -> Column:
    """A small literal lookup, kept inside code generation."""
    result = None
    for key, mapped in mapping.items():
        hit = value == key
        result = F.when(hit, F.lit(mapped)) if result is None else result.when(hit, F.lit(mapped))
    return otherwise if result is None else result.otherwise(otherwise)


def normalize_level(value: Column, default: str = "INFO", aliases: Mapping[str, str] | None = None) -> Column:
    """Upper-cased, trimmed level; null becomes ``default`` and known aliases are unified."""
    level = F.coalesce(F.trim(F.upper(value)), F.lit(default))
    return map_values(level, aliases or {}, level)


def severity_of(level: Column, severities: Mapping[str, int] = SEVERITY) -> Column:
    """Numeric severity of a normalised level."""
    return map_values(level, severities, F.lit(OTHER_SEVERITY)).cast("int")
