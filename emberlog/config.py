"""Settings, as frozen dataclasses that are passed explicitly."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from types import MappingProxyType

# Severity per level; any other level gets OTHER_SEVERITY.
SEVERITY = MappingProxyType({"ERROR": 3, "WARN": 2, "INFO": 1, "DEBUG": 0})
OTHER_SEVERITY = 1

# Levels that are always offered in a level picker.
STANDARD_LEVELS = ("DEBUG", "ERROR", "INFO", "WARN")

# Columns shown for a search hit or a report's detail rows.
DISPLAY_COLUMNS = ("timestamp", "log_level", "service_name", "message")
DETAIL_COLUMNS = ("timestamp", "log_level", "service_name", "error_type", "message")


@dataclass(frozen=True)
class ParseProfile:
    """How raw columns become canonical ones.

    ``BATCH`` and ``INTERACTIVE`` are the two stock profiles; ``dataclasses.replace`` makes variants.
    """

    default_level: str = "INFO"
    level_aliases: Mapping[str, str] = field(default_factory=dict)
    severity_map: Mapping[str, int] = field(default_factory=lambda: dict(SEVERITY))
    default_year: int = 2025
    strip_brackets: bool = False
    extra_layouts: bool = False
    blank_as_unknown: bool = False
    strict_ip: bool = False


# Defaults and aliases of the two profiles.
BATCH = ParseProfile()
INTERACTIVE = ParseProfile(
    default_level="UNKNOWN",
    level_aliases={"WARNING": "WARN", "COMBO": "INFO"},
    strip_brackets=True,
    extra_layouts=True,
)


@dataclass(frozen=True)
class Thresholds:
    """Alert limits. The stock limits of every rule."""

    error_rate: float = 0.1
    error_count: int = 100
    critical_count: int = 5
    error_rate_pct: float = 10
    critical_rate_pct: float = 10
    frequent_count: int = 5
    frequent_listed: int = 10
    top_listed: int = 20
    burst_count: int = 20
    burst_window_s: int = 3600
    cooldown_s: int = 3600
