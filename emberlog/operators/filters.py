"""Row predicates. A whole filter specification becomes one predicate, so Catalyst can push all of it down."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, datetime, time, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.functions.timestamps import instant
from emberlog.schema import project_existing

# Columns a keyword is looked for in, and the choice that means "no filter".
SEARCH_COLUMNS = ("message", "service_name", "log_level")
ALL = "All"


@dataclass(frozen=True)
class SearchFilter:
    """Independent search conditions; an empty or absent one does not restrict."""

    time_range: tuple[datetime, datetime] | None = None
    levels: tuple[str, ...] = ()
    services: tuple[str, ...] = ()


def is_level(level: str) -> Column:
    return F.col("log_level") == level


def is_error() -> Column:
    return is_level("ERROR")


def is_critical_error(severity: int = 3) -> Column:
    """ERROR rows of at least the given severity."""
    return is_error() & (F.col("severity") >= severity)


def is_filled(name: str) -> Column:
    """Neither null nor empty."""
    return F.col(name).isNotNull() & (F.col(name) != "")


def any_of(predicates: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, predicates, F.lit(False))


def all_of(predicates: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, predicates, F.lit(True))


def in_days(columns: Iterable[str], first: date, last: date) -> Column:
    """Rows of whole days, both included. A ``date`` column is tested too, which prunes its partitions."""
    ts = F.col("timestamp")
    after_last = datetime.combine(last + timedelta(days=1), time.min)
    inside = (ts >= instant(datetime.combine(first, time.min))) & (ts < instant(after_last))
    return inside & F.col("date").between(F.lit(first), F.lit(last)) if "date" in columns else inside


def in_time_range(columns: Iterable[str], start: datetime, end: datetime) -> Column:
    """Rows between two instants, both included, with the same partition pruning."""
    inside = F.col("timestamp").between(instant(start), instant(end))
    if "date" not in columns:
        return inside
    return inside & F.col("date").between(F.lit(start.date()), F.lit(end.date()))


def day_time_bounds(
    first: date, last: date | None = None, start: time | None = None, end: time | None = None
) -> tuple[datetime, datetime] | None:
    """Instants for chosen days and optional times of day; None if they run backwards on one day."""
    last = last or first
    start, end = start or time.min, end or time.max
    if first == last and start > end:
        return None
    return datetime.combine(first, start), datetime.combine(last, end)


def has_level(levels: Iterable[str], ignore_case: bool = False) -> Column:
    """Level membership; no levels at all means all of them."""
    levels = list(levels)
    if not levels:
        return F.lit(True)
    if ignore_case:
        return F.upper("log_level").isin([level.upper() for level in levels])
    return F.col("log_level").isin(levels)


def has_service(services: Iterable[str], column: str = "service_name") -> Column:
    """Service membership; no services at all means all of them."""
    services = list(services)
    return F.col(column).isin(services) if services else F.lit(True)


def equals_choice(columns: Iterable[str], choice: str | None) -> Column:
    """Equality with the error type, or with the message where there is no type; ``All`` does not restrict."""
    target = next((name for name in ("error_type", "message") if name in columns), None)
    if not choice or choice == ALL or target is None:
        return F.lit(True)
    return F.col(target) == choice


def has_keyword(columns: Iterable[str], query: str, regex: bool = False) -> Column:
    """A keyword in any searched column, ignoring case; literal unless ``regex``."""
    query = query.strip()
    if not query:
        return F.lit(True)
    searched = [name for name in SEARCH_COLUMNS if name in columns]
    # The flag and not lower-casing: a pattern's \\D is not its \\d.
    hits = [
        F.col(name).rlike(f"(?iu){query}") if regex else F.lower(name).contains(query.lower()) for name in searched
    ]
    return any_of(F.coalesce(hit, F.lit(False)) for hit in hits)


def require(columns: Iterable[str], name: str) -> None:
    """A condition on an absent column is an error; it must not be passed over."""
    if name not in columns:
        raise ValueError(f"there is no column {name!r} to filter by; available: {list(columns)}")


def search_predicate(
    columns: Iterable[str], query: str = "", filters: SearchFilter = SearchFilter(), regex: bool = False
) -> Column:
    """Range, levels, services and keyword as one predicate."""
    columns = list(columns)
    parts = []
    if filters.time_range:
        require(columns, "timestamp")
        parts.append(in_time_range(columns, *filters.time_range))
    if filters.levels:
        require(columns, "log_level")
        parts.append(has_level(filters.levels))
    if filters.services:
        require(columns, "service_name")
        parts.append(has_service(filters.services))
    parts.append(has_keyword(columns, query, regex))
    return all_of(parts)


def search_logs(
    df: DataFrame, query: str = "", filters: SearchFilter = SearchFilter(), regex: bool = False
) -> DataFrame:
    """Rows that meet every search condition."""
    return df.filter(search_predicate(df.columns, query, filters, regex))


def search_counts(
    df: DataFrame, query: str = "", filters: SearchFilter = SearchFilter(), regex: bool = False
) -> DataFrame:
    """One row with the number of matches and of all rows, from one pass."""
    hit = search_predicate(df.columns, query, filters, regex)
    return df.agg(F.count_if(hit).alias("matches"), F.count(F.lit(1)).alias("total"))


def filter_data(
    df: DataFrame,
    days: tuple[date, date] | None = None,
    choice: str | None = None,
    levels: Iterable[str] = (),
    services: Iterable[str] = (),
) -> DataFrame:
    """Dashboard filter: whole days, levels ignoring case, an exact choice and services."""
    levels, services = list(levels), list(services)
    parts = [has_level(levels, ignore_case=True), equals_choice(df.columns, choice)]
    if days:
        require(df.columns, "timestamp")
        parts.append(in_days(df.columns, *days))
    if services:
        require(df.columns, "service_name")
        parts.append(has_service(services))
    return df.filter(all_of(parts))


def filter_errors(df: DataFrame) -> DataFrame:
    return df.filter(is_error())


def error_examples(df: DataFrame, message: str, n: int = 100) -> DataFrame:
    """Newest rows of one error message, display columns only; rows of one instant come in the order of their services."""
    shown = project_existing(
        filter_errors(df).filter(F.col("message") == message), ("timestamp", "log_level", "service_name", "message")
    )
    return shown.orderBy(F.desc("timestamp"), *[name for name in shown.columns if name != "timestamp"]).limit(n)
