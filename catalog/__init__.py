"""The registered queries: each operator on the test tables, with the SQL that must give the same rows."""

from catalog import aggregates, alerts, cleaning, filtering, reports, sources, streams  # noqa: F401
from catalog.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
