"""Predicates and searches."""

from __future__ import annotations

from datetime import date, datetime, time

from pyspark.sql import functions as F

from catalog.registry import Inputs, register
from emberlog.operators import filters, metrics
from emberlog.operators.filters import SearchFilter
from emberlog.plans.parse import parse_logs_interactive

SHOWN = ("event_id", "timestamp", "log_level", "message")
SHOWN_SQL = 'event_id, "timestamp", log_level, message'


@register("filter_errors", f"SELECT {SHOWN_SQL} FROM errors")
def _(t: Inputs):
    return filters.filter_errors(t.logs).select(*SHOWN)


@register("filter_critical", "SELECT event_id, severity FROM errors WHERE severity >= 3")
def _(t: Inputs):
    return t.logs.filter(filters.is_critical_error()).select("event_id", "severity")


@register(
    "filter_date_range",
    f"""SELECT {SHOWN_SQL} FROM parsed WHERE "timestamp" >= '2024-01-05' AND "timestamp" < '2024-01-13'""",
)
def _(t: Inputs):
    return t.logs.filter(filters.in_days(t.logs.columns, date(2024, 1, 5), date(2024, 1, 12))).select(*SHOWN)


@register(
    "search_time_range",
    f"""SELECT {SHOWN_SQL} FROM parsed
        WHERE "timestamp" BETWEEN '2024-01-10 06:00:00' AND '2024-01-12 23:59:59.999999'""",
)
def _(t: Inputs):
    bounds = filters.day_time_bounds(date(2024, 1, 10), date(2024, 1, 12), start=time(6))
    return filters.search_logs(t.logs, filters=SearchFilter(time_range=bounds)).select(*SHOWN)


@register("filter_levels", f"SELECT {SHOWN_SQL} FROM parsed WHERE log_level IN ('WARN', 'CRITICAL')")
def _(t: Inputs):
    return t.logs.filter(filters.has_level(["warn", "Critical"], ignore_case=True)).select(*SHOWN)


@register(
    "filter_services",
    "SELECT event_id, service_name FROM parsed WHERE service_name IN ('svc-1', 'svc-4')",
)
def _(t: Inputs):
    return t.logs.filter(filters.has_service(["svc-1", "svc-4"])).select("event_id", "service_name")


@register("filter_exact", "SELECT event_id, error_type FROM parsed WHERE error_type = 'TimeoutError'")
def _(t: Inputs):
    return t.logs.filter(filters.equals_choice(t.logs.columns, "TimeoutError")).select("event_id", "error_type")


KEYWORD = """(contains(lower(message), 'svc-3') OR contains(lower(service_name), 'svc-3')
              OR contains(lower(log_level), 'svc-3'))"""


@register("search_keyword", f"SELECT {SHOWN_SQL} FROM parsed WHERE {KEYWORD}")
def _(t: Inputs):
    return filters.search_logs(t.logs, " SVC-3 ").select(*SHOWN)


# A class in capitals is the opposite of the same letter in lower case.
@register("search_regex", f"SELECT {SHOWN_SQL} FROM parsed WHERE regexp_matches(message, '(?i)TIME ?out\\D+[0-9]')")
def _(t: Inputs):
    return filters.search_logs(t.logs, r"TIME ?out\D+[0-9]", regex=True).select(*SHOWN)


def interactive(t: Inputs):
    """The log table as the interactive profile reads it, with a service column."""
    raw = t.rows.select(
        "event_id", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"), "log_level", "message",
        F.col("service_name").alias("service"),
    )
    return parse_logs_interactive(raw)


@register(
    "search_logs_interactive",
    f"""SELECT {SHOWN_SQL}, service_name FROM logs WHERE service_name IN ('svc-1', 'svc-4')
        AND (contains(lower(message), 'svc-4') OR contains(lower(service_name), 'svc-4'))""",
)
def _(t: Inputs):
    found = filters.search_logs(interactive(t), "SVC-4", SearchFilter(services=("svc-1", "svc-4")))
    return found.select(*SHOWN, "service_name")


@register(
    "service_values_interactive",
    "SELECT DISTINCT service_name FROM logs WHERE service_name IS NOT NULL",
)
def _(t: Inputs):
    return metrics.service_values(interactive(t))


SEARCH = SearchFilter(
    time_range=(datetime(2024, 1, 3), datetime(2024, 1, 20, 12)),
    levels=("ERROR", "WARN"),
    services=("svc-0", "svc-2", "svc-5"),
)
SEARCH_SQL = """"timestamp" BETWEEN '2024-01-03' AND '2024-01-20 12:00:00' AND log_level IN ('ERROR', 'WARN')
    AND service_name IN ('svc-0', 'svc-2', 'svc-5') AND contains(lower(message), 'timeout')"""


@register("search_logs", f"SELECT {SHOWN_SQL} FROM parsed WHERE {SEARCH_SQL}")
def _(t: Inputs):
    return filters.search_logs(t.logs, "timeout", SEARCH).select(*SHOWN)


@register(
    "search_counts",
    f"SELECT count(*) FILTER ({SEARCH_SQL}) AS matches, count(*) AS total FROM parsed",
)
def _(t: Inputs):
    return filters.search_counts(t.logs, "timeout", SEARCH)


@register(
    "filter_data",
    f"""SELECT {SHOWN_SQL} FROM parsed WHERE "timestamp" >= '2024-01-02' AND "timestamp" < '2024-01-21'
        AND log_level IN ('ERROR', 'INFO') AND error_type = 'NotFoundError' AND service_name IN ('svc-1', 'svc-2')""",
)
def _(t: Inputs):
    days = (date(2024, 1, 2), date(2024, 1, 20))
    return filters.filter_data(t.logs, days, "NotFoundError", ("error", "info"), ("svc-1", "svc-2")).select(*SHOWN)


@register(
    "error_examples",
    """SELECT "timestamp", log_level, service_name, message FROM errors WHERE message = 'page not found'
       ORDER BY "timestamp" DESC, log_level, service_name LIMIT 100""",
)
def _(t: Inputs):
    return filters.error_examples(t.logs, "page not found")


@register(
    "project_display",
    'SELECT "timestamp", log_level, service_name, message FROM parsed',
)
def _(t: Inputs):
    from emberlog.config import DISPLAY_COLUMNS
    from emberlog.schema import project_existing

    return project_existing(t.logs, (*DISPLAY_COLUMNS, "absent"))


@register(
    "documents_with_ip",
    r"""SELECT doc_id, regexp_extract(text, '\b(?:\d{1,3}\.){3}\d{1,3}\b', 0) AS ip_address FROM documents
        WHERE regexp_matches(text, '\b(?:\d{1,3}\.){3}\d{1,3}\b')""",
)
def _(t: Inputs):
    from emberlog.operators.clean import add_entities

    documents = t.spark.read.parquet(f"{t.sf_dir}/documents.parquet")
    found = add_entities(documents.select("doc_id", F.col("text").alias("message")))
    return found.filter(filters.is_filled("ip_address")).select("doc_id", "ip_address")
