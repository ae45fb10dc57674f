"""Facts read out of message text as Column expressions.

Case-insensitive words are looked for in the lower-cased message, and the patterns are only tried on messages that
hold what they need: a plain substring search costs a fraction of a regular expression, and most messages have no hit.
The searched text is never null, which keeps the generated code of the many tests small enough to be compiled.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that mark a message as naming its own error class, and the class token itself. A match can
# only begin where a run of word characters begins; saying so keeps the search linear on very long tokens.
SELF_NAMED = ("exception", "error", "failed", "failure")
CLASS_TOKEN = r"(?i)(?<!\w)(\w+Exception|\w+Error|\w+Failure)"

# Ordered rules for every other message; the first hit names the type. "connect" is part of
# "connection", and "auth" of "authentication" and "unauthorized".
ERROR_TYPE_RULES = (
    (("timeout", "time out"), "TimeoutError"),
    (("connect",), "ConnectionError"),
    (("auth",), "AuthenticationError"),
    (("not found", "404"), "NotFoundError"),
    (("permission", "forbidden", "403"), "PermissionError"),
)
UNKNOWN_TYPE = "UnknownError"

# Patterns for addresses, services and endpoints.
IP = r"\b(?:\d{1,3}\.){3}\d{1,3}\b"
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
STRICT_IP = rf"(?<![\d.])(?:{OCTET}\.){{3}}{OCTET}(?![\d.])"
SERVICE = r"(?i)(service|api|endpoint)[:\s]+([\w/-]+)"
SERVICE_WORDS = ("service", "api", "endpoint")
ENDPOINT = r"(GET|POST|PUT|DELETE|PATCH)\s+([/\w-]+)"
VERBS = ("GET", "POST", "PUT", "DELETE", "PATCH")


def _filled(message: Column) -> Column:
    return F.coalesce(message, F.lit(""))


def _has_any(text: Column, words: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(word)) for word in words])


def _extract_where(may_match: Column, message: Column, pattern: str, group: int) -> Column:
    """``regexp_extract``, saving the search where it cannot match; null for a null message."""
    return F.when(message.isNotNull() & ~may_match, F.lit("")).otherwise(F.regexp_extract(message, pattern, group))


def error_type_of(message: Column, given: Column | None = None, blank_as_unknown: bool = False) -> Column:
    """The given type where it is not blank, otherwise a type derived from the message.

    A message that speaks of an error without a class-like token has the type ``''``; ``blank_as_unknown`` turns
    that into ``UnknownError``.
    """
    lowered = F.lower(_filled(message))
    token = F.regexp_extract(message, CLASS_TOKEN, 1)
    if blank_as_unknown:
        token = F.coalesce(F.nullif(token, F.lit("")), F.lit(UNKNOWN_TYPE))
    derived = F.when(_has_any(lowered, SELF_NAMED), token)
    for words, name in ERROR_TYPE_RULES:
        derived = derived.when(_has_any(lowered, words), F.lit(name))
    derived = derived.otherwise(F.lit(UNKNOWN_TYPE))
    if given is None:
        return derived
    return F.coalesce(F.nullif(F.trim(given), F.lit("")), derived)


def ip_address_of(message: Column, strict: bool = False) -> Column:
    """First IPv4-looking token, ``''`` if there is none; ``strict`` bounds the octets."""
    return _extract_where(F.contains(_filled(message), F.lit(".")), message, STRICT_IP if strict else IP, 0)


def service_of(message: Column, pattern: str | None = None) -> Column:
    """The word after "service", "api" or "endpoint", or group 2 of an own pattern; ``''`` if there is none."""
    if pattern is not None:
        return F.regexp_extract(message, pattern, 2)
    return _extract_where(_has_any(F.lower(_filled(message)), SERVICE_WORDS), message, SERVICE, 2)


def endpoint_of(message: Column, pattern: str | None = None) -> Column:
    """The path after an HTTP verb, or group 2 of an own pattern; ``''`` if there is none."""
    if pattern is not None:
        return F.regexp_extract(message, pattern, 2)
    return _extract_where(_has_any(_filled(message), VERBS), message, ENDPOINT, 2)


def spaced_on_one_line(text: Column) -> Column:
    """Text made safe for one unquoted CSV cell: commas become semicolons, line ends blanks."""
    return F.translate(text, ",\n", "; ")
