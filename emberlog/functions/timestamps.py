"""Timestamp assembly, parsing and bucketing as Column expressions.

The patterned formats are tried only on values of the matching shape. A pattern that does not match makes the
JVM parser raise and catch an exception per row, which would dominate the cost of a large scan.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# How a text of the ISO family begins.
ISO = r"^[+-]?\d{4,6}(-|$)"
# Fixed values: (shape, Spark pattern) of the layouts beyond the ISO family.
SHORT_YEAR = (r"^\d{2}/\d{1,2}/\d{1,2} ", "yy/MM/dd HH:mm:ss")
SYSLOG = (r"^[A-Za-z]{3} \d", "yyyy MMM d HH:mm:ss")

# Further layouts of the interactive profile, month before day, by the shape of the text: Y is a number of four
# digits, 9 one of one or two, M a word of three letters, L a longer one, P one of two, F a fraction.
EXTRA_LAYOUTS = {
    "Y/9/9 9:9:9": "yyyy/M/d H:mm:ss",
    "Y/9/9 9:9:9.F": "yyyy/M/d H:mm:ss.SSSSSS",
    "9/9/Y 9:9:9": "M/d/yyyy H:mm:ss",
    "9/9/Y": "M/d/yyyy",
    "M 9 9:9:9 Y": "MMM d H:mm:ss yyyy",
    "9 M Y 9:9:9": "d MMM yyyy H:mm:ss",
    "9-M-Y 9:9:9": "d-MMM-yyyy H:mm:ss",
    "9-M-Y": "d-MMM-yyyy",
    "M 9 Y 9:9:9": "MMM d[,] yyyy H:mm:ss",
    "M 9 Y": "MMM d[,] yyyy",
    "L 9 Y 9:9:9": "MMMM d[,] yyyy H:mm:ss",
    "L 9 Y": "MMMM d[,] yyyy",
    "9 L Y 9:9:9": "d MMMM yyyy H:mm:ss",
    "Y-9-9 9:9:9 P": "yyyy-M-d h:mm:ss a",
    "Y/9/9 9:9:9 P": "yyyy/M/d h:mm:ss a",
    "9/9/Y 9:9:9 P": "M/d/yyyy h:mm:ss a",
    "9/9/Y 9:9 P": "M/d/yyyy h:mm a",
    "M 9 Y 9:9:9 P": "MMM d[,] yyyy h:mm:ss a",
    "L 9 Y 9:9:9 P": "MMMM d[,] yyyy h:mm:ss a",
}
WEEKDAY_PREFIX = r"^(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun),? "


def _patterned(value: Column, candidate: Column, shape: str, pattern: str) -> Column:
    return F.when(value.rlike(shape), F.try_to_timestamp(candidate, F.lit(pattern)))


def _shape(text: Column) -> Column:
    """What a text looks like, as a key of ``EXTRA_LAYOUTS``. Reduced once, so a value costs one parser and not a test for each layout."""
    digits, letters = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    # Capitals in the text are gone before capitals come to stand for something.
    shape = F.translate(text, digits + letters, "9" * len(digits) + "a" * len(letters))
    for pattern, sign in (
        (r"\.9+$", ".F"), ("(?<!9)9{4}(?!9)", "Y"), ("(?<!9)9{1,2}(?!9)", "9"),
        ("(?<!a)a{3}(?!a)", "M"), ("(?<!a)a{2}(?!a)", "P"), ("(?<!a)a{4,9}(?!a)", "L"), ("(?<=^[ML] 9),", ""),
    ):
        shape = F.regexp_replace(shape, pattern, sign)
    return shape


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def _further(text: Column) -> Column:
    """A text of the interactive profile's further layouts as TIMESTAMP."""
    plain = F.regexp_replace(text, WEEKDAY_PREFIX, "")

    def parsed(both: Column) -> Column:
        given, shape = both["given"], both["shape"]
        dotted = F.regexp_replace(given, r",(\d+)$", ".$1")
        result = F.when(dotted.rlike(r"^\d{4}-.*\.\d+$"), F.try_to_timestamp(dotted))
        upper = F.concat(F.substring(given, F.lit(1), F.char_length(given) - 2), F.upper(F.right(given, F.lit(2))))
        for key, pattern in EXTRA_LAYOUTS.items():
            candidate = upper if pattern.endswith("a") else given
            result = result.when(shape == key, F.try_to_timestamp(candidate, F.lit(pattern)))
        return result

    return _bound(F.struct(plain.alias("given"), _shape(plain).alias("shape")), parsed)


def parse_timestamp(value: Column, default_year: int = 2025, extra_layouts: bool = False) -> Column:
    """A text timestamp in any known layout as TIMESTAMP; null where none fits.

    Known are the ISO family (with ``T`` or blank, fraction, date only), ``yy/MM/dd HH:mm:ss`` and syslog dates
    without a year, which get ``default_year``.
    """
    given = F.trim(value)
    # A half of the day must not be passed over, so the plain cast never sees one.
    plain_cast = given.rlike(ISO) & ~F.upper(F.substring(given, -2, 2)).isin("AM", "PM")
    attempts = [F.when(plain_cast, F.try_to_timestamp(given))]
    text = F.regexp_replace(given, r"\s+", " ")
    attempts.append(_patterned(text, text, *SHORT_YEAR))
    if extra_layouts:
        attempts.append(_further(text))
    attempts.append(_patterned(text, F.concat(F.lit(f"{default_year} "), text), *SYSLOG))
    return F.coalesce(*attempts)


def join_date_time(date: Column, time: Column, strip_brackets: bool = False) -> Column:
    """``date`` and ``time`` text as one timestamp text, a comma before the fraction becoming a dot."""
    if strip_brackets:
        date, time = F.translate(F.trim(date), "[]", ""), F.translate(F.trim(time), "[]", "")
    return F.concat_ws(" ", date, F.translate(time, ",", "."))


def join_month_day_time(month: Column, day: Column, time: Column) -> Column:
    """Syslog-style month name, day and time as one timestamp text without a year."""
    return F.concat_ws(" ", month, day, time)


def instant(moment: datetime) -> Column:
    """A literal timestamp: a naive one is wall-clock time of the session, whatever the zone of the driver is."""
    if moment.tzinfo is None:
        return F.lit(moment.isoformat(sep=" ")).cast("timestamp")
    return F.lit(moment.isoformat()).cast("timestamp")


def time_parts(ts: Column) -> dict[str, Column]:
    """The calendar columns that go with a timestamp."""
    return {
        "hour": F.hour(ts),
        "day": F.dayofmonth(ts),
        "month": F.month(ts),
        "year": F.year(ts),
        "date": F.to_date(ts),
    }


# The trend granularities, finest first.
GRANULARITIES = ("minute", "hour", "day", "week", "month")


def bucket(ts: Column, granularity: str) -> Column:
    """Label of the time bucket holding ``ts``.

    Minute, hour and day buckets are named by their start, weeks by their closing Sunday and months by their
    last day.
    """
    granularity = granularity.lower()
    if granularity not in GRANULARITIES:
        raise ValueError(f"granularity {granularity!r} is not one of {GRANULARITIES}")
    if granularity == "week":
        return F.next_day(F.date_sub(F.to_date(ts), 1), "SUN").cast("timestamp")
    if granularity == "month":
        return F.last_day(F.to_date(ts)).cast("timestamp")
    return F.date_trunc(granularity, ts)


# Shorthand units of a window length.
WINDOW_UNITS = {"m": "minute", "h": "hour", "d": "day"}


def window_length(size: str) -> str:
    """``1h`` / ``5m`` / ``1d`` as an interval text; a full interval text passes through."""
    size = size.strip()
    if size[:-1].isdigit() and size[-1:] in WINDOW_UNITS:
        return f"{size[:-1]} {WINDOW_UNITS[size[-1]]}"
    return size
