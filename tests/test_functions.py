"""Timestamp layouts, buckets, levels and facts derived from text."""

from __future__ import annotations

import random
import time
from datetime import date, datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from emberlog.functions import levels, text, timestamps
from tests.conftest import tuples


def parsed(spark, values, **options):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    rows = df.select("i", timestamps.parse_timestamp(F.col("v"), **options)).collect()
    return [value for _, value in sorted(rows)]


@pytest.mark.parametrize(
    "value, expected",
    [
        ("2024-01-15 10:30:00", datetime(2024, 1, 15, 10, 30)),
        ("2024-01-15 10:30:00.123", datetime(2024, 1, 15, 10, 30, 0, 123000)),
        ("2024-01-15 10:30:00.123456", datetime(2024, 1, 15, 10, 30, 0, 123456)),
        ("2024-01-15T10:30:00", datetime(2024, 1, 15, 10, 30)),
        ("2024-01-15T10:30:00Z", datetime(2024, 1, 15, 10, 30)),
        ("2024-01-15T12:30:00+02:00", datetime(2024, 1, 15, 10, 30)),
        ("2024-01-15", datetime(2024, 1, 15)),
        (" 2024-01-15 10:30:00 ", datetime(2024, 1, 15, 10, 30)),
        ("17/06/09 20:10:40", datetime(2017, 6, 9, 20, 10, 40)),
        ("Jun 14 15:16:01", datetime(2025, 6, 14, 15, 16, 1)),
        ("Jun  4 15:16:01", datetime(2025, 6, 4, 15, 16, 1)),
        ("10:15:23", None),
        ("2024-13-45 10:30:00", None),
        ("Feb 30 10:00:00", None),
        ("Foo 14 15:16:01", None),
        ("17/26/09 20:10:40", None),
        ("soon", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_timestamp(spark, value, expected):
    assert parsed(spark, [value]) == [expected]


def test_parse_timestamp_year_and_extra_layouts(spark):
    assert parsed(spark, ["Feb 29 10:00:00"], default_year=2024) == [datetime(2024, 2, 29, 10)]
    values = [
        "2016-09-28 04:30:30,123",
        "03/04/2024 5:06:07",
        "03/04/2024",
        "2024/3/4 05:06:07",
        "2024/03/04 05:06:07.25",
        "Mon Mar 04 05:06:07 2024",
        "4 Mar 2024 05:06:07",
    ]
    moment = datetime(2024, 3, 4, 5, 6, 7)
    expected = [
        datetime(2016, 9, 28, 4, 30, 30, 123000),
        moment,
        datetime(2024, 3, 4),
        moment,
        moment.replace(microsecond=250000),
        moment,
        moment,
    ]
    assert parsed(spark, values, extra_layouts=True) == expected
    assert parsed(spark, values) == [None] * len(values)


@pytest.mark.parametrize("granularity, rule", [("minute", "min"), ("hour", "h"), ("day", "D"), ("week", "W"), ("month", "ME")])
def test_buckets_are_those_of_pandas(spark, granularity, rule):
    moments = pd.date_range("2023-12-25 00:00:00", "2024-03-05", freq="7h13min")
    frame = pd.DataFrame({"ts": moments})
    counts = frame.set_index("ts").resample(rule).size()
    expected = {stamp.to_pydatetime(): int(n) for stamp, n in counts[counts > 0].items()}
    df = spark.createDataFrame(frame)
    got = df.groupBy(timestamps.bucket(F.col("ts"), granularity).alias("b")).count().collect()
    assert {row.b: row["count"] for row in got} == expected


def test_bucket_rejects_unknown_granularity():
    with pytest.raises(ValueError, match="fortnight"):
        timestamps.bucket(None, "fortnight")


def test_window_length():
    assert [timestamps.window_length(x) for x in ("1h", "5m", "1d", "10 minutes")] == [
        "1 hour",
        "5 minute",
        "1 day",
        "10 minutes",
    ]


def test_levels(spark):
    df = spark.createDataFrame([(" warning ",), ("Combo",), (None,), ("error",), ("critical",), ("debug",)], "v string")
    level = levels.normalize_level(F.col("v"), "UNKNOWN", {"WARNING": "WARN", "COMBO": "INFO"})
    assert tuples(df.select(level.alias("l"), levels.severity_of(level))) == [
        ("WARN", 2),
        ("INFO", 1),
        ("UNKNOWN", 1),
        ("ERROR", 3),
        ("CRITICAL", 1),
        ("DEBUG", 0),
    ]
    assert tuples(df.select(levels.normalize_level(F.col("v"))))[2] == ("INFO",)


@pytest.mark.parametrize(
    "message, expected",
    [
        ("java.io.FileNotFoundException: x", "FileNotFoundException"),
        ("ValueError then KeyException", "ValueError"),
        ("MyErrorException", "MyErrorException"),
        ("write failed", ""),
        ("Unexpected exception", ""),
        ("failed after timeout", ""),
        ("Time Out while reading", "TimeoutError"),
        ("connect timeout", "TimeoutError"),
        ("cannot connect, unauthorized", "ConnectionError"),
        ("author unknown", "AuthenticationError"),
        ("status 404", "NotFoundError"),
        ("status 403", "PermissionError"),
        ("éFooError", "FooError"),
        ("all good", "UnknownError"),
        ("   ", "UnknownError"),
        (None, "UnknownError"),
    ],
)
def test_error_type_rules(spark, message, expected):
    df = spark.createDataFrame([(message,)], "m string")
    assert tuples(df.select(text.error_type_of(F.col("m")))) == [(expected,)]


def test_error_type_given_and_blank(spark):
    df = spark.createDataFrame([("  Disk ", "timeout"), ("  ", "timeout"), (None, "it failed")], "g string, m string")
    m, g = F.col("m"), F.col("g")
    assert tuples(df.select(text.error_type_of(m, g))) == [("Disk",), ("TimeoutError",), ("",)]
    blank = text.error_type_of(m, g, blank_as_unknown=True)
    assert tuples(df.select(blank)) == [("Disk",), ("TimeoutError",), ("UnknownError",)]


def test_error_type_of_a_very_long_token(spark):
    """One token of 400,000 characters must not take quadratic time, and its end must count."""
    df = spark.range(2).select(F.concat(F.repeat(F.lit("a1b2"), 100_000), F.lit(" failed in BadError")).alias("m"))
    start = time.time()
    assert tuples(df.select(text.error_type_of(F.col("m")))) == [("BadError",)] * 2
    assert time.time() - start < 20


def test_entities(spark):
    df = spark.createDataFrame(
        [
            ("from 10.1.2.3 to 10.9.9.9",),
            ("AuthService unavailable",),
            ("call GET /a/b-c and api: orders",),
            ("bad 999.1.1.1",),
            ("nothing",),
        ],
        "m string",
    )
    m = F.col("m")
    columns = (text.ip_address_of(m), text.ip_address_of(m, strict=True), text.service_of(m), text.endpoint_of(m))
    assert tuples(df.select(*columns)) == [
        ("10.1.2.3", "10.1.2.3", "", ""),
        ("", "", "unavailable", ""),
        ("", "", "orders", "/a/b-c"),
        ("999.1.1.1", "", "", ""),
        ("", "", "", ""),
    ]


def test_substring_tests_agree_with_patterns(spark):
    """Looking for words in the lower-cased text must give what case-insensitive patterns give, also beyond ASCII."""
    words = ["ERROR", "faİled", "faıled", "FAILED", "\u212aey", "Tıme Out", "TIME OUT", "conneCT", "CONNEÇT", "aPİ: x", "API x",
             "ENDPOİNT y", "ſervice z", "SERVICE:\tz/1", "get /a", "GET  /ä", "PATCH\n/p", "NOT FOUND", "é404", "10.0.0.1é", "ß403", "İ"]
    rng = random.Random(9)
    texts = [" ".join(rng.choices(words, k=rng.randrange(1, 4))) for _ in range(3000)]
    made = spark.createDataFrame([(t,) for t in texts], "m string")
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(F.col("text").alias("m"))
    m = F.col("m")
    chain = F.when(m.rlike("(?i)(exception|error|failed|failure)"), F.regexp_extract(m, r"(?i)(\w+Exception|\w+Error|\w+Failure)", 1))
    for pattern, name in (
        ("(?i)(timeout|time out)", "TimeoutError"),
        ("(?i)(connection|connect)", "ConnectionError"),
        ("(?i)(authentication|auth|unauthorized)", "AuthenticationError"),
        ("(?i)(not found|404)", "NotFoundError"),
        ("(?i)(permission|forbidden|403)", "PermissionError"),
    ):
        chain = chain.when(m.rlike(pattern), name)
    pairs = (
        (text.error_type_of(m), chain.otherwise("UnknownError")),
        (text.ip_address_of(m), F.regexp_extract(m, text.IP, 0)),
        (text.service_of(m), F.regexp_extract(m, text.SERVICE, 2)),
        (text.endpoint_of(m), F.regexp_extract(m, text.ENDPOINT, 2)),
    )
    differs = [a.eqNullSafe(b) == F.lit(False) for a, b in pairs]
    rows = made.unionByName(documents)
    assert rows.filter(differs[0] | differs[1] | differs[2] | differs[3]).collect() == []
    assert rows.select(pairs[0][0]).distinct().count() >= 6


def test_instant_is_session_time(spark):
    expected = datetime(2024, 1, 5, 12)
    assert spark.range(1).select(timestamps.instant(expected)).first()[0] == expected
    assert spark.range(1).select(F.to_date(timestamps.instant(expected))).first()[0] == date(2024, 1, 5)


def test_one_line_text(spark):
    df = spark.createDataFrame([("a,b\nc",)], "m string")
    assert tuples(df.select(text.spaced_on_one_line(F.col("m")))) == [("a;b c",)]
