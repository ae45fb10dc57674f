"""Top-k and newest-first. All limits are the feature itself and run as a bounded top-k, never a total sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberlog.operators.filters import filter_errors
from emberlog.operators.metrics import count_rows


def top_n_errors(df: DataFrame, n: int = 10) -> DataFrame:
    """Most frequent (type, message) pairs of errors; equals are ordered by the pair."""
    return (
        filter_errors(df)
        .groupBy("error_type", "message")
        .agg(count_rows().alias("count"))
        .orderBy(F.desc("count"), "error_type", "message")
        .limit(n)
    )


def top_messages(df: DataFrame, n: int = 5) -> DataFrame:
    """Most frequent error messages; equals are ordered by the message."""
    return (
        filter_errors(df)
        .filter(F.col("message").isNotNull())
        .groupBy("message")
        .agg(count_rows().alias("count"))
        .orderBy(F.desc("count"), "message")
        .limit(n)
    )


def most_frequent_error(df: DataFrame) -> DataFrame:
    return top_messages(df, 1)


def top_errors_relative(df: DataFrame, n: int = 5) -> DataFrame:
    """Top messages with their count in percent of the first one's."""
    first = F.max("count").over(Window.partitionBy())
    return top_messages(df, n).withColumn("pct_of_top", F.col("count") * 100 / first)


def latest_logs(df: DataFrame, n: int, *tie_break: str) -> DataFrame:
    """The ``n`` newest rows."""
    return df.orderBy(F.desc_nulls_last("timestamp"), *tie_break).limit(n)
