"""Trailing-window counts per key that stay exact, linear and bounded however hot a key is.

A plain ``Window.partitionBy(key)`` with a sliding frame would sort all rows of a key in one task and add up the
whole frame again for every row. Here the timeline is cut into blocks of one window length, and blocks into slices:

* rows are first counted per (key, instant), so one slice holds at most one row per microsecond;
* at either level, the count of a window is what the level above says for its start, plus what has arrived since,
  minus what has meanwhile left the window. That is a running sum inside one slice, or one block of slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _floor_div(value: Column, by: int) -> Column:
    """Integer quotient rounded down, without the rounding of a division of large longs."""
    return ((value - F.pmod(value, F.lit(by))) / by).cast("long")


def _changes(*rows: tuple[Column, Column, Column, Column]) -> Column:
    """Rows of (part, position, delta, n) to explode: the count of ``part`` changes by ``delta`` at ``position``."""
    names = ("part", "position", "delta", "n")
    return F.array(
        *[F.struct(*[value.cast("long").alias(name) for value, name in zip(row, names)]) for row in rows]
    )


def _running_sum(changes: DataFrame) -> DataFrame:
    """The summed changes of a part up to each position, kept for the positions asked for by ``n``."""
    upto = Window.partitionBy("key", "part").orderBy("position").rangeBetween(Window.unboundedPreceding, 0)
    return changes.withColumn("total", F.sum("delta").over(upto)).filter(F.col("n") > 0)


def rolling_count(
    df: DataFrame, key: str = "message", ts: str = "timestamp", window_s: int = 3600, slices: int = 60
) -> DataFrame:
    """Per distinct key and instant: ``row_count`` at it and ``rolling_count`` over ``(instant - window, instant]``.

    ``slices`` is the number of slices per window and must divide its length in microseconds.
    """
    window_us = window_s * 1_000_000
    if window_us % slices:
        raise ValueError(f"{slices} slices do not divide a window of {window_us} microseconds")
    width = window_us // slices

    points = (
        df.filter(F.col(key).isNotNull() & F.col(ts).isNotNull())
        .groupBy(F.col(key).alias("key"), F.unix_micros(ts).alias("us"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("slice", _floor_div(F.col("us"), width))
    )

    none, n, us, of_slice = F.lit(0), F.col("n"), F.col("us"), F.col("slice")

    # Per slice: the count of the `slices` slices before it, from those of its own and of the previous block.
    per_slice = points.groupBy("key", "slice").agg(F.sum("n").alias("n"))
    blocked = per_slice.withColumn("block", _floor_div(of_slice, slices))
    block = F.col("block")
    carried = blocked.groupBy("key", "block").agg(F.sum("n").alias("n"))
    carried = carried.select("key", F.inline(_changes((block + 1, (block + 1) * slices, n, none))))
    moved = blocked.select(
        "key",
        F.inline(
            _changes(
                (block, of_slice, none, n),
                (block, of_slice + 1, n, none),
                (block + 1, of_slice + slices + 1, -n, none),
            )
        ),
    )
    before = _running_sum(carried.unionByName(moved))

    # Per instant: the slices before its own, plus its own slice so far, minus what left at the far end.
    before = before.select("key", F.inline(_changes((F.col("position"), F.col("position") * width, F.col("total"), none))))
    moved = points.select(
        "key", F.inline(_changes((of_slice, us, n, n), (of_slice + slices, us + window_us, -n, none)))
    )
    return _running_sum(before.unionByName(moved)).select(
        F.col("key").alias(key),
        F.timestamp_micros("position").alias(ts),
        F.col("n").alias("row_count"),
        F.col("total").alias("rolling_count"),
    )


def with_rolling_count(
    df: DataFrame, key: str = "message", ts: str = "timestamp", window_s: int = 3600
) -> DataFrame:
    """Every row with a key and a timestamp, and its ``rolling_count``.

    The counts are joined back on (key, instant); a hot instant is split by the adaptive skew join.
    """
    counts = rolling_count(df, key, ts, window_s).drop("row_count")
    return df.join(counts, [key, ts])


def bursts(
    df: DataFrame, key: str = "message", ts: str = "timestamp", threshold: int = 20, window_s: int = 3600
) -> DataFrame:
    """Keys seen more than ``threshold`` times within some window: that count and the total per key.

    A window lies in two neighbouring blocks of its length, so only rows from pairs of blocks that together hold more
    than ``threshold`` are looked at closely; which those are is known from one combined count per (key, block).
    """
    block = _floor_div(F.unix_micros(ts), window_s * 1_000_000)
    rows = df.filter(F.col(key).isNotNull()).select(key, ts, block.alias("block"))
    per_block = rows.groupBy(key, "block").agg(F.count(F.lit(1)).alias("n"))
    this, other = F.col("block"), F.col("block") + 1
    pairs = per_block.select(key, F.explode(F.array(this, other)).alias("block"), "n")
    crowded = pairs.groupBy(key, "block").agg(F.sum("n").alias("n")).filter(F.col("n") > threshold)
    needed = crowded.select(key, F.explode(F.array(this, this - 1)).alias("block"))
    peaks = (
        rolling_count(rows.join(needed, [key, "block"], "left_semi"), key, ts, window_s)
        .groupBy(key)
        .agg(F.max("rolling_count").alias("max_burst"))
        .filter(F.col("max_burst") > threshold)
    )
    totals = per_block.groupBy(key).agg(F.sum("n").alias("total"))
    return peaks.join(totals, key)
