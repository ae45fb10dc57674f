"""Frequent values and many-pattern containment without shuffling what is rare."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.operators.filters import filter_errors
from emberlog.operators.metrics import count_rows

#: Cells of the frequency summary, two hashes of a value each; a cell is two numbers.
CELLS = 1 << 20
#: Characters of an anchor; shorter patterns are their own.
ANCHOR = 12
CHUNK = 256


def _cells(value: Column, cells: int) -> list[Column]:
    """The cell of a value by each of two independent hashes; those of the second lie behind those of the first."""
    second = F.xxhash64(F.lit("second"), value)
    return [F.pmod(F.xxhash64(value), F.lit(cells)), F.pmod(second, F.lit(cells)) + cells]


def heavy_hitters(df: DataFrame, column: str, above: int, cells: int = CELLS) -> DataFrame:
    """(``column``, count) of every value that is not null and occurs more than ``above`` times; exact.

    First a summary of fixed size: each task counts its rows per cell, and the sums over all tasks bound a value's count from
    above. Then only rows whose cells are both above the limit are counted by value. The first shuffle carries at most
    ``2 * cells`` rows a task and the second the values that may be frequent, however many there are that are not; the heavy
    cells, at most ``2 * cells`` numbers, are broadcast. With more than about ``cells * above / 2`` rows of rare values the summary
    tells them apart less well; then ``cells`` should grow, and the result is the same anyway.
    """
    rows = df.filter(F.col(column).isNotNull()).select(F.col(column).alias("_value"))
    first, second = _cells(F.col("_value"), cells)
    summary = rows.select(F.explode(F.array(first, second)).alias("_cell")).groupBy("_cell").agg(F.count("*").alias("_n"))
    heavy = F.broadcast(summary.filter(F.col("_n") > above).select("_cell"))
    possible = rows.withColumns({"_first": first, "_second": second})
    for place in ("_first", "_second"):
        possible = possible.join(heavy.withColumnRenamed("_cell", place), place, "left_semi")
    counted = possible.groupBy("_value").agg(count_rows().alias("count")).filter(F.col("count") > above)
    return counted.withColumnRenamed("_value", column)


def heavy_messages(df: DataFrame, above: int = 5, cells: int = CELLS) -> DataFrame:
    """The rows of ``rules.frequent_messages``, for logs in which most messages occur once."""
    return heavy_hitters(filter_errors(df), "message", above, cells)


def _anchors(patterns: DataFrame) -> DataFrame:
    """(pattern, anchor): of the substrings of ``ANCHOR`` characters the one that fewest patterns share, by hash among equals."""
    starts = F.sequence(F.lit(1), F.greatest(F.char_length("pattern") - (ANCHOR - 1), F.lit(1)))
    grams = F.array_distinct(F.transform(starts, lambda k: F.substring(F.col("pattern"), k, F.lit(ANCHOR))))
    each = patterns.select("pattern", F.explode(grams).alias("anchor"))
    shared = each.groupBy("anchor").agg(F.count("*").alias("n"))
    ranked = each.join(shared, "anchor").groupBy("pattern")
    return ranked.agg(F.min_by("anchor", F.struct("n", F.xxhash64("anchor"))).alias("anchor"))


def texts_containing(texts: DataFrame, patterns: DataFrame) -> DataFrame:
    """(text, pattern) for every distinct ``text`` and ``pattern`` where the text contains the pattern literally.

    Each pattern is looked up by one anchor. Texts and anchors meet by an equi-join on the hash of that substring and only such pairs
    are compared, so the work follows the anchors' occurrences and not the product. Null and empty texts contain nothing, null and
    empty patterns are in nothing. Texts are cut into overlapping chunks first, so a long one costs little more than its length.
    """
    texts = texts.select("text").filter(F.col("text") != "").distinct().withColumn("id", F.xxhash64("text"))
    anchors = _anchors(patterns.select("pattern").filter(F.col("pattern") != "").distinct())
    anchors = anchors.select("pattern", F.xxhash64("anchor").alias("gram"), F.char_length("anchor").alias("size"))
    # At most ANCHOR sizes, most often that one alone.
    sizes = sorted(row["size"] for row in anchors.select("size").distinct().toLocalIterator())
    if not sizes:
        return texts.select("text", F.lit("").alias("pattern")).limit(0)
    starts = F.sequence(F.lit(1), F.char_length("text"), F.lit(CHUNK))
    chunks = texts.select(
        "id", F.explode(F.transform(starts, lambda k: F.substring(F.col("text"), k, F.lit(CHUNK + ANCHOR - 1)))).alias("chunk")
    )
    places = chunks.select("id", "chunk", F.explode(F.array(*map(F.lit, sizes))).alias("size"))
    places = places.filter(F.char_length("chunk") >= F.col("size"))
    starts = F.sequence(F.lit(1), F.char_length("chunk") - F.col("size") + 1)
    grams = F.transform(starts, lambda k: F.xxhash64(F.substring(F.col("chunk"), k, F.col("size"))))
    found = places.select("id", F.explode(F.array_distinct(grams)).alias("gram"))
    pairs = found.join(anchors.select("pattern", "gram"), "gram").select("id", "pattern").distinct()
    return pairs.join(texts, "id").filter(F.contains("text", "pattern")).select("text", "pattern")


def alerts_with_messages(alerts: DataFrame, messages: DataFrame) -> DataFrame:
    """Alerts whose details or message contain any of the ``message`` values that aren't blank, however many these are."""
    text = F.concat_ws(" ", F.coalesce("details", F.lit("")), F.coalesce("message", F.lit("")))
    wanted = messages.filter(F.trim("message") != "").select(F.col("message").alias("pattern"))
    hits = texts_containing(alerts.select(text.alias("text")), wanted).select(F.col("text").alias("_text"))
    return alerts.withColumn("_text", text).join(hits, "_text", "left_semi").drop("_text")
