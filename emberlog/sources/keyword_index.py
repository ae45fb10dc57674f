"""Keyword search that skips files of the log table.

``refresh`` keeps, per data file of every finished batch, a bitmap of the hashed trigrams of the texts that a keyword search looks into.
A file without one of the keyword's trigrams can't hold the keyword and is not read. Bitmaps may claim a trigram that is not
there, never the reverse. Files of batches without an index are read, as are all files for keywords under three
characters and for patterns. A batch's index is one directory, which a repeated run overwrites; ``keywords/done`` names it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.operators.filters import SEARCH_COLUMNS, search_logs
from emberlog.sources.log_table import INGESTED, as_ingested, finished_batches, read_if_exists

INDEX = "file string, bucket long, bits binary, batch_id string"
DONE = "batch_id string"
GRAM = 3
#: Bits of a file's bitmap, in parts of 32,768, the size that Spark's bitmap functions work on.
BITS = 8 * 32_768


def _position(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(BITS)) + 1


def _bitmaps(grams: DataFrame, *keys: str) -> DataFrame:
    """(``keys``, bucket, bits) of rows with a ``gram``."""
    placed = grams.select(*keys, _position(F.col("gram")).alias("at")).distinct()
    by = (*keys, F.bitmap_bucket_number("at").alias("bucket"))
    return placed.groupBy(*by).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))


def _grams(text: Column) -> Column:
    starts = F.sequence(F.lit(1), F.char_length(text) - (GRAM - 1))
    grams = F.array_distinct(F.transform(starts, lambda k: F.substring(text, k, F.lit(GRAM))))
    return F.when(F.char_length(text) >= GRAM, grams)


def refresh(spark: SparkSession, base: str) -> list[str]:
    """Index the finished batches that are not indexed yet; their ids."""
    done = {row.batch_id for row in read_if_exists(spark, f"{base}/keywords/done", DONE).toLocalIterator()}
    fresh = [batch_id for batch_id in finished_batches(spark, base) if batch_id not in done]
    for batch_id in fresh:
        rows = spark.read.schema(INGESTED).parquet(f"{base}/logs/batch_id={batch_id}")
        texts = rows.select(
            F.col("_metadata.file_path").alias("file"), F.explode(F.array(*(F.lower(name) for name in SEARCH_COLUMNS))).alias("text")
        ).distinct()
        index = _bitmaps(texts.select("file", F.explode(_grams(F.col("text"))).alias("gram")), "file")
        # A file without any trigram has a part too, so that it is known to be indexed.
        files = rows.select(F.col("_metadata.file_path").alias("file")).distinct()
        missing = files.join(index, "file", "left_anti").select("file", F.lit(0).cast("long").alias("bucket"), F.lit(b"").alias("bits"))
        index.unionByName(missing).write.mode("overwrite").parquet(f"{base}/keywords/index/batch_id={batch_id}")
        spark.createDataFrame([(batch_id,)], DONE).coalesce(1).write.mode("append").parquet(f"{base}/keywords/done")
    return fresh


def possible_files(spark: SparkSession, base: str, query: str) -> DataFrame:
    """(file, batch_id) of the indexed files that may hold a literal keyword."""
    index = read_if_exists(spark, f"{base}/keywords/index", INDEX)
    query = query.strip().lower()
    grams = sorted({query[k : k + GRAM] for k in range(len(query) - GRAM + 1)})
    if not grams:
        return index.select("file", "batch_id").distinct()
    wanted = _bitmaps(spark.createDataFrame([(gram,) for gram in grams], "gram string"))
    parts = wanted.agg(F.count("*")).scalar()
    # The keyword's bits are among a file's when they add none to it.
    both = index.join(F.broadcast(wanted.withColumnRenamed("bits", "more")), "bucket")
    each = both.select("file", "batch_id", "bucket", "bits", F.explode(F.array("bits", "more")).alias("one"))
    held = each.groupBy("file", "batch_id", "bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("one")).alias("joint"), F.max(F.bitmap_count("bits")).alias("alone")
    )
    whole = held.filter("joint = alone").groupBy("file", "batch_id").agg(F.count("*").alias("held"))
    return whole.filter(F.col("held") == parts).select("file", "batch_id")


def search_keyword(spark: SparkSession, base: str, query: str, regex: bool = False) -> DataFrame:
    """The rows of ``search_logs`` over the whole log table, from the files that may hold them.

    The driver sees one path per file that is read.
    """
    finished = finished_batches(spark, base)
    done = {row.batch_id for row in read_if_exists(spark, f"{base}/keywords/done", DONE).toLocalIterator()}
    paths = [f"{base}/logs/batch_id={batch_id}" for batch_id in finished if batch_id not in done]
    if regex or len(query.strip()) < GRAM:
        paths = [f"{base}/logs/batch_id={batch_id}" for batch_id in finished]
    else:
        named = possible_files(spark, base, query).filter(F.col("batch_id").isin(finished))
        # Paths come as URIs, in which a percent sign stands for other characters.
        decoded = F.url_decode(F.replace("file", F.lit("+"), F.lit("%2B")))
        paths += sorted(row.path for row in named.select(decoded.alias("path")).toLocalIterator())
    if not paths:
        return search_logs(spark.createDataFrame([], INGESTED), query, regex=regex)
    rows = spark.read.schema(INGESTED).option("basePath", f"{base}/logs").parquet(*paths)
    return search_logs(as_ingested(spark, base, rows), query, regex=regex)
