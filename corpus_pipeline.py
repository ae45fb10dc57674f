"""A training corpus from raw documents: good texts, one of each group of copies, without benchmark passages, as tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet to the shared folder and gives
the table to the next stage. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.llm.bpe import bpe_code
from emberlog.llm.decontaminate import decontaminated
from emberlog.llm.ngram_join import one_row_of_each
from emberlog.llm.queries import scored
from emberlog.llm.shared import fresh_folder, sealed, table, unsealed


def _plain(docs: DataFrame) -> DataFrame:
    """Documents with their other columns as one, so that the names of these clash with no result of an operator."""
    return sealed(docs, "doc_id", "text").withColumnsRenamed({"sealed_id": "doc_id", "sealed_text": "text"})


def _restored(docs: DataFrame) -> DataFrame:
    return docs.withColumnsRenamed({"doc_id": "sealed_id", "text": "sealed_text"})


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; null and empty texts are scored like others."""
    judged = scored(_plain(docs), table(spark, sf_dir, "labels"))
    return _restored(judged.filter("predicted = 1")).select(*unsealed(docs.columns, "doc_id", "text"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked texts one row, of the least id; texts of one id that are unlike stay, and rows without an id."""
    return one_row_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    judged = decontaminated(_plain(docs), table(spark, sf_dir, "benchmark"))
    return _restored(judged.filter("n_hit = 0")).select(*unsealed(docs.columns, "doc_id", "text"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with the digest of the text decoded from them."""
    coded = bpe_code(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))
    return coded.select("doc_id", "n_tokens", "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_good),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

#: The classifier and the tokenizer can't be written in SQL; tests compare ``run`` with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage for all rows of ``documents``."""
    folder = fresh_folder(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
