"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A build side is broadcast only when it was counted first and holds at most so many rows of fixed width.
BROADCAST_ROWS = 1_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or one in the warehouse where that is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    own = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
    spark.sparkContext.setCheckpointDir(own)
    return own


def fresh_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows written to the shared checkpoint folder; what follows survives lost executors without recomputing."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table of their own in the shared folder. For loops: unlike a checkpoint it hands on no constraints of the
    plan behind it, of which the optimizer would have more in every round."""
    folder = fresh_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows for the jobs that run inside, so that long texts take little memory."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def released(task: Callable[[Iterable], Iterator]) -> Callable[[Iterable], Iterator]:
    """A task function that gives its memory back when it ends. Python workers live on beside the joins of later stages, and what
    their allocators keep would count against the executor all that time."""

    def run(batches: Iterable) -> Iterator:
        import ctypes
        import gc

        import pyarrow

        yield from task(batches)
        gc.collect()
        pyarrow.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # another allocator than that of glibc
            pass

    return run


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_enough(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a table of narrow rows holds at most ``rows``; looks no further than that."""
    return df.limit(rows + 1).count() <= rows


def hinted(df: DataFrame) -> DataFrame:
    """A side of a join that is broadcast where its narrow rows are few, after counting, and shuffled otherwise."""
    return F.broadcast(df) if small_enough(df) else df


def ascii_lower(text):
    """A-Z in lower case and nothing else, which is not what ``lower`` does beyond ASCII."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    )


def sealed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(sealed_id, sealed_text, sealed_rest): id, text, and all other columns as one value, so that their names clash with nothing."""
    rest = [F.col(f"`{name}`") for name in df.columns if name not in (id_col, text_col)]
    return df.select(
        F.col(f"`{id_col}`").alias("sealed_id"),
        F.col(f"`{text_col}`").alias("sealed_text"),
        (F.struct(*rest) if rest else F.lit(0)).alias("sealed_rest"),
    )


def unsealed(columns: list[str], id_col: str, text_col: str) -> list[Column]:
    """The columns of a table that was ``sealed``, as they were; ``columns`` names those wanted in their order."""
    own = {id_col: F.col("sealed_id"), text_col: F.col("sealed_text")}
    return [own.get(name, F.col("sealed_rest").getField(name)).alias(name) for name in columns]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
