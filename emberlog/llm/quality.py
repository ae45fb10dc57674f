"""Quality classifier: regularised quadratic discriminant analysis over statistics of the text.

Each text is reduced to a few statistics on log and log-odds scales. Per class, a mean and a covariance are learnt from
all labelled rows: tasks add up counts, sums and sums of products, and only these few numbers reach the driver. The
covariances are shrunk towards the pooled one and its diagonal, and factored once (Cholesky). A score is the
logistic of the difference of both classes' log densities, taken from Mahalanobis distances, plus the log odds of the labels.

A null text counts as empty; an empty text has its statistics and a score like any other. With fewer than two labelled
rows of a class, every score is the smoothed share of label 1. Labels that are null are not learnt from. Rows with equal
ids count each. Columns beyond the named ones are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from emberlog.llm.shared import released

#: Shares of the pooled covariance and of its diagonal in each class's covariance.
POOLED, DIAGONAL = 0.05, 0.05
SENTENCE = ".,;:'\"-()"
CHUNK = 1 << 16
#: What a usual share counts for, as if so many characters, words or lines had been seen.
WEIGHT = 8

# Kinds of characters by code point below 65,536; those above count as other letters.
SPACE, LOWER, UPPER, DIGIT, PLAIN, LOUD, SYMBOL = range(7)


def kinds() -> np.ndarray:
    def kind(c: str) -> int:
        if c.isspace():
            return SPACE
        if c.isupper():
            return UPPER
        if c.isalpha():
            return LOWER
        if c.isdigit():
            return DIGIT
        return PLAIN if c in SENTENCE else LOUD if c in "!?" else SYMBOL

    return np.array([kind(chr(c)) for c in range(1 << 16)], np.uint8)


def odds(part: float, whole: float, usual: float) -> float:
    """Log odds of a share, drawn towards a usual share while there is little to count."""
    return float(np.log((part + WEIGHT * usual) / (whole - part + WEIGHT * (1 - usual))))


def statistics(text: str, kind: np.ndarray) -> list[float]:
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    counts = np.bincount(kind[np.minimum(codes, 0xFFFF)], minlength=7)
    n = len(codes)
    words = text.split()
    w = len(words)
    lines = [line for line in text.split("\n") if line]
    letters = int(counts[LOWER] + counts[UPPER])
    repeats = sum(map(str.__eq__, words, words[1:]))
    loud = sum(map(str.isupper, words))
    bare = sum(map(str.isalnum, words))
    data = text.encode()
    deflater = zlib.compressobj(1)
    packed = sum(len(deflater.compress(data[k : k + CHUNK])) for k in range(0, len(data), CHUNK))
    packed += len(deflater.flush())
    return [
        float(np.log(n + 64)),
        float(np.log((n + 6 * WEIGHT) / (w + WEIGHT))),
        float(np.log((packed + 64) / (len(data) + 128))),
        odds(counts[UPPER], letters, 0.03),
        odds(counts[DIGIT], n, 0.01),
        odds(counts[SYMBOL], n, 0.002),
        odds(counts[PLAIN], n, 0.03),
        odds(counts[LOUD], n, 0.002),
        odds(len(set(words)), w, 0.8),
        odds(repeats, w, 0.01),
        odds(loud, w, 0.01),
        odds(bare, w, 0.85),
        odds(len(lines) - len(set(lines)), len(lines), 0.02),
        float(np.log((w + 20) / (len(lines) + 2))),
    ]


def _parts(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Batches cut to a few texts each, so that few are in Python at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def with_statistics(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of each row and the statistics of its text (features array<double>)."""
    schema = ", ".join(f"c{k} {df.schema[name].dataType.simpleString()}" for k, name in enumerate(keep))

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = kinds()
        for batch in _parts(batches):
            found = [statistics(text or "", kind) for text in batch.column(0).to_pylist()]
            columns = [*batch.columns[1:], pa.array(found, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, [*(f"c{k}" for k in range(len(keep))), "features"])

    chosen = df.select(F.col(text_col).alias("text"), *(F.col(name).alias(f"c{k}") for k, name in enumerate(keep)))
    return chosen.mapInArrow(released(measure), f"{schema}, features array<double>").toDF(*keep, "features")


@dataclass
class Discriminant:
    """Means and inverse Cholesky factors of both classes; ``prior`` is the log odds of label 1."""

    prior: float
    means: list[np.ndarray]
    whiteners: list[np.ndarray]
    log_sizes: list[float]

    def scores(self, x: np.ndarray) -> np.ndarray:
        margin = np.full(len(x), self.prior)
        for sign, mean, whitener, size in zip((-1, 1), self.means, self.whiteners, self.log_sizes, strict=False):
            distance = (((x - mean) @ whitener.T) ** 2).sum(axis=1)
            margin += sign * (-0.5 * distance - size)
        return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def fit(labelled: DataFrame, label_col: str, features_col: str = "features") -> Discriminant:
    """Learn from every labelled row; one row of sums per class and task is all that leaves the tasks."""

    def moments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            labels = batch.column(0).to_numpy(zero_copy_only=False)
            rows = batch.column(1).to_pylist()
            x = np.array(rows).reshape(len(rows), -1)
            for label in np.unique(labels):
                own = x[labels == label]
                found = np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
                sums[int(label)] = sums.get(int(label), 0) + found
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))],
            ["label", "sums"],
        )

    chosen = labelled.select(F.col(label_col).cast("int").alias("label"), F.col(features_col).alias("features"))
    parts = chosen.filter("label IN (0, 1)").mapInArrow(released(moments), "label int, sums array<double>")
    added = parts.select("label", F.posexplode("sums")).groupBy("label", "pos").agg(F.sum("col").alias("value"))
    values: dict[int, dict[int, float]] = {0: {}, 1: {}}
    for row in added.collect():  # a fixed number of rows: two classes by the moments
        values[row.label][row.pos] = row.value
    counts = [values[label].get(0, 0.0) for label in (0, 1)]
    prior = float(np.log((counts[1] + 0.5) / (counts[0] + 0.5)))
    if min(counts) < 2:
        return Discriminant(prior, [], [], [])
    means, scatters = [], []
    for label, count in enumerate(counts):
        flat = np.array([values[label][k] for k in range(len(values[label]))])
        d = int(round((np.sqrt(4 * len(flat) - 3) - 1) / 2))
        mean = flat[1 : d + 1] / count
        means.append(mean)
        scatters.append(flat[d + 1 :].reshape(d, d) - count * np.outer(mean, mean))
    pooled = sum(scatters) / sum(counts)
    target = np.diag(np.maximum(np.diag(pooled), 1e-6))
    whiteners, sizes = [], []
    for scatter, count in zip(scatters, counts, strict=True):
        covariance = (1 - POOLED - DIAGONAL) * scatter / count + POOLED * pooled + DIAGONAL * target
        factor = np.linalg.cholesky(covariance)
        whiteners.append(np.linalg.inv(factor))
        sizes.append(float(np.log(np.diag(factor)).sum()))
    return Discriminant(prior, means, whiteners, sizes)


def with_score(df: DataFrame, model: Discriminant, text_col: str = "text") -> DataFrame:
    """The rows with the score of their texts as a last column, ``score`` (in place of one of that name)."""
    names = [name for name in df.columns if name != "score"]
    place = names.index(text_col)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = kinds()
        for batch in _parts(batches):
            found = [statistics(text or "", kind) for text in batch.column(place).to_pylist()]
            scores = model.scores(np.array(found)) if found else np.array([])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, "score"])

    chosen = df.select(*names)
    return chosen.mapInArrow(released(score), StructType([*chosen.schema, StructField("score", DoubleType())]))


def held_out(id_col: str = "doc_id"):
    """Whether a row is kept from learning: crc32 of the id's text is divisible by five. A null id is held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))
