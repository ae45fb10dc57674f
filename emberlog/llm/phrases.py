"""Document fingerprints by locally consistent parsing.

A text is parsed into phrases, these into phrases of phrases, and so on. Within a level, runs of equal symbols become one
symbol; then deterministic coin tossing gives each symbol a small label, by the lowest bit in which it differs from its
left neighbour, repeated until labels are below six; a phrase begins at each local maximum of the labels. As boundaries
depend only on a few neighbours, equal passages get equal phrases but for those at their ends, whatever stands
before them. A phrase is named by a hash of its symbols' names.

The fingerprint lists the least ``KEPT`` of the hashed names of level ``LEVEL`` and the one below in hexadecimal (of all levels
for short texts). The likeness of two
fingerprints is the share of the least names of both together that both have, an estimate of the Jaccard coefficient of
their phrases, between 0 and 1.

A null text counts as empty; an empty text has an empty fingerprint, and two empty ones are alike (1). Equal texts have
equal fingerprints. A text of one symbol is one phrase. Long texts are parsed whole, in memory in proportion to the text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm.shared import partitions

LEVEL = 3
KEPT = 64
ROUNDS = 4
#: Short texts, with fewer phrases than this, are described by the phrases of lower levels too.
FEW = 16
#: Ranges of ids per shuffle partition, so that partitions come out even.
RANGES = 4
#: Code points that are parsed together at most, but for a longer text alone.
BATCH_CHARS = 1 << 20

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
ONE = np.uint64(1)


def spread(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def tossed(symbols: np.ndarray) -> np.ndarray:
    """For each symbol, twice the lowest bit that differs from the left neighbour plus its own value of that bit."""
    left = np.empty_like(symbols)
    left[1:] = symbols[:-1]
    left[0] = ~symbols[0]
    differing = symbols ^ left
    lowest = differing & (~differing + ONE)
    place = np.bitwise_count(lowest - ONE).astype(np.uint64)
    return (place << ONE) | ((symbols & lowest) != 0)


def tossed_apart(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """``tossed`` of several texts laid end to end; ``first`` marks where each begins, which has no left neighbour."""
    left = np.empty_like(symbols)
    left[1:] = symbols[:-1]
    left[first] = ~symbols[first]
    differing = symbols ^ left
    lowest = differing & (~differing + ONE)
    place = np.bitwise_count(lowest - ONE).astype(np.uint64)
    return (place << ONE) | ((symbols & lowest) != 0)


class Parser:
    def __init__(self):
        self.powers = np.cumprod(np.r_[ONE, np.full(255, MULTIPLIER)])

    def level(self, names: np.ndarray) -> np.ndarray:
        """The names of the phrases that the symbols ``names`` form."""
        heads = np.flatnonzero(np.r_[True, names[1:] != names[:-1]])
        if len(heads) < len(names):
            lengths = np.diff(np.r_[heads, len(names)]).astype(np.uint64)
            runs = names[heads]
            names = np.where(lengths > 1, spread(runs * MULTIPLIER + lengths), runs)
        labels = names
        for _ in range(ROUNDS):
            labels = tossed(labels)
        small = labels.astype(np.int8)
        peak = np.r_[True, (small[1:-1] > small[:-2]) & (small[1:-1] > small[2:]), False][: len(small)]
        starts = np.flatnonzero(peak)
        lengths = np.diff(np.r_[starts, len(names)])
        longest = int(lengths.max())
        if longest > len(self.powers):
            self.powers = np.cumprod(np.r_[ONE, np.full(2 * longest, MULTIPLIER)])
        place = np.arange(len(names)) - np.repeat(starts, lengths)
        return spread(np.add.reduceat(names * self.powers[place], starts) + lengths.astype(np.uint64))

    def phrases(self, text: str, levels: int = LEVEL) -> list[np.ndarray]:
        """The phrase names of each level from the first on; no levels for an empty text."""
        if not text:
            return []
        with np.errstate(over="ignore"):
            names = spread(np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64) + MULTIPLIER)
            found = []
            for _ in range(levels):
                names = self.level(names)
                found.append(names)
        return found

    def sketch(self, text: str) -> np.ndarray:
        """The least 32-bit names of the two upper levels, and of those below while they are few, ascending."""
        found = self.phrases(text)
        if not found:
            return np.zeros(0, np.uint32)
        chosen: list[np.ndarray] = []
        with np.errstate(over="ignore"):
            for k in range(LEVEL - 1, -1, -1):
                if len(chosen) >= 2 and sum(map(len, chosen)) >= FEW:
                    break
                chosen.append(spread(found[k] + np.uint64(k)) >> np.uint64(32))
        return np.unique(np.concatenate(chosen).astype(np.uint32))[:KEPT]

    def levels_apart(self, names: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``level`` of several texts laid end to end, ``first`` marking where each begins; the names and their marks."""
        heads = np.flatnonzero(first | np.r_[True, names[1:] != names[:-1]])
        if len(heads) < len(names):
            lengths = np.diff(np.r_[heads, len(names)]).astype(np.uint64)
            runs = names[heads]
            names = np.where(lengths > 1, spread(runs * MULTIPLIER + lengths), runs)
            first = first[heads]
        labels = names
        for _ in range(ROUNDS):
            labels = tossed_apart(labels, first)
        small = labels.astype(np.int8)
        last = np.r_[first[1:], True]
        peak = first | ((small > np.r_[small[:1], small[:-1]]) & (small > np.r_[small[1:], small[-1:]]) & ~last)
        starts = np.flatnonzero(peak)
        lengths = np.diff(np.r_[starts, len(names)])
        longest = int(lengths.max())
        if longest > len(self.powers):
            self.powers = np.cumprod(np.r_[ONE, np.full(2 * longest, MULTIPLIER)])
        place = np.arange(len(names)) - np.repeat(starts, lengths)
        return spread(np.add.reduceat(names * self.powers[place], starts) + lengths.astype(np.uint64)), first[starts]

    def sketches(self, texts: list[str]) -> list[np.ndarray]:
        """``sketch`` of each text, parsed together in groups of about ``BATCH_CHARS`` code points."""
        found: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
        group: list[int] = []
        size = 0
        for k, text in enumerate(texts):
            if text:
                group.append(k)
                size += len(text)
            if group and (size >= BATCH_CHARS or k == len(texts) - 1):
                for j, sketch in zip(group, self._sketches([texts[j] for j in group]), strict=True):
                    found[j] = sketch
                group, size = [], 0
        return found

    def _sketches(self, texts: list[str]) -> list[np.ndarray]:
        """``sketch`` of each of some texts, none empty."""
        codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        first = np.zeros(len(codes), bool)
        first[np.cumsum([0, *map(len, texts[:-1])])] = True
        chosen, owners = [], []
        with np.errstate(over="ignore"):
            names = spread(codes.astype(np.uint64) + MULTIPLIER)
            found = []
            for _ in range(LEVEL):
                names, first = self.levels_apart(names, first)
                found.append((names, np.cumsum(first) - 1))
            counts = [np.bincount(owner, minlength=len(texts)) for _, owner in found]
            # Of each text the two upper levels, and those below while there are fewer than FEW names.
            taken = np.zeros(len(texts), np.int64)
            for k in range(LEVEL - 1, -1, -1):
                wanted = np.ones(len(texts), bool) if k >= LEVEL - 2 else taken < FEW
                names, owner = found[k]
                keep = wanted[owner]
                chosen.append((spread(names[keep] + np.uint64(k)) >> np.uint64(32)).astype(np.uint32))
                owners.append(owner[keep])
                taken += np.where(wanted, counts[k], 0)
        values, owner = np.concatenate(chosen), np.concatenate(owners)
        order = np.lexsort((values, owner))
        values, owner = values[order], owner[order]
        fresh = np.r_[True, (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])]
        values, owner = values[fresh], owner[fresh]
        begins = np.searchsorted(owner, np.arange(len(texts)))
        ends = np.minimum(np.r_[begins[1:], len(owner)], begins + KEPT)
        return [values[a:b] for a, b in zip(begins, ends, strict=True)]


def written(sketch: np.ndarray) -> str:
    return sketch.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) and not len(b):
        return 1.0
    both = np.union1d(a, b)
    # A sketch that isn't full lists all its names; beyond a full one nothing is known.
    full = max(len(a), len(b)) >= KEPT
    both = both[:KEPT] if full else both
    return float((np.isin(both, a) & np.isin(both, b)).sum() / len(both))


def fingerprints(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of each row and the fingerprint of its text."""
    schema = ", ".join(f"c{k} {df.schema[name].dataType.simpleString()}" for k, name in enumerate(keep))

    def fingerprint(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = Parser()
        for batch in batches:
            found = [written(parser.sketch(text or "")) for text in batch.column(0).to_pylist()]
            columns = [*batch.columns[1:], pa.array(found, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*(f"c{k}" for k in range(len(keep))), "fingerprint"])

    chosen = df.select(F.col(text_col).alias("text"), *(F.col(name).alias(f"c{k}") for k, name in enumerate(keep)))
    return chosen.mapInArrow(fingerprint, f"{schema}, fingerprint string").toDF(*keep, "fingerprint")


def with_following(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(range, guest, place, id, text) so dealt and sorted that each row's follower in descending id comes next.

    Ids are cut into ranges. The first row of a range also goes to the end of the range before as a guest, and the very
    first to the end of the last, so a follower is never in another task; texts are shuffled once. The number of ranges is that of
    the partitions times ``RANGES``; for each, one bound and one id are known to the driver. Of equal ids the lesser text comes
    first; null ids come last.
    """
    rows = df.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(2**63))).alias("place"),
        F.col(id_col).alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    count = RANGES * partitions(df.sparkSession)
    known = df.select(F.col(id_col).cast("bigint").alias("place")).filter("place IS NOT NULL")
    bounds = sorted({int(x) for x in known.approxQuantile("place", [k / count for k in range(1, count)], 0.2 / count)})
    above = F.array(*map(F.lit, bounds)).cast("array<bigint>") if bounds else F.array().cast("array<bigint>")
    rows = rows.withColumn("range", F.size(F.filter(above, lambda bound: bound > F.col("place"))))
    heads = sorted((r["range"], r["head"]) for r in rows.groupBy("range").agg(F.max("place").alias("head")).collect())
    guests = [(heads[k - 1][0], place) for k, (_, place) in enumerate(heads)]
    invited = df.sparkSession.createDataFrame(guests, "range int, place bigint")
    extra = rows.drop("range").join(F.broadcast(invited), "place").withColumn("guest", F.lit(True))
    dealt = rows.withColumn("guest", F.lit(False)).unionByName(extra.select(*rows.columns, "guest"))
    dealt = dealt.repartition(partitions(df.sparkSession), "range")
    return dealt.sortWithinPartitions("range", "guest", F.desc("place"), "text").select("range", "guest", "id", "text")


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by the first half as long, or all, of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compared(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of each row."""
    kind = df.schema[id_col].dataType.simpleString()

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        parser = Parser()
        names = ["id", "n", "sha", "own", "other", "near_edited", "near_next"]
        kinds = [None, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        last = None  # range, id, text and sketch of the row that waits for its follower
        for batch in batches:
            kinds[0] = batch.schema.field(2).type
            columns = [c.to_pylist() for c in batch.columns]
            pairs = []  # (waiting row, sketch of its follower, edited text)
            for place, guest, key, text, sketch in zip(*columns, parser.sketches(columns[3]), strict=True):
                if last is not None and last[0] == place:
                    pairs.append((last, sketch, edited(last[2], text)))
                last = None if guest else (place, key, text, sketch)
            rows = [
                (
                    own[1], len(own[2]), hashlib.sha256(changed.encode()).hexdigest(), written(own[3]),
                    written(other), likeness(own[3], other), likeness(own[3], sketch),
                )
                for (own, sketch, changed), other in zip(pairs, parser.sketches([p[2] for p in pairs]), strict=True)
            ]
            if rows:
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"id {kind}, n bigint, sha string, own string, other string, near_edited double, near_next double"
    found = with_following(df, id_col, text_col).mapInArrow(compare, schema)
    return found.toDF(
        id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"
    )
