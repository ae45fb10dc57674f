"""Removal of repeated passages: every word window that has occurred before goes, the rest of the text stays.

A window is ``WINDOW`` consecutive words of one text. It is named by its Rabin-Karp hash: words are hashed to 64 bits, and
the polynomial of a window is the difference of two running sums. A window is repeated if the same hash also starts at a
smaller place, places being ordered by (id, start). Repeated windows of a text are merged into maximal intervals of words,
which are removed. Windows are judged on the texts as given, not on what is left.

How the windows meet:

* A task cuts its texts into chunks of about ``CHUNK`` windows. Within a chunk, all but the first place of a hash are known to
  be repeated at once, so a passage that a third of all texts share leaves a chunk once for each of its windows.
* The first places travel to ``buckets`` by hash, packed: a row for each chunk and bucket. The number of buckets grows with the
  bytes of text, so a bucket holds a few million windows at any size of the table. The least place of each hash is found there.
* What is repeated goes back to its chunk as window numbers, a byte or two each, and becomes intervals of words per text.
* The intervals are joined to the texts by (id, hash of the text); only they and the texts are shuffled.

Words are runs of characters other than blank and 0x09-0x0D, unchanged. A null text has no words; texts of fewer words than a
window are kept whole. Rows are not merged: repeated rows of an id are at the same places, so neither is earlier than the
other, and unlike texts of one id are compared by their starts. A null id comes after all others. Columns other than the id and
the text are not read. 64-bit hashes are taken as the windows: among n windows of different wording n**2 / 2**65 chance
matches are to be expected, which is below one up to some 30 GB of text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm.shared import partitions, released

WINDOW = 20
# Windows of a chunk, and of a bucket on average, with words of 5 bytes.
CHUNK = 1_000_000
BUCKET = 2_000_000
# Bytes of text that are split into words at once.
BLOCK_BYTES = 4 << 20
# A null id is placed after all others.
LAST = (1 << 63) - 1
PACKED = "bucket int, chunk bigint, kind int, packed binary"
REMOVED = "_key bigint, _same bigint, _starts array<int>, _ends array<int>"

_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = np.uint64(0xD6E8FEB86659FD93)
_LONG_WORD = 4096


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * _MIX
    values = (values ^ (values >> np.uint64(32))) * _MIX
    return values ^ (values >> np.uint64(32))


def word_places(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of texts that lie one after another in ``data``; no word spans two texts."""
    solid = (data != 32) & ((data < 9) | (data > 13))
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    before = np.empty(len(data), bool)
    before[:1], before[1:] = False, solid[:-1]
    after = np.empty(len(data), bool)
    after[-1:], after[:-1] = False, solid[1:]
    return np.flatnonzero(solid & (~before | cut[:-1])), np.flatnonzero(solid & (~after | cut[1:])) + 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64 bits for each word, eight bytes of all words at a time."""
    from hashlib import blake2b

    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), np.dtype("<u8"), padded, 0, (1,))
    length = ends - starts
    hashes = _mixed(length.astype(np.uint64))
    some, at = np.arange(len(starts)), starts
    long = length > _LONG_WORD
    for k in np.flatnonzero(long):
        hashes[k] = int.from_bytes(blake2b(data[starts[k] : ends[k]].tobytes(), digest_size=8).digest(), "little")
    if long.any():
        some = np.flatnonzero(~long)
        at = starts[some]
    while some.size:
        left = np.minimum(ends[some] - at, 8).astype(np.uint64)
        lane = eight[at] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - np.uint64(8) * left))
        hashes[some] = _mixed(hashes[some] * _BASE + lane)
        at = at + 8
        more = ends[some] > at
        some, at = some[more], at[more]
    return hashes


def window_hashes(words: np.ndarray, window: int, step: int = 1 << 20) -> np.ndarray:
    """The polynomial of every window of consecutive words, modulo 2**64 and then mixed."""
    count = max(0, len(words) - window + 1)
    out = np.empty(count, np.uint64)
    size = min(step, count) + window
    power = np.cumprod(np.full(size, _BASE))
    inverse = np.cumprod(np.full(size, _UNBASE))
    for at in range(0, count, step):
        part = words[at : at + step + window - 1]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * power[: len(part)], out=sums[1:])
        found = len(part) - window + 1
        out[at : at + found] = (sums[window:] - sums[:found]) * inverse[:found]
    return _mixed(out)


def text_windows(data: np.ndarray, offsets: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and start of the windows of texts in ``data``, one text after another, and the number of windows of each text."""
    starts, ends = word_places(data, offsets)
    first = np.searchsorted(starts, offsets)
    n_words = np.diff(first)
    hashes = window_hashes(word_hashes(data, starts, ends), window)
    n_windows = np.maximum(n_words - window + 1, 0)
    place = np.arange(n_windows.sum()) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
    return hashes[np.repeat(first[:-1], n_windows) + place], place, n_windows


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes, planes of bytes together, compressed."""
    import pickle

    import zstandard

    planes = [(a.dtype.str, len(a), np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()) for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(planes))


def _unpack(packed: bytes) -> list[np.ndarray]:
    import pickle

    import zstandard

    planes = pickle.loads(zstandard.ZstdDecompressor().decompress(packed))
    out = []
    for kind, n, data in planes:
        width = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, n).T).reshape(-1).view(kind))
    return out


def _steps(values: np.ndarray) -> np.ndarray:
    return np.diff(values, prepend=values.dtype.type(0))


def _first_places(order: np.ndarray, new: np.ndarray) -> np.ndarray:
    """For each entry of a sorted order, the entry that its run begins with."""
    return order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]


class _Chunk:
    """Texts and their windows until there are enough of them."""

    def __init__(self, window: int, buckets: int) -> None:
        self.window, self.buckets = window, buckets
        self.docs: dict[tuple[int, int], int] = {}
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, ids: list[int], same: list[int], data: np.ndarray, offsets: np.ndarray) -> None:
        # Of equal rows one is enough, as all have the same windows at the same places.
        fresh = np.zeros(len(ids), bool)
        numbers = np.zeros(len(ids), np.int64)
        for k, doc in enumerate(zip(ids, same, strict=True)):
            if doc not in self.docs:
                fresh[k], numbers[k] = True, len(self.docs)
                self.docs[doc] = len(self.docs)
        hashes, place, n_windows = text_windows(data, offsets, self.window)
        place, which, chosen = place.astype(np.int32), np.repeat(numbers.astype(np.int32), n_windows), np.repeat(fresh, n_windows)
        if not fresh.all():
            hashes, place, which = hashes[chosen], place[chosen], which[chosen]
        self.parts.append((hashes, place, which))
        self.size += len(hashes)

    def rows(self, number: int) -> Iterator[tuple[int, int, int, bytes]]:
        """(bucket, chunk, kind, packed): the places for each bucket as kind 0, what the chunk knows by itself as kind 1."""
        hashes, place, which = (np.concatenate(a) for a in zip(*self.parts, strict=True))
        self.parts.clear()
        keys = np.array(list(self.docs), np.int64).reshape(-1, 2)
        n_windows = np.bincount(which, minlength=len(keys))
        base = np.cumsum(n_windows) - n_windows
        _, rank = np.unique(keys[:, 0], return_inverse=True)
        ordinal = base[which] + place
        places = (rank[which].astype(np.int64) << 32) | place
        if (places[1:] < places[:-1]).any():
            order = np.argsort(places, kind="stable")
            hashes, place, which, ordinal, places = (a[order] for a in (hashes, place, which, ordinal, places))
        order = np.argsort(hashes, kind="stable")
        new = np.ones(len(order), bool)
        new[1:] = hashes[order[1:]] != hashes[order[:-1]]
        repeated = np.zeros(len(order), bool)
        repeated[order] = places[order] > places[_first_places(order, new)]
        gone = np.sort(ordinal[repeated])
        yield number % self.buckets, number, 1, _pack(keys[:, 0], keys[:, 1], n_windows, _steps(gone).astype(np.int32))

        first = np.flatnonzero(~repeated)
        hashes, place, which, ordinal = hashes[first], place[first], which[first], ordinal[first]
        bucket = (hashes % np.uint64(self.buckets)).astype(np.int32)
        hashes = hashes // np.uint64(self.buckets)
        order = np.argsort(bucket, kind="stable")
        bounds = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        for b in np.flatnonzero(np.diff(bounds)):
            own = order[bounds[b] : bounds[b + 1]]
            docs = which[own]
            runs = np.flatnonzero(np.diff(docs, prepend=-1))
            yield int(b), number, 0, _pack(
                hashes[own],
                _steps(ordinal[own]).astype(np.int32),
                np.diff(runs, append=len(own)).astype(np.int32),
                keys[docs[runs], 0],
                place[own[runs]].astype(np.int32),
            )


def _table(rows: Iterable[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


_PACKED = (["bucket", "chunk", "kind", "packed"], [pa.int32(), pa.int64(), pa.int32(), pa.binary()])


def _chunked(window: int, buckets: int, chunk_size: int):
    """Task function: (_key, _same, _text) to the packed windows of chunks."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done = TaskContext.get().partitionId(), 0
        chunk = _Chunk(window, buckets)
        for batch in batches:
            ids, same = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            texts = batch.column(2).cast(pa.large_binary())
            offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
            data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
            at = 0
            while at < len(texts):
                end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BLOCK_BYTES, "right")) - 1)
                chunk.add(ids[at:end], same[at:end], data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at])
                at = end
                if chunk.size >= chunk_size:
                    yield _table(chunk.rows((part << 32) | done), *_PACKED)
                    chunk, done = _Chunk(window, buckets), done + 1
        if chunk.parts:
            yield _table(chunk.rows((part << 32) | done), *_PACKED)

    return run


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function of one bucket: all places that are not the least of their hash, as window numbers of their chunks."""
    chunks: list[int] = []
    hashes, ids, places, ordinals, sizes = [], [], [], [], []
    for batch in batches:
        own = pa.compute.equal(batch.column("kind"), 1)
        passed = batch.filter(own)
        if passed.num_rows:
            yield passed
        for row in batch.filter(pa.compute.invert(own)).to_pylist():
            h, steps, runs, doc, start = _unpack(row["packed"])
            ordinal = np.cumsum(steps, dtype=np.int64)
            first = np.cumsum(runs) - runs
            chunks.append(row["chunk"])
            hashes.append(h)
            ordinals.append(ordinal.astype(np.int32))
            ids.append(np.repeat(doc, runs))
            places.append((ordinal - np.repeat(ordinal[first] - start, runs)).astype(np.int32))
            sizes.append(len(h))
    if not chunks:
        return
    h = np.concatenate(hashes)
    hashes.clear()
    order = np.argsort(h)
    equal = h[order[1:]] == h[order[:-1]]
    shared = np.zeros(len(h), bool)
    shared[:-1] |= equal
    shared[1:] |= equal
    some = order[shared]
    h, doc, start = h[some], np.concatenate(ids)[some], np.concatenate(places)[some]
    order = np.lexsort((start, doc, h))
    some, h, doc, start = some[order], h[order], doc[order], start[order]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    first = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
    gone = np.sort(some[(doc != doc[first]) | (start != start[first])])
    ends = np.cumsum(sizes)
    bounds = np.searchsorted(gone, np.concatenate([[0], ends]))
    every = np.concatenate(ordinals)
    rows = [
        (0, chunk, 0, _pack(_steps(np.sort(every[gone[a:b]]))))
        for chunk, a, b in zip(chunks, bounds[:-1], bounds[1:], strict=True)
        if b > a
    ]
    if rows:
        yield _table(rows, *_PACKED)


def _intervals(window: int):
    """Task function over the rows of whole chunks, sorted by chunk: the intervals to remove from each text."""

    def merged(known: list[np.ndarray], found: list[np.ndarray]) -> pa.RecordBatch | None:
        key, same, n_windows, own = known
        gone = np.unique(np.concatenate([np.cumsum(steps, dtype=np.int64) for steps in [own, *found]]))
        if not gone.size:
            return None
        ends = np.cumsum(n_windows)
        doc = np.searchsorted(ends, gone, "right")
        start = gone - (ends - n_windows)[doc]
        new = np.ones(len(gone), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + window)
        last = np.append(new[1:], True)
        docs, count = np.unique(doc[new], return_counts=True)
        offsets = pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(a.astype(np.int32))) for a in (start[new], start[last] + window)]
        return pa.RecordBatch.from_arrays(
            [pa.array(key[docs]), pa.array(same[docs]), *lists], ["_key", "_same", "_starts", "_ends"]
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, known, found = None, None, []
        for batch in batches:
            for chunk, kind, packed in zip(*(batch.column(c).to_pylist() for c in ("chunk", "kind", "packed")), strict=True):
                if chunk != current:
                    if known is not None and (out := merged(known, found)) is not None:
                        yield out
                    current, known, found = chunk, None, []
                if kind:
                    known = _unpack(packed)
                else:
                    found += _unpack(packed)
        if known is not None and (out := merged(known, found)) is not None:
            yield out

    return run


def repeated_intervals(docs: DataFrame, window: int = WINDOW, chunk: int = CHUNK, buckets: int | None = None) -> DataFrame:
    """(_key, _same, _starts, _ends) of each text of ``docs`` (_key, _same, _text) that has repeated windows.

    Starts and ends are word numbers of maximal intervals, ascending; ends are exclusive.
    """
    spark = docs.sparkSession
    if buckets is None:
        size = docs.agg(F.sum(F.octet_length("_text").cast("bigint"))).first()[0] or 0
        buckets = max(partitions(spark), -(-size // (5 * BUCKET)))
    packed = docs.select("_key", "_same", "_text").mapInArrow(released(_chunked(window, buckets, chunk)), PACKED)
    counted = packed.repartitionById(buckets, "bucket").mapInArrow(released(_counted), PACKED)
    by_chunk = counted.repartition(partitions(spark), "chunk").sortWithinPartitions("chunk")
    # Equal rows of one id in several chunks give equal intervals.
    return by_chunk.mapInArrow(_intervals(window), REMOVED).dropDuplicates(["_key", "_same"])


def _kept(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: the words that are left of each text."""
    for batch in batches:
        n_words, n_removed, kept = [], [], []
        for text, starts, ends in zip(*(batch.column(c).to_pylist() for c in ("_text", "_starts", "_ends")), strict=True):
            words = text.encode().split()  # bytes are split at blanks and 0x09-0x0D and nowhere else
            n_words.append(len(words))
            for start, end in zip(reversed(starts or []), reversed(ends or []), strict=True):
                del words[start:end]
            n_removed.append(n_words[-1] - len(words))
            kept.append(b" ".join(words).decode())
        yield pa.RecordBatch.from_arrays(
            [batch.column("_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), batch.column("_starts"),
             batch.column("_ends"), pa.array(kept, pa.string())],
            ["id", "n_words", "n_removed", "starts", "ends", "kept"],
        )


def without_repeats(
    df: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK
) -> DataFrame:
    """(id, n_words, n_removed, starts, ends, kept) of each row: removed word intervals, and the other words joined by a blank.

    Where nothing is removed, starts and ends are null.
    """
    docs = df.select(
        F.col(id_col).cast("bigint").alias("_id"),
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(LAST)).alias("_key"),
        F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
    ).withColumn("_same", F.xxhash64("_text"))
    joined = docs.join(repeated_intervals(docs, window, chunk), ["_key", "_same"], "left")
    return joined.select("_id", "_text", "_starts", "_ends").mapInArrow(
        _kept, "id bigint, n_words bigint, n_removed bigint, starts array<int>, ends array<int>, kept string"
    )
