"""Exact Jaccard join of word n-gram sets, as components of linked documents.

Words are lower-cased (A-Z) and split at white space; a document's set holds the 64-bit hashes of its distinct n-grams.
Two documents link when their sets' Jaccard coefficient reaches the threshold. The steps:

1. Texts with equal sets form a class with a number of its own (its node), and one text stands for it. All that follows
   joins nodes, each of which is there once, however many rows and texts its id has.
2. A first pass links what shares the least hash of its set: documents are dealt by it into bounded tiles, and only a
   document's link to its tile is kept. This joins most copies without any pair being written down. Steps 3 to 5 are first
   done with the next ``LEADS`` least hashes only, which leaves few documents of one component apart, then with all.
3. The prefix rule gives all other candidates: linked sets share one of their first hashes, as many as the threshold says,
   in any order of the hashes that is the same for all sets. The order is ascending, with hashes that many documents share
   at the end, so that common passages bring few documents together. Prefix hashes whose documents are already joined are dropped, and those with the same documents count once.
4. What shares a prefix hash is dealt into tiles by size band, a document also as a guest of the next larger band, since
   linked sets differ in size by a bounded factor. A tile with many documents is cut into blocks of bounded rows and
   bytes that are compared two by two. A bitmap of the parities of hashed buckets bounds the overlap from above: each bit in
   which two bitmaps differ is an element that only one set has. No pair is written down, only which documents of a tile
   have a partner left.
5. For those the sets are fetched and intersected as sorted arrays, again skipping what is joined already.

So no link between different texts is lost, although a group of copies costs about one comparison per document.

A null or empty text has an empty set and links with nothing. A text of fewer than ``N`` words has its whole sequence as its one
element. Rows with equal ids are one document whose texts all count, each as a set of its own; they are joined at the end.
A null id links with nothing and has a null component.
Exact copies and repeated rows get the same component. Other columns are ignored. An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlog.llm.components import components
from emberlog.llm.shared import checkpointed, hinted, partitions, released, sealed, small_batches, small_enough, unsealed

N = 5
#: The threshold as a fraction.
PART, WHOLE = 3, 4
#: A block of a tile holds at most about so many documents and so many bytes of sets.
BLOCK_ROWS, BLOCK_BYTES = 2048, 32 << 20
#: An element is common when so many different sets have it in their prefixes, counted where several looked at together do.
COMMON, COMMON_MOST = 4, 500_000
#: A task looks for such elements among so many sets at a time.
COUNTED_SETS = 8192
#: So many hashes of each set, after the least, are tried for joining it before all other candidates.
LEADS = 3

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sets of n-gram hashes, sorted."""

    def __init__(self):
        self.letters = mixed(np.arange(1, 257, dtype=np.uint64) * MULTIPLIER)
        self.letters[[9, 10, 11, 12, 13, 32]] = 0
        self.powers = np.ones(1, np.uint64)

    def words(self, data: np.ndarray) -> np.ndarray:
        """A hash of each word of lower-cased UTF-8."""
        blank = np.zeros(len(data) + 1, bool)
        blank[:-1] = self.letters[data] == 0
        blank[-1] = True
        starts = np.flatnonzero(~blank[:-1] & np.r_[True, blank[:-2]]) if len(data) else np.zeros(0, np.int64)
        if not len(starts):
            return np.zeros(0, np.uint64)
        lengths = np.diff(np.r_[starts, len(data)])
        place = np.arange(starts[0], len(data)) - np.repeat(starts, lengths)
        longest = int(lengths.max())
        if len(self.powers) < longest:
            self.powers = np.cumprod(np.r_[np.uint64(1), np.full(2 * longest, MULTIPLIER)])
        terms = self.letters[data[starts[0] :]] * self.powers[place]
        return mixed(np.add.reduceat(terms, starts - starts[0]))

    def __call__(self, text: str | None) -> np.ndarray:
        data = np.frombuffer((text or "").encode().lower(), np.uint8)
        with np.errstate(over="ignore"):
            words = self.words(data)
            size = min(N, len(words))
            if not size:
                return words
            grams = np.full(len(words) - size + 1, size, np.uint64)
            for k in range(size):
                grams = grams * MULTIPLIER + words[k : len(words) - size + 1 + k]
            return np.unique(mixed(grams))


def class_key(hashes: np.ndarray) -> bytes:
    """What names a set that is not empty."""
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def prefix_size(n: int) -> int:
    """So many of its least elements a set may need to share one with every set that it links with."""
    return n - -(-n * PART // WHOLE) + 1


def bitmap(hashes: np.ndarray, width: int) -> np.ndarray:
    """The parities of ``width`` buckets, a power of two from 64 on, as 64-bit words."""
    counts = np.bincount((hashes & np.uint64(width - 1)).astype(np.int64), minlength=width)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").view(np.uint64)


def fitting_width(n: int) -> int:
    return max(64, 1 << (2 * n - 1).bit_length())


def folded(words: np.ndarray, width: int) -> np.ndarray:
    """A bitmap reduced to ``width`` buckets; parities add up."""
    while len(words) * 64 > width:
        half = len(words) // 2
        words = words[:half] ^ words[half:]
    return words


def possible(sizes: np.ndarray, size: int, differing: np.ndarray) -> np.ndarray:
    """Whether sets of ``sizes`` can link with one of ``size``, if at least ``differing`` elements are in one set only."""
    smaller, larger = np.minimum(sizes, size), np.maximum(sizes, size)
    return (WHOLE * smaller >= PART * larger) & ((WHOLE + PART) * differing <= (WHOLE - PART) * (sizes + size))


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """The number of common elements of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    common = overlap(a, b)
    return WHOLE * common >= PART * (len(a) + len(b) - common)


def join_within(sets: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Labels after linking all sets that are not joined yet; a joined group has its least label."""
    sizes = np.array([len(x) for x in sets])
    order = np.argsort(sizes, kind="stable")
    sizes, sets, labels = sizes[order], [sets[k] for k in order], labels[order].copy()
    maps = None
    if len(sets) > 2:
        width = fitting_width(int(sizes[-1]))
        maps = np.stack([bitmap(x, width) for x in sets])
    for k in range(len(sets) - 1):
        end = int(np.searchsorted(sizes, sizes[k] * WHOLE // PART, side="right"))
        others = np.arange(k + 1, end)
        others = others[labels[k + 1 : end] != labels[k]]
        if maps is not None and len(others):
            differing = np.bitwise_count(maps[others] ^ maps[k]).sum(axis=1, dtype=np.int64)
            fits = possible(sizes[others], int(sizes[k]), differing)
            others = others[fits][np.argsort(differing[fits], kind="stable")]
        for other in others.tolist():
            if labels[other] != labels[k] and linked(sets[k], sets[other]):
                least, gone = sorted((labels[k], labels[other]))
                labels[labels == gone] = least
    result = np.empty_like(labels)
    result[order] = labels
    return result


def survivors(sizes: np.ndarray, labels: np.ndarray, maps: list[np.ndarray], owner: np.ndarray, side: np.ndarray) -> np.ndarray:
    """Which documents of a block have a partner that is not joined with them and that the bitmaps don't rule out.

    At least one of a pair is an owner. ``side`` is 0 and 1 for the two parts of a block whose inner pairs other blocks
    compare, and 2 where all pairs count.
    """
    width = min(len(x) for x in maps) * 64
    table = np.stack([folded(x, width) for x in maps])
    alive = np.zeros(len(sizes), bool)
    order = np.argsort(sizes, kind="stable")
    sizes, labels, table, owner, side = sizes[order], labels[order], table[order], owner[order], side[order]
    for k in range(len(sizes) - 1):
        end = int(np.searchsorted(sizes, sizes[k] * WHOLE // PART, side="right"))
        span = slice(k + 1, end)
        wanted = (labels[span] != labels[k]) & (owner[span] | owner[k]) & ((side[span] != side[k]) | (side[k] == 2))
        others = np.flatnonzero(wanted) + k + 1
        if len(others):
            differing = np.bitwise_count(table[others] ^ table[k]).sum(axis=1, dtype=np.int64)
            others = others[possible(sizes[others], int(sizes[k]), differing)]
            alive[others] = True
            alive[k] |= len(others) > 0
    result = np.empty_like(alive)
    result[order] = alive
    return result


def by_group(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """The groups of rows with equal leading ``keys`` (numbers) out of sorted batches, as tables."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)])
        starts = np.r_[0, np.flatnonzero((columns[:, 1:] != columns[:, :-1]).any(axis=0)) + 1, batch.num_rows]
        for start, end in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            key = tuple(columns[:, start].tolist())
            if key != last and held:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def with_sets(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` (numbers) and the set of column ``text`` (hashes array<bigint>)."""

    def shingle(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                sets = [pa.array(shingler(text).view(np.int64)) for text in part.column(0).to_pylist()]
                ends = np.cumsum([0, *map(len, sets)])
                values = pa.concat_arrays(sets) if sets else pa.array([], pa.int64())
                hashes = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
                yield pa.RecordBatch.from_arrays([*part.columns[1:], hashes], [*keep, "hashes"])

    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"{name} {kinds[name]}" for name in keep), "hashes array<bigint>"])
    return docs.select("text", *keep).mapInArrow(released(shingle), schema)


def summaries(docs: DataFrame) -> DataFrame:
    """(id, n, key, first, prefix, bits) of each row of (id, text); key and what follows are null for empty sets.

    Besides, there are rows for the elements that several sets looked at together have in their prefixes: their number
    negated as n, and the elements that so many have as the prefix.
    """

    def summarise(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        names = ["id", "n", "key", "first", "prefix", "bits"]
        kinds = [pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
        prefixes: dict[bytes, np.ndarray] = {}

        def several() -> Iterator[pa.RecordBatch]:
            if prefixes:
                values, counts = np.unique(np.concatenate(list(prefixes.values())), return_counts=True)
                prefixes.clear()
                for count in np.unique(counts[counts > 1]).tolist():
                    marker = (None, -count, None, None, values[counts == count], None)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x], t) for x, t in zip(marker, (pa.int64(), *kinds), strict=True)], names
                    )

        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                rows = []
                for text in part.column(1).to_pylist():
                    found = shingler(text)
                    n = len(found)
                    if n:
                        prefix = found[: prefix_size(n)].view(np.int64).copy()
                        key = class_key(found)
                        prefixes[key] = prefix
                        rows.append((n, key, int(prefix[0]), prefix, bitmap(found, fitting_width(n)).tobytes()))
                    else:
                        rows.append((0, None, None, None, None))
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names)
            if len(prefixes) >= COUNTED_SETS:
                yield from several()
        yield from several()

    schema = "id bigint, n bigint, key binary, first bigint, prefix array<bigint>, bits binary"
    return docs.select("id", "text").mapInArrow(released(summarise), schema)


def with_keys(docs: DataFrame, text_col: str) -> DataFrame:
    """The rows with the key of their text's set as ``key``; null for an empty set."""
    names = docs.columns
    place = names.index(text_col)

    def keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                sets = (shingler(text) for text in part.column(place).to_pylist())
                keys = pa.array([class_key(found) if len(found) else None for found in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, keys], [*names, "key"])

    return docs.mapInArrow(released(keyed), T.StructType([*docs.schema.fields, T.StructField("key", T.BinaryType())]))


def repeated_ids(base: DataFrame) -> DataFrame:
    """(id) of several rows."""
    counted = base.filter("id IS NOT NULL").groupBy("id").agg(F.count("*").alias("rows"))
    return checkpointed(counted.filter("rows > 1").select("id"))


def numbered(classes: DataFrame) -> DataFrame:
    """classes with their node: the id, or for all but the first class of an id a number made of the key."""
    several = classes.groupBy("id").agg(F.min("key").alias("main"), F.count("*").alias("c")).filter("c > 1")
    several = hinted(checkpointed(several.select("id", "main")))
    first = F.col("main").isNull() | (F.col("main") == F.col("key"))
    return classes.join(several, "id", "left").withColumn("node", F.when(first, F.col("id")).otherwise(F.xxhash64("key"))).drop("main")


def one_of_each(docs: DataFrame, filled: DataFrame, classes: DataFrame, repeated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id, text) and (id, prefix, bits) with one row of each class, whose node is the id."""
    if repeated.isEmpty():
        return docs, filled.select("id", "prefix", "bits").join(hinted(classes.select("id")), "id", "left_semi")
    single = hinted(repeated)
    among = hinted(checkpointed(classes.join(single, "id", "left_semi").select("id", "key", "node")))
    several = with_keys(docs.join(single, "id", "left_semi").select("id", "text"), "text")
    texts = several.join(among, ["id", "key"]).groupBy("node").agg(F.min("text").alias("text"))
    texts = checkpointed(texts.select(F.col("node").alias("id"), "text"))
    described = filled.select("id", "key", "prefix", "bits").join(among, ["id", "key"])
    described = described.select(F.col("node").alias("id"), "prefix", "bits").dropDuplicates(["id"])
    alone = filled.select("id", "prefix", "bits").join(single, "id", "left_anti")
    alone = alone.join(hinted(classes.select("id")), "id", "left_semi")
    rest = docs.select("id", "text").join(single, "id", "left_anti")
    return rest.unionByName(texts), alone.unionByName(checkpointed(described))


def common_elements(base: DataFrame) -> np.ndarray:
    """Elements that many documents share, ascending; the commonest ``COMMON_MOST`` of them.

    They only shape the order in which prefixes are taken, and any set of them gives the same links.
    """
    found = base.filter("n < 0").select(F.explode("prefix").alias("token"), (-F.col("n")).alias("sets"))
    counted = found.groupBy("token").agg(F.sum("sets").alias("sets")).filter(F.col("sets") >= COMMON)
    rows = counted.orderBy(F.desc("sets"), "token").limit(COMMON_MOST).select("token").toPandas()
    return np.sort(rows["token"].to_numpy(np.int64))


def contained(values: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    """Which values are in an ascending array."""
    at = np.searchsorted(ascending, values)
    at[at == len(ascending)] = 0
    return ascending[at] == values


def rare_first(docs: DataFrame, heavy: DataFrame, common: np.ndarray) -> DataFrame:
    """heavy (id, prefix, bits) with prefixes in an order that puts the common elements last.

    A prefix without any of them is the same in both orders. The others are taken anew from the texts.
    """
    if not len(common):
        return heavy

    def touched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefixes = batch.column(1)
            ends = np.cumsum(np.r_[0, contained(prefixes.values.to_numpy(), common)])[prefixes.offsets.to_numpy()]
            yield batch.select([0]).filter(pa.array(ends[1:] > ends[:-1]))

    again = checkpointed(heavy.select("id", "prefix").mapInArrow(released(touched), "id bigint").distinct())

    def anew(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                rows = []
                for key, text in zip(part.column(1).to_pylist(), part.column(0).to_pylist(), strict=True):
                    found = shingler(text)
                    if len(found):
                        last = contained(found.view(np.int64), common)
                        ordered = np.concatenate([found[~last], found[last]])[: prefix_size(len(found))]
                        rows.append((key, ordered.view(np.int64), bitmap(found, fitting_width(len(found))).tobytes()))
                if rows:
                    kinds = [pa.int64(), pa.list_(pa.int64()), pa.binary()]
                    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, ["id", "prefix", "bits"])

    few = hinted(again)
    texts = docs.join(few, "id").select("text", "id")
    renewed = checkpointed(texts.mapInArrow(released(anew), "id bigint, prefix array<bigint>, bits binary"))
    return heavy.join(few, "id", "left_anti").unionByName(renewed)


def blocks(count, total):
    """Into how many parts a tile is cut."""
    by_bytes = F.ceil(total * 8 / BLOCK_BYTES)
    return F.greatest(F.lit(1), F.ceil(count / BLOCK_ROWS), by_bytes).cast("int")


def in_tiles(df: DataFrame, keys: list[str], function: Callable, schema: str) -> DataFrame:
    """``function`` on the batches of each partition, in which the rows of a tile follow one another."""
    dealt = df.repartition(partitions(df.sparkSession), *keys)
    return dealt.sortWithinPartitions(*keys).mapInArrow(released(function), schema)


def joined_by_token(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """(a, b): links between documents that share their token; rows has (token, id, n).

    Only a link of each document to its part of the tile is found here, and parts of a cut tile aren't compared.
    """
    crowded = rows.groupBy("token").agg(F.count("*").alias("c"), F.sum("n").alias("s")).filter("c > 1")
    dealt = rows.join(crowded, "token").select(
        "token", "id", F.pmod(F.xxhash64("id"), blocks(F.col("c"), F.col("s"))).cast("int").alias("block")
    )
    dealt = checkpointed(dealt)
    sets = with_sets(docs.join(hinted(dealt), "id"), ["token", "block", "id"])

    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_group(batches, 2):
            yield changes(numbers(table, "id"), table.column("hashes"))

    links = in_tiles(sets, ["token", "block"], join, "a bigint, b bigint").distinct()
    return checkpointed(links)


def changes(comps: np.ndarray, hashes: pa.ChunkedArray) -> pa.RecordBatch:
    """(a, b) of the components that the sets' links join to others."""
    found = [x.values.to_numpy().view(np.uint64) for x in hashes]
    after = join_within(found, comps)
    changed = after != comps
    return pa.RecordBatch.from_arrays([pa.array(comps[changed]), pa.array(after[changed])], ["a", "b"])


def merged_by(known: DataFrame, links: DataFrame) -> DataFrame:
    """known (id, n, comp) with each component renamed to the least that it is linked to directly."""
    least = links.groupBy("a").agg(F.min("b").alias("b"))
    joined = known.join(hinted(least), F.col("comp") == F.col("a"), "left")
    return checkpointed(joined.select("id", "n", F.coalesce("b", "comp").alias("comp")))


def in_bands(members: DataFrame) -> DataFrame:
    """Each member of a token's documents as an owner in its size band and as a guest in the next larger one.

    The first common element of two linked sets lies early in the order of the smaller one: at most a share of
    (WHOLE - PART) / (WHOLE + PART) of its elements come before. Only there (``early``) can a document be a guest.
    """
    # ln(WHOLE / PART) is the width of a band, so linked sets lie in one band or in neighbours.
    band = F.floor(F.log(F.col("n").cast("double")) / float(np.log(WHOLE / PART)) + 1e-9).cast("int")
    early = F.col("place") * (WHOLE + PART) <= F.col("n") * (WHOLE - PART)
    own = F.struct(band.alias("band"), F.lit(True).alias("owner"), early.alias("early"))
    guest = F.struct((band + 1).alias("band"), F.lit(False).alias("owner"), early.alias("early"))
    return members.select("*", F.inline(F.when(early, F.array(own, guest)).otherwise(F.array(own)))).drop("place")


def further_links(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """(a, b): links between the components of documents that share a token; rows has (id, n, comp, bits, tokens)."""
    tokens = rows.select("id", "n", "comp", F.posexplode("tokens").alias("place", "token"))
    shared = tokens.groupBy("token").agg(
        F.count("*").alias("c"), F.sum("n").alias("s"), F.bit_xor(F.xxhash64("id")).alias("who"),
        F.min("comp").alias("low"), F.max("comp").alias("high"), F.sum("place").alias("places"),
    ).filter("low <> high")
    # A document is there once, so nothing cancels out. Of hashes with the very same documents the first is enough; it comes first in all of them.
    shared = shared.groupBy("c", "who").agg(F.min_by("token", "places").alias("token"), F.max("s").alias("s"))
    shared = checkpointed(shared.select("token", blocks(F.col("c"), F.col("s")).alias("parts")))
    few = small_enough(shared)
    hint = F.broadcast(shared) if few else shared
    # Bitmaps only go where an owner has company of another component.
    full = in_bands(tokens.join(hint, "token")).groupBy("token", "band").agg(
        F.max("owner").alias("owned"), F.max("early").alias("early"), F.min("comp").alias("low"), F.max("comp").alias("high")
    ).filter("owned AND early AND low <> high")
    full = hinted(checkpointed(full.select("token", "band")))
    if few:
        wide = rows.select("id", "n", "comp", "bits", F.posexplode("tokens").alias("place", "token"))
        members = in_bands(wide.join(hint, "token")).join(full, ["token", "band"])
    else:
        members = in_bands(tokens.join(hint, "token")).join(full, ["token", "band"])
        members = members.join(rows.select("id", "bits"), "id")
    members = members.withColumn("own", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    members = members.select(
        F.xxhash64("token", "band", F.least("own", "other"), F.greatest("own", "other")).alias("tile"),
        "id", "n", "comp", "bits", "owner",
        F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"),
    )

    def filtered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_group(batches, 1):
            comps = numbers(table, "comp")
            owner = table.column("owner").to_numpy()
            if table.num_rows < 2 or not owner.any() or (comps == comps[0]).all():
                continue
            maps = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("bits")]
            alive = survivors(numbers(table, "n"), comps, maps, owner, numbers(table, "side"))
            if alive.any():
                chosen = table.filter(pa.array(alive)).select(["tile", "id", "comp"])
                ids = np.sort(numbers(chosen, "id"))
                who = int.from_bytes(hashlib.blake2b(ids.tobytes(), digest_size=8).digest(), "little", signed=True)
                for batch in chosen.to_batches():
                    yield pa.RecordBatch.from_arrays(
                        [*batch.columns, pa.array(np.full(batch.num_rows, who))], ["tile", "id", "comp", "who"]
                    )

    left = in_tiles(members, ["tile"], filtered, "tile bigint, id bigint, comp bigint, who bigint")
    left = checkpointed(left)
    kept = left.groupBy("who").agg(F.min("tile").alias("tile"))
    left = checkpointed(left.join(kept, ["who", "tile"]).select("tile", "id", "comp").distinct())
    sets = with_sets(docs.join(hinted(left), "id"), ["tile", "comp"])

    def verified(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_group(batches, 1):
            yield changes(numbers(table, "comp"), table.column("hashes"))

    return in_tiles(sets, ["tile"], verified, "a bigint, b bigint").distinct()


def ngram_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) of each row; see the module. Ids are integers."""
    with small_batches(df.sparkSession):
        return _components_of(df, id_col, text_col)


def _linked_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Of (id, text): the summary of each row, ids of several rows, classes (id, key, n, node) and links of nodes (a, b)."""
    summary = checkpointed(summaries(docs))
    base = summary.filter("n >= 0")
    filled = base.filter("key IS NOT NULL AND id IS NOT NULL")
    classes = filled.groupBy("key").agg(F.min("id").alias("id"), F.max("n").alias("n"), F.max("first").alias("token"))
    classes = checkpointed(numbered(checkpointed(classes)))
    repeated = repeated_ids(base)
    docs, heavy = one_of_each(docs, filled, classes, repeated)
    first = classes.select("token", F.col("node").alias("id"), "n")
    links = joined_by_token(docs, first)
    known = merged_by(first.select("id", "n", F.col("id").alias("comp")), links)

    def described(rows: DataFrame, tokens: Column) -> DataFrame:
        return rows.select("id", "bits", tokens.alias("tokens")).join(hinted(known), "id")

    # The least hash has been used above.
    more = checkpointed(further_links(docs, described(heavy, F.slice("prefix", 2, LEADS))))
    known = merged_by(known, more)
    rest = further_links(docs, described(rare_first(docs, heavy, common_elements(summary)), F.col("prefix")))
    joined = known.select(F.col("id").alias("a"), F.col("comp").alias("b")).filter("a <> b")
    return base, repeated, classes, links.union(more).union(rest).union(joined)


def _components_of(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    docs = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    base, repeated, classes, links = _linked_classes(docs)
    rows = base.join(hinted(classes.select("key", F.col("node").alias("class"))), "key", "left").select("id", "n", "class")
    if not repeated.isEmpty():
        # An id with several texts may stand in several classes, and its empty texts go with the others.
        spread = rows.join(hinted(repeated), "id").groupBy("id").agg(F.min("class").alias("low"))
        spread = checkpointed(spread.filter("low IS NOT NULL"))
        torn = rows.join(hinted(spread), "id").filter("class <> low").select(F.col("low").alias("a"), F.col("class").alias("b"))
        links = links.union(torn)
        rows = rows.join(hinted(spread), "id", "left").select("id", "n", F.coalesce("class", "low").alias("class"))
    labels = components(links)
    nodes = classes.select(F.col("id").alias("least"), "node")
    named = labels.join(nodes, "node").groupBy("label").agg(F.min("least").alias("component_id"))
    final = labels.join(hinted(named), "label").select(F.col("node").alias("class"), "component_id")
    final = nodes.withColumnRenamed("node", "class").join(final, "class", "left")
    final = final.select("class", F.coalesce("component_id", "least").alias("component_id"))
    joined = rows.join(hinted(final), "class", "left")
    alone = F.coalesce("component_id", "id")
    return joined.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), alone).alias("component_id"),
    )


def one_row_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each group of linked texts one row: of the least id, and of its rows the least by text, then by the other columns.

    Here the texts of one id are not taken together, so one that is unlike the others stays. Of an id's empty texts one row
    stays, and rows without an id all stay. All columns must have an order.
    """
    columns = df.columns
    rows = _one_row_of_each(sealed(df, id_col, text_col))
    return rows.select(*unsealed(columns, id_col, text_col))


def _one_row_of_each(df: DataFrame) -> DataFrame:
    id_col, text_col = "sealed_id", "sealed_text"
    with small_batches(df.sparkSession):
        key = F.col(id_col).cast("bigint")
        base, repeated, classes, links = _linked_classes(df.select(key.alias("id"), F.col(text_col).alias("text")))
        labels = components(links)
        first = labels.join(classes.select("id", "key", "node"), "node").groupBy("label").agg(
            F.min(F.struct("id", "key", "node")).alias("first")
        )
        gone = labels.join(first.select(F.col("first.node").alias("node")), "node", "left_anti").select("node")
        kept = classes.join(hinted(checkpointed(gone)), "node", "left_anti").select("id", "key")
        empty = base.filter("key IS NULL AND id IS NOT NULL").select("id", "key").distinct()
        kept = checkpointed(kept.unionByName(empty).withColumnRenamed("id", "_id"))
        nameless = df.filter(key.isNull())
        named = df.withColumn("_id", key)
        if repeated.isEmpty():
            return named.join(hinted(kept), "_id").select(*df.columns).unionByName(nameless)
        several = hinted(repeated.withColumnRenamed("id", "_id"))
        single = named.join(several, "_id", "left_anti").join(hinted(kept), "_id").select(*df.columns)
        keyed = with_keys(named.join(several, "_id", "left_semi").select("_id", *df.columns), text_col)
        wanted = hinted(kept.withColumnsRenamed({"_id": "_of", "key": "_key"}))
        keyed = keyed.join(wanted, (F.col("_id") == F.col("_of")) & F.col("key").eqNullSafe(F.col("_key")))
        order = F.struct(text_col, *(name for name in df.columns if name != text_col))
        chosen = keyed.groupBy("_id", "_key").agg(F.min(order).alias("row")).select("row.*").select(*df.columns)
        return single.unionByName(chosen).unionByName(nameless)
