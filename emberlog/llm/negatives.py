"""Hard negatives of anchors by exact inner product, searched in R-trees packed by sort-tile-recursive order.

Rows are packed by their coordinates: ranges of the first coordinate, within them ranges of the second, are the shards, each the
upper part of the tree and the unit of work; inside a shard the next coordinates cut it into tiles down to leaves of ``LEAF``
rows, ``FANOUT`` of which share a node. Every shard, node and leaf has its minimum bounding box. With an anchor, a box gives an
interval that holds the inner products of all its rows: each coordinate adds the anchor's component times the box's lower or
upper end.

A search asks for the first ``k`` rows (higher scores first, ties by smaller id) of the anchor's or of other labels with scores
in a window. Boxes are taken from a queue, the most promising first, and dropped when their interval misses all windows or
lies strictly below the k-th score found. The first round looks into the most promising shard of each anchor; the second into
all other shards whose interval still reaches the k-th score of the first. Nothing is approximate.

Anchors travel to shards, a copy for each shard that may matter to them; a shard with more than ``QUERIES`` anchors is copied, so that
neither side of a task grows with the table. The boxes of shards reach the driver in blocks of ``DIRECTORY_BYTES``, and anchors
are routed block by block.

Rows without an id or a label, without a vector, or with a component that is null take no part. Rows of one id count once; where
they differ, the least by (label, vector) counts. Shorter vectors are filled up with zeros. Ties are settled by id, and ids are
unique, so results are the same on every run. An empty table, or one without anchors, gives no rows. Scores beyond a double's
integers are computed with Python's, slowly; they must fit in a long. Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlog.llm.shared import checkpointed, hinted, partitions

LEAF = 64
FANOUT = 8
# Rows of a shard at most and at least, about.
SHARD = 8192
SMALL_SHARD = 1024
# Anchors of a task, and of a block that is searched at once.
QUERIES = 4096
BLOCK = 256
DIRECTORY_BYTES = 8 << 20
NONE = 1 << 62
_QUERY = "id bigint, label int, vec array<bigint>, lo array<bigint>, hi array<bigint>, floor array<bigint>"


def _matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    """Vectors as rows of a matrix, filled up with zeros; integers are exact."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    if (sizes == dim).all():
        return values.reshape(len(column), dim)
    out = np.zeros((len(column), dim), np.int64)
    rows = np.repeat(np.arange(len(column)), sizes)
    out[rows, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def _number_kind(a: np.ndarray, b: np.ndarray, rows: int):
    """float64 where all products of ``a`` and ``b`` are exact in it and their keys fit in 64 bits, else Python's integers."""
    most = [max(abs(int(m.max(initial=0))), abs(int(m.min(initial=0)))) for m in (a, b)]
    bound = most[0] * most[1] * a.shape[1]
    return np.float64 if bound < 1 << 53 and (bound + 1) * (rows + 1) < 1 << 62 else object


def _products(a: np.ndarray, b: np.ndarray, kind) -> np.ndarray:
    out = a.astype(kind) @ b.astype(kind).T
    return out.astype(np.int64) if kind is np.float64 else out


def _intervals(a: np.ndarray, low: np.ndarray, high: np.ndarray, kind) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each row of ``a`` with anything in each box."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    least = _products(up, low, kind) + _products(down, high, kind)
    return least, _products(up, high, kind) + _products(down, low, kind)


def packed_order(vectors: np.ndarray, ids: np.ndarray, first_axis: int, leaf: int = LEAF) -> list[np.ndarray]:
    """Sort-tile-recursive packing: rows of each leaf, leaves in the order of their tiles."""
    dim = vectors.shape[1]

    def tiles(rows: np.ndarray, axis: int, axes: int) -> list[np.ndarray]:
        pages = -(-len(rows) // leaf)
        if pages <= 1 or axes == 0:
            return [rows[k : k + leaf] for k in range(0, len(rows), leaf)]
        slabs = int(np.ceil(pages ** (1 / axes)))
        size = -(-pages // slabs) * leaf
        rows = rows[np.lexsort((ids[rows], vectors[rows, axis % dim]))]
        return [t for k in range(0, len(rows), size) for t in tiles(rows[k : k + size], axis + 1, axes - 1)]

    return tiles(np.arange(len(ids)), first_axis, min(max(dim, 0), 4))


class Tree:
    """The rows of one shard with the boxes of leaves and of nodes above them; node 0 is the root."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        order = np.argsort(ids)
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order]
        self.leaves = packed_order(self.vectors, self.ids, 2) if vectors.shape[1] else [
            np.arange(k, min(k + LEAF, len(ids))) for k in range(0, len(ids), LEAF)
        ]
        level = [(k, self.vectors[rows].min(0), self.vectors[rows].max(0)) for k, rows in enumerate(self.leaves)]
        # Numbered from the leaves on; children are numbers, of leaves below len(leaves).
        low, high = [b[1] for b in level], [b[2] for b in level]
        self.children: dict[int, list[int]] = {}
        while len(level) > 1:
            above = []
            for k in range(0, len(level), FANOUT):
                part = level[k : k + FANOUT]
                box = (len(low), np.min([b[1] for b in part], 0), np.max([b[2] for b in part], 0))
                self.children[box[0]] = [b[0] for b in part]
                low.append(box[1])
                high.append(box[2])
                above.append(box)
            level = above
        self.root = level[0][0]
        self.low, self.high = np.array(low), np.array(high)

    def search(
        self, own: np.ndarray, labels: np.ndarray, a: np.ndarray, lo: np.ndarray, hi: np.ndarray, floor: np.ndarray,
        k: int, same: bool,
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(query, window, score, row) of the first ``k`` rows of each window of each query that reach the floor."""
        n = len(self.ids)
        kind = _number_kind(a, self.vectors, n)
        number = np.int64 if kind is np.float64 else object
        nothing = -(NONE << 1) + 1 if kind is np.float64 else -(1 << 200)
        least, greatest = _intervals(a, self.low, self.high, kind)
        best = np.full((*lo.shape, k), nothing, number)
        reach = np.maximum(lo, floor)
        top = np.where(lo <= hi, hi, -NONE).max(1)

        def entry(node: int) -> tuple:
            return (-int(np.minimum(greatest[:, node], top).max()), node)

        queue = [entry(self.root)]
        while queue:
            node = heapq.heappop(queue)[1]
            wanted = (greatest[:, node, None] >= reach) & (least[:, node, None] <= hi) & (lo <= hi)
            some = np.flatnonzero(wanted.any(1))
            if not some.size:
                continue
            if node in self.children:
                for child in self.children[node]:
                    heapq.heappush(queue, entry(child))
                continue
            rows = self.leaves[node]
            scores = _products(a[some], self.vectors[rows], kind)
            fits = (self.labels[rows] == labels[some, None]) == same
            fits &= self.ids[rows] != own[some, None]
            keys = scores * n + (n - 1 - rows)
            for w in range(lo.shape[1]):
                inside = fits & (scores >= reach[some, w, None]) & (scores <= hi[some, w, None])
                hit = np.flatnonzero(inside.any(1))
                if not hit.size:
                    continue
                both = np.concatenate([best[some[hit], w], np.where(inside[hit], keys[hit], nothing)], axis=1)
                both = np.sort(both, axis=1)[:, -k:] if number is object else np.partition(both, -k, axis=1)[:, -k:]
                best[some[hit], w] = both
                kth = both.min(1)
                full = kth != nothing
                reach[some[hit[full]], w] = np.maximum(reach[some[hit[full]], w], kth[full] // n)
        query, window, slot = np.nonzero(best != nothing)
        found = best[query, window, slot]
        return query, window, found // n, (n - 1 - found % n).astype(np.int64)


def _searched(dim: int, k: int, same: bool):
    """Task function over rows sorted by (shard, part, kind): rows of the index, then anchors."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows, tree, queries, waiting = None, [], None, [], 0

        def found() -> pa.RecordBatch:
            batch = pa.Table.from_batches(queries).combine_chunks().to_batches()[0]
            width = max(len(x) for x in batch.column("lo").to_pylist())
            lo, hi, floor = (
                np.array([x + [fill] * (width - len(x)) for x in batch.column(name).to_pylist()], np.int64)
                for name, fill in (("lo", 1), ("hi", 0), ("floor", -NONE))
            )
            own, labels = batch.column("id").to_numpy(), batch.column("label").to_numpy()
            query, window, score, row = tree.search(own, labels, _matrix(batch.column("vec"), dim), lo, hi, floor, k, same)
            columns = [own[query], window.astype(np.int32), score.astype(np.int64), tree.ids[row]]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor_id", "window", "score", "id"])

        for batch in batches:
            shard, part, kind = (batch.column(c).to_numpy() for c in ("shard", "part", "kind"))
            runs = np.flatnonzero((np.diff(shard, prepend=-1) != 0) | (np.diff(part, prepend=-1) != 0) | (np.diff(kind, prepend=-1) != 0))
            for a, b in zip(runs, [*runs[1:], len(batch)], strict=True):
                if (shard[a], part[a]) != current:
                    if queries:
                        yield found()
                    current, rows, tree, queries, waiting = (shard[a], part[a]), [], None, [], 0
                own = batch.slice(a, b - a)
                if kind[a] == 0:
                    rows.append(own)
                    continue
                if tree is None:
                    all_rows = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
                    ids, labels = all_rows.column("id").to_numpy(), all_rows.column("label").to_numpy()
                    tree, rows = Tree(ids, labels, _matrix(all_rows.column("vec"), dim)), []
                for c in range(0, len(own), BLOCK):
                    queries.append(own.slice(c, BLOCK))
                    waiting += len(queries[-1])
                    if waiting >= BLOCK:
                        yield found()
                        queries, waiting = [], 0
        if queries:
            yield found()

    return run


class Index:
    """Rows (id, label, vec) packed into shards, stored in the shared folder, with the boxes of the shards."""

    def __init__(self, rows: DataFrame, shard_rows: int = SHARD) -> None:
        spark = rows.sparkSession
        kept = rows.filter("id IS NOT NULL AND label IS NOT NULL AND vec IS NOT NULL")
        kept = kept.filter(F.forall("vec", lambda x: x.isNotNull()))
        kept = checkpointed(kept.groupBy("id").agg(F.min(F.struct("label", "vec")).alias("r")).select("id", "r.label", "r.vec"))
        n, dim = kept.agg(F.count("*"), F.max(F.size("vec"))).first()
        self.dim, self.rows = dim or 0, kept
        shards = max(1, -(-n // shard_rows), min(partitions(spark), -(-n // SMALL_SHARD)))
        slabs = int(np.ceil(np.sqrt(shards)))
        at = [F.coalesce(F.get("vec", F.lit(axis)), F.lit(0)).alias(f"at_{axis}") for axis in (0, 1)]
        slabbed = kept.select("*", *at).repartitionByRange(slabs, "at_0", "id").withColumn("slab", F.spark_partition_id())
        tiled = slabbed.repartitionByRange(slabs * -(-shards // slabs), "slab", "at_1", "id")
        self.shards = checkpointed(tiled.select(F.spark_partition_id().alias("shard"), "id", "label", "vec"))
        dim = self.dim

        def boxes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            low, high, of = None, None, None
            for batch in batches:
                if len(batch):
                    v = _matrix(batch.column("vec"), dim)
                    of = batch.column("shard")[0].as_py()
                    low = v.min(0) if low is None else np.minimum(low, v.min(0))
                    high = v.max(0) if high is None else np.maximum(high, v.max(0))
            if of is not None:
                yield pa.RecordBatch.from_pydict({"shard": pa.array([of], pa.int32()), "low": [low.tolist()], "high": [high.tolist()]})

        self.boxes = checkpointed(self.shards.mapInArrow(boxes, "shard int, low array<bigint>, high array<bigint>"))

    def directory(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The shards' numbers and boxes, block by block."""
        block, size = [], max(1, DIRECTORY_BYTES // (16 * max(1, self.dim)))
        for row in self.boxes.toLocalIterator():
            block.append(row)
            if len(block) == size:
                yield self._block(block)
                block = []
        if block:
            yield self._block(block)

    def _block(self, rows: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return (
            np.array([row.shard for row in rows], np.int32),
            np.array([row.low for row in rows], np.int64).reshape(len(rows), self.dim),
            np.array([row.high for row in rows], np.int64).reshape(len(rows), self.dim),
        )

    def routed(self, anchors: DataFrame, first: bool) -> DataFrame:
        """A copy of each anchor for its most promising shard of a block (``first``), or for all others that may matter."""
        dim, out = self.dim, None

        def route(shards: np.ndarray, low: np.ndarray, high: np.ndarray):
            def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for whole in batches:
                    for at in range(0, len(whole), BLOCK):
                        batch = whole.slice(at, BLOCK)
                        a = _matrix(batch.column("vec"), dim)
                        least, greatest = _intervals(a, low, high, _number_kind(a, np.concatenate([low, high]), 1))
                        may, shown = np.zeros(least.shape, bool), np.full(least.shape, -NONE, least.dtype)
                        windows = [batch.column(c).to_pylist() for c in ("lo", "hi", "floor")]
                        for q, (lo, hi, floor) in enumerate(zip(*windows, strict=True)):
                            for x, y, z in zip(lo, hi, floor, strict=True):
                                if x <= y:
                                    meets = (greatest[q] >= x) & (least[q] <= y)
                                    shown[q] = np.where(meets, np.maximum(shown[q], np.minimum(greatest[q], y)), shown[q])
                                    may[q] |= meets & (greatest[q] >= z)
                        best = np.zeros(least.shape, bool)
                        best[np.arange(len(batch)), shown.argmax(1)] = True
                        query, box = np.nonzero(may & (best if first else ~best))
                        copies = batch.take(pa.array(query))
                        yield pa.RecordBatch.from_arrays([pa.array(shards[box]), *copies.columns], ["shard", *copies.schema.names])

            return run

        for block in self.directory():
            part = anchors.mapInArrow(route(*block), f"shard int, {_QUERY}")
            out = part if out is None else out.unionByName(part)
        return out

    def _search(self, anchors: DataFrame, k: int, same: bool, first: bool) -> DataFrame:
        spark = anchors.sparkSession
        queries = self.routed(anchors, first)
        parts = queries.groupBy("shard").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("parts"))
        parts = hinted(checkpointed(parts))
        none = [F.lit(None).cast("array<bigint>").alias(c) for c in ("lo", "hi", "floor")]
        rows = self.shards.join(parts, "shard").select(
            "shard", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("kind"),
            "id", "label", "vec", *none,
        )
        asked = queries.join(parts, "shard").select(
            "shard", F.pmod(F.hash("id"), F.col("parts")).alias("part"), F.lit(1).alias("kind"),
            "id", "label", "vec", "lo", "hi", "floor",
        )
        both = rows.unionByName(asked).repartition(partitions(spark), "shard", "part")
        both = both.sortWithinPartitions("shard", "part", "kind")
        return both.mapInArrow(_searched(self.dim, k, same), "anchor_id bigint, window int, score bigint, id bigint")

    def first_rows(self, anchors: DataFrame, k: int, same: bool) -> DataFrame:
        """(anchor_id, window, rank, id, score): the first ``k`` rows in each window of each anchor.

        ``anchors`` has (id, label, vec, lo, hi), the bounds of its windows as arrays; ``same`` asks for rows of the anchor's label,
        otherwise of others. An anchor is none of its own rows.
        """
        if self.boxes.isEmpty():
            return anchors.sparkSession.createDataFrame([], "anchor_id bigint, window int, rank int, id bigint, score bigint")
        open_floor = F.transform("lo", lambda _: F.lit(-NONE).cast("bigint"))
        place = Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "id")

        def ranked(found: DataFrame) -> DataFrame:
            return found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)

        found = checkpointed(self._search(anchors.withColumn("floor", open_floor), k, same, True))
        kth = ranked(found).filter(F.col("rank") == k).groupBy(F.col("anchor_id").alias("id"))
        kth = kth.agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("kth"))
        floor = F.transform("lo", lambda _, w: F.coalesce(F.try_element_at("kth", w), F.lit(-NONE).cast("bigint")))
        known = checkpointed(anchors.join(kth, "id", "left").withColumn("floor", floor).drop("kth"))
        known = known.select("id", "label", "vec", "lo", "hi", "floor")
        rest = self._search(known, k, same, False)
        return ranked(found.unionByName(rest)).select("anchor_id", "window", "rank", "id", "score")


def hard_negatives(
    rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of the rows (id, label, vec).

    Positives are an anchor's first other rows of its label; negatives of each positive the first rows of other labels whose
    score is between ``low`` and ``high`` hundredths of the positive's. ``vec`` holds integers.
    """
    index = Index(rows)
    limits = [F.array(F.lit(bound).cast("bigint")).alias(name) for name, bound in (("lo", -NONE), ("hi", NONE))]
    anchors = index.rows.filter(is_anchor)
    good = checkpointed(index.first_rows(anchors.select("id", "label", "vec", *limits), positives, True))
    score = F.col("score")
    bounds = good.select(
        F.col("anchor_id").alias("id"),
        F.struct(
            "rank",
            F.expr(f"CAST(ceil({low} * CAST(score AS decimal(20, 0)) / 100) AS bigint)").alias("lo"),
            F.expr(f"CAST(floor({high} * CAST(score AS decimal(20, 0)) / 100) AS bigint)").alias("hi"),
        ).alias("bounds"),
    )
    bounds = bounds.groupBy("id").agg(F.array_sort(F.collect_list("bounds")).alias("bounds"))
    asked = anchors.join(bounds, "id").select("id", "label", "vec", F.col("bounds.lo").alias("lo"), F.col("bounds.hi").alias("hi"))
    bad = index.first_rows(checkpointed(asked), negatives, False)
    good = good.select("anchor_id", (F.col("rank") - 1).alias("window"), F.col("id").alias("positive_id"), score.alias("positive_score"))
    bad = bad.withColumnsRenamed({"id": "negative_id", "score": "negative_score"})
    return bad.join(good, ["anchor_id", "window"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
