"""The prefix trie of conversations, with sums over subtrees by centroid decomposition of its parent edges.

A node stands for one sequence of leading turns (role and text); the conversations that begin with it are its members, the
least member names it. The root is the empty sequence.

* ``numbered`` gives turns their position by one sort of narrow rows over ranges, so a conversation of any length is spread
  over tasks. Of a text only its SHA-256 and its length travel.
* ``with_nodes`` names a prefix by 128 bits: the sums of four 32-bit pieces of a digest of each turn and its depth. Sums are
  running ones inside slices of ``SLICE`` turns, and over the slices.
* ``subtree_sums`` splits the forest at centroids. The centroid of a component is its deepest node with half of the component's
  weight below it; the weight of a node is the number of turns of its members from it on, which is known from the turns.
  Cutting there leaves the part above and one part for each child. The total of what hung at the centroid, itself included, is
  its sum within the component and is added to each node on the path from it to the component's top. Components of more than
  ``LOCAL`` nodes are split on Spark, all at once in each round, and their number of turns halves each time; the others are
  finished one by one inside tasks, by the same steps.

Turns are ordered by number, null first; turns of equal number by role, then by the digest of role and text. A null role or text
is an empty one. Repeated rows are repeated turns. Rows without a conversation take no part. An empty table has no node.
Columns other than the four named ones are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberlog.llm.shared import checkpointed, hinted, partitions, stored

SLICE = 1024
LOCAL = 10_000
ROOT = "0" * 32
_LANES = ("lane_0", "lane_1", "lane_2", "lane_3")
_LOW = 0xFFFFFFFF
# Ids of conversations that are joined to one piece of text.
_PIECE = 4096


def numbered(
    df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conv, position, digest, size) of each turn; positions count from 1, size is that of the text in UTF-8."""
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    turns = df.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("bigint").alias("conv"),
        F.col(turn_col).alias("turn"),
        role.alias("role"),
        F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256).alias("digest"),
        F.octet_length(text).cast("bigint").alias("size"),
        F.monotonically_increasing_id().alias("row"),  # equal turns can still lie on both sides of a bound
    )
    order = ["conv", F.asc_nulls_first("turn"), "role", "digest", "row"]
    sorted_turns = turns.repartitionByRange(partitions(df.sparkSession), *order).sortWithinPartitions(*order)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, n = None, 0
        for batch in batches:
            position = []
            for conv in batch.column(0).to_pylist():
                current, n = conv, (n + 1 if conv == current else 1)
                position.append(n)
            columns = [batch.column(0), pa.array(position, pa.int64()), *batch.columns[1:]]
            yield pa.RecordBatch.from_arrays(columns, ["conv", "position", "digest", "size", "part"])

    local = sorted_turns.select("conv", "digest", "size", F.spark_partition_id().alias("part"))
    local = checkpointed(local.mapInArrow(count, "conv bigint, position bigint, digest string, size bigint, part int"))
    # Only the first conversation of a part can have begun before it, so there is at most one row for each part.
    counts = local.groupBy("conv", "part").agg(F.max("position").alias("n"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begun = counts.withColumn("before", F.sum("n").over(earlier)).filter("before > 0").drop("n")
    placed = local.join(hinted(begun), ["conv", "part"], "left")
    return placed.select("conv", (F.col("position") + F.coalesce("before", F.lit(0))).alias("position"), "digest", "size")


def _name(lanes: list) -> F.Column:
    return F.concat(*[F.lpad(F.hex(lane.bitwiseAND(F.lit(_LOW))), 8, "0") for lane in lanes])


def with_nodes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv, depth, len, node, parent, size) of each turn, and of depth 0 for each conversation.

    ``turns`` has (conv, depth, digest, size), depths counting from 1 without gaps; ``convs`` has (conv, len) of every
    conversation, those without turns too.
    """
    own = F.sha2(F.concat(F.col("depth").cast("string"), F.lit(":"), F.col("digest")).cast("binary"), 256)
    pieces = [F.conv(F.substring("own", 1 + 8 * k, 8), 16, 10).cast("bigint").alias(lane) for k, lane in enumerate(_LANES)]
    slices = turns.withColumn("own", own).select(
        "conv", "depth", "size", F.floor((F.col("depth") - 1) / SLICE).alias("slice"), *pieces
    )
    per_slice = slices.groupBy("conv", "slice").agg(*[F.sum(lane).alias(lane) for lane in _LANES])
    earlier = Window.partitionBy("conv").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    before = per_slice.select("conv", "slice", *[F.sum(lane).over(earlier).alias(f"{lane}_before") for lane in _LANES])
    upto = Window.partitionBy("conv", "slice").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = slices.withColumns({f"{lane}_upto": F.sum(lane).over(upto) for lane in _LANES})
    sums = sums.join(before.filter("slice > 0"), ["conv", "slice"], "left")
    upto = [F.col(f"{lane}_upto") + F.coalesce(f"{lane}_before", F.lit(0)) for lane in _LANES]
    nodes = sums.select(
        "conv",
        "depth",
        _name(upto).alias("node"),
        _name([total - F.col(lane) for total, lane in zip(upto, _LANES, strict=True)]).alias("parent"),
        "size",
    )
    nodes = nodes.join(convs, "conv").select("conv", "depth", "len", "node", "parent", "size")
    root = convs.select(
        "conv",
        F.lit(0).cast("bigint").alias("depth"),
        "len",
        F.lit(ROOT).alias("node"),
        F.lit(None).cast("string").alias("parent"),
        F.lit(0).cast("bigint").alias("size"),
    )
    return nodes.unionByName(root)


def _component_sums(parent: list[int], weight: list[int], sums: list[list[int]], extra: list[list[int]]) -> None:
    """Replace ``extra`` by the sums over the subtrees of one component; ``parent`` is -1 at its top."""
    children: list[list[int]] = [[] for _ in parent]
    for node, above in enumerate(parent):
        if above >= 0:
            children[above].append(node)
    cut = [False] * len(parent)
    tops = [node for node, above in enumerate(parent) if above < 0]
    while tops:
        top = centroid = tops.pop()
        half = weight[top]
        heavy: int | None = top
        while heavy is not None:
            centroid = heavy
            heavy = next((k for k in children[centroid] if not cut[k] and 2 * weight[k] >= half), None)
        below = [centroid]
        for node in below:
            below += [k for k in children[node] if not cut[k]]
        totals = [sum(column[node] for node in below) for column in sums]
        above = centroid
        while above != top:
            above = parent[above]
            weight[above] -= weight[centroid]
            for column, total in zip(extra, totals, strict=True):
                column[above] += total
        for column, total in zip(extra, totals, strict=True):
            column[centroid] += total
        tops += [k for k in children[centroid] if not cut[k]]
        if centroid != top:
            tops.append(top)
        cut[centroid] = True


def _local_sums(values: list[str]):
    """Task function over rows sorted by component: (node, sums)."""
    names = ["node", *values]

    def finished(rows: list[tuple]) -> pa.RecordBatch:
        index = {row[1]: k for k, row in enumerate(rows)}
        parent = [index.get(row[2], -1) for row in rows]
        n = len(values)
        sums = [[row[4 + k] for row in rows] for k in range(n)]
        extra = [[row[4 + n + k] for row in rows] for k in range(n)]
        _component_sums(parent, [row[3] for row in rows], sums, extra)
        return pa.RecordBatch.from_arrays([pa.array(list(index), pa.string()), *(pa.array(c, pa.int64()) for c in extra)], names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows, out, waiting = None, [], [], 0
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if row[0] != current and rows:
                    out.append(finished(rows))
                    waiting, rows = waiting + len(rows), []
                    if waiting >= LOCAL:
                        yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
                        out, waiting = [], 0
                current = row[0]
                rows.append(row)
        if rows:
            out.append(finished(rows))
        if out:
            yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]

    return run


def subtree_sums(nodes: DataFrame, paths: DataFrame, values: list[str], local: int = LOCAL) -> DataFrame:
    """(node, *values) with each value summed over the node's subtree, the node included.

    ``nodes`` has (node, parent, conv_id, depth, weight, *values), weight being the number of ``paths`` rows in the subtree;
    ``paths`` has (conv, depth, node, parent) of every turn of every conversation.
    """
    extra = [f"x_{v}" for v in values]
    columns = ["node", "parent", "conv_id", "depth", "weight", *values, *extra]
    state = nodes.select(
        F.lit(ROOT).alias("comp"), *columns[: 5 + len(values)], *[F.lit(0).cast("bigint").alias(x) for x in extra]
    )
    state, done, small = stored(state, "components"), [], []
    while True:
        size = state.groupBy("comp").agg(F.max("weight").alias("total"), F.count("*").alias("n"))
        large = checkpointed(size.filter(F.col("n") > local).select("comp", "total"))
        small.append(state.join(hinted(large), "comp", "left_anti"))
        if large.isEmpty():
            break
        state = state.join(hinted(large), "comp")
        heavy = state.filter(2 * F.col("weight") >= F.col("total")).groupBy("comp")
        centroids = heavy.agg(F.max(F.struct("depth", "node", "conv_id", "weight")).alias("c"))
        centroids = checkpointed(
            centroids.select(
                "comp", F.col("c.node").alias("c_node"), F.col("c.depth").alias("c_depth"),
                F.col("c.conv_id").alias("c_conv"), F.col("c.weight").alias("c_weight"),
            )
        )
        cuts = hinted(centroids)
        # A node is below the centroid if its least member is a member of the centroid and the node is deeper.
        members = paths.join(cuts, F.col("parent") == F.col("c_node")).select(
            F.col("conv").alias("conv_id"), "comp", F.col("node").alias("child")
        )
        # The nodes above it are the shorter prefixes of any member.
        above = paths.join(cuts, (F.col("conv") == F.col("c_conv")) & (F.col("depth") < F.col("c_depth")))
        above = above.select("node", "comp", F.lit(True).alias("above"))
        marked = state.join(cuts, "comp").join(members, ["conv_id", "comp"], "left").join(above, ["node", "comp"], "left")
        below = F.col("child").isNotNull() & (F.col("depth") > F.col("c_depth"))
        is_cut = F.col("node") == F.col("c_node")
        marked = checkpointed(
            marked.select(
                "comp", *columns, "c_weight", F.when(below, F.col("child")).alias("child"), is_cut.alias("is_cut"),
                F.coalesce("above", F.lit(False)).alias("above"),
            )
        )
        totals = marked.filter("is_cut OR child IS NOT NULL").groupBy("comp").agg(*[F.sum(v).alias(f"t_{v}") for v in values])
        totals = hinted(checkpointed(totals))
        summed = marked.join(totals, "comp")
        done.append(summed.filter("is_cut").select("node", *[(F.col(f"x_{v}") + F.col(f"t_{v}")).alias(v) for v in values]))
        state = stored(
            summed.filter("NOT is_cut").select(
                F.coalesce("child", "comp").alias("comp"), *columns[:4],
                F.when(F.col("above"), F.col("weight") - F.col("c_weight")).otherwise(F.col("weight")).alias("weight"),
                *values,
                *[F.when(F.col("above"), F.col(f"x_{v}") + F.col(f"t_{v}")).otherwise(F.col(f"x_{v}")).alias(f"x_{v}")
                  for v in values],
            ),
            "components",
        )
    rest = small[0]
    for part in small[1:]:
        rest = rest.unionByName(part)
    rest = rest.select("comp", "node", "parent", "weight", *values, *extra)
    rest = rest.repartition(partitions(nodes.sparkSession), "comp").sortWithinPartitions("comp")
    out = rest.mapInArrow(_local_sums(values), ", ".join(["node string", *(f"{v} bigint" for v in values)]))
    for part in done:
        out = out.unionByName(part)
    return out


def ends_digests(paths: DataFrame) -> DataFrame:
    """(node, ends_sha256): the digest of the ascending ids of the conversations that end at the node, joined by commas.

    Ids are sorted over ranges and joined to pieces; the pieces of a node are hashed one after another as they stream by.
    """
    ends = paths.filter("depth = len").select("node", "conv")
    n = partitions(paths.sparkSession)

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, ids = None, []
        for batch in batches:
            out = []
            for node, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if ids and (node != current or len(ids) == _PIECE):
                    out.append((current, ids[0], ",".join(map(str, ids))))
                    ids = []
                current = node
                ids.append(conv)
            if out:
                yield pa.RecordBatch.from_pydict(dict(zip(("node", "first", "ids"), zip(*out), strict=True)))
        if ids:
            yield pa.RecordBatch.from_pydict({"node": [current], "first": [ids[0]], "ids": [",".join(map(str, ids))]})

    def digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha256

        current, state = None, None
        for batch in batches:
            out = []
            for node, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if node != current:
                    if current is not None:
                        out.append((current, state.hexdigest()))
                    current, state = node, sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if out:
                yield pa.RecordBatch.from_pydict(dict(zip(("node", "ends_sha256"), zip(*out), strict=True)))
        if current is not None:
            yield pa.RecordBatch.from_pydict({"node": [current], "ends_sha256": [state.hexdigest()]})

    joined = ends.repartitionByRange(n, "node", "conv").sortWithinPartitions("node", "conv")
    joined = joined.mapInArrow(pieces, "node string, first bigint, ids string")
    joined = joined.repartition(n, "node").sortWithinPartitions("node", "first")
    return joined.mapInArrow(digests, "node string, ends_sha256 string")


def prefix_trie(paths: DataFrame, local: int = LOCAL) -> DataFrame:
    """The nodes of the trie of ``paths`` (see ``with_nodes``), which should be a stored table, as it is read several times.

    (node, parent, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens): ids of the node and its parent,
    their least members, the depth, members, children, childless nodes in the subtree, and the bytes of turns that need not
    be kept again: (n_convs - 1) times the size of the last turn, summed over the subtree.
    """
    nodes = paths.groupBy("node", "parent", "depth", "size").agg(
        F.min("conv").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.sum(F.col("len") - F.col("depth") + 1).alias("weight"),
    )
    children = paths.select("node", "parent").distinct().groupBy(F.col("parent").alias("of")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, F.col("node") == F.col("of"), "left").drop("of")
    nodes = checkpointed(nodes.withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("bigint"))))
    valued = nodes.withColumns(
        {
            "n_leaves": (F.col("n_children") == 0).cast("bigint"),
            "saved_tokens": (F.col("n_convs") - 1) * F.col("size"),
        }
    )
    sums = subtree_sums(valued, paths, ["n_leaves", "saved_tokens"], local)
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return nodes.join(sums, "node").join(parents, "parent", "left").select(
        "node", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"
    )


def with_turns(nodes: DataFrame, turns: DataFrame) -> DataFrame:
    """Nodes of ``prefix_trie`` with the columns of their last turn, from a table with (conv, depth, ...); the root gets nulls."""
    last = turns.withColumnsRenamed({"conv": "conv_id"})
    return nodes.join(last, ["conv_id", "depth"], "left")
