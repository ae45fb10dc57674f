"""The conversation trie against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from emberlog.llm import trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, node string, depth int"


def brute(rows: list[tuple]) -> list[tuple]:
    """The nodes with their sums and the ids that end there, from every prefix of every conversation."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns[conv].append((turn is not None, turn or 0, role, digest, text))
    members, children = defaultdict(list), defaultdict(int)
    saved, leaves, ends = defaultdict(int), defaultdict(int), defaultdict(list)
    for conv, own in turns.items():
        path = tuple((t[2], t[4]) for t in sorted(own))
        ends[path].append(conv)
        for d in range(len(path) + 1):
            members[path[:d]].append(conv)
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, convs in members.items():
        for d in range(len(path) + 1):
            saved[path[:d]] += (len(convs) - 1) * len(path[-1][1].encode()) if path else 0
            leaves[path[:d]] += children[path] == 0
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), children[p], leaves[p], saved[p],
         hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest() if ends[p] else "")
        for p, m in members.items()
    )


def found(spark, rows, local):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    turns = trie.numbered(df).withColumnRenamed("position", "depth")
    convs = turns.groupBy("conv").agg(F.max("depth").alias("len"))
    paths = trie.checkpointed(trie.with_nodes(turns, convs))
    nodes = trie.prefix_trie(paths, local).join(trie.ends_digests(paths), "node", "left")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(r) for r in nodes.select(*columns).fillna(-1).fillna("").collect())


def sample(dice: random.Random, n: int) -> list[tuple]:
    rows = []
    for conv in range(n):
        for turn in range(dice.choice([1, 2, 3, 9])):
            rows.append((conv, dice.choice([turn, turn, None]), dice.choice(["user", None]), dice.choice(["a", "b", "é", None, ""])))
    return rows


@pytest.mark.parametrize("local", [3, 10_000])
def test_against_brute_force(spark, local):
    rows = sample(random.Random(5), 60)
    rows += [r for r in rows if r[0] % 9 == 0]  # repeated rows are repeated turns
    rows += [(None, 1, "user", "lost"), (-7, 0, "user", "a"), (-7, 0, "user", "b")]
    assert found(spark, rows, local) == brute(rows)


def test_one_long_conversation_and_a_crowd_of_equal_ones(spark, monkeypatch):
    monkeypatch.setattr(trie, "SLICE", 7)
    monkeypatch.setattr(trie, "_PIECE", 5)
    rows = [(1, k, "user", str(k)) for k in range(300)] + [(2, k, "user", str(k)) for k in range(150)]
    rows += [(conv, turn, "user", "same") for conv in range(10, 60) for turn in range(2)]
    assert found(spark, rows, 8) == brute(rows)


def test_one_turn_repeated_beyond_a_part(spark):
    rows = [(1, None, None, None)] * 500 + [(2, 1, "user", "b")]
    assert found(spark, rows, 50) == brute(rows)


def test_empty_table(spark):
    assert found(spark, [], 10) == []
    assert found(spark, [(None, 1, "user", "a")], 10) == []


def test_sums_of_one_component():
    dice = random.Random(2)
    for n in (1, 2, 50):
        parent = [-1, *(dice.randrange(k) for k in range(1, n))]
        weight, value = [1] * n, [dice.randrange(9) for _ in range(n)]
        want = list(value)
        for k in range(n - 1, 0, -1):
            weight[parent[k]] += weight[k]
            want[parent[k]] += want[k]
        got = [[0] * n]
        trie._component_sums(parent, weight, [value], got)
        assert got[0] == want


def test_last_turns_of_nodes(spark):
    df = spark.createDataFrame([(1, 1, "user", "a"), (1, 2, "bot", "b"), (2, 1, "user", "a")], SCHEMA[: SCHEMA.index(", node")])
    turns = trie.numbered(df).withColumnRenamed("position", "depth")
    paths = trie.checkpointed(trie.with_nodes(turns, turns.groupBy("conv").agg(F.max("depth").alias("len"))))
    shown = trie.with_turns(trie.prefix_trie(paths), df.select(F.col("conv_id").alias("conv"), F.col("turn").alias("depth"), "text"))
    assert sorted((r.depth, r.text or "", r.n_convs) for r in shown.collect()) == [(0, "", 2), (1, "a", 2), (2, "b", 1)]
