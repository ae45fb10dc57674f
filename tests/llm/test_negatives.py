"""Hard negatives against brute force over all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberlog.llm import negatives

SCHEMA = "id bigint, label int, vec array<bigint>, score bigint, shard int"


def brute(rows: list[tuple], step: int) -> list[tuple]:
    best: dict[int, tuple] = {}
    for doc, label, vec in rows:
        if doc is not None and label is not None and vec is not None and None not in vec:
            best[doc] = min(best.get(doc, (label, vec)), (label, vec))
    out = []
    for anchor, (label, vec) in best.items():
        if anchor % step:
            continue
        scores = {k: sum(x * y for x, y in zip(vec, v)) for k, (_, v) in best.items() if k != anchor}
        ranked = sorted(scores, key=lambda k: (-scores[k], k))
        for good in [k for k in ranked if best[k][0] == label][:5]:
            p = scores[good]
            fits = [k for k in ranked if best[k][0] != label and 30 * p <= 100 * scores[k] <= 90 * p]
            out += [(anchor, good, n, bad, p, scores[bad]) for n, bad in enumerate(fits[:10], 1)]
    return sorted(out)


def found(spark, rows, step):
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA)
    return sorted(tuple(r) for r in negatives.hard_negatives(df, F.col("id") % step == 0).collect())


def sample(n: int, dim: int, spread: int) -> list[tuple]:
    dice = random.Random(n)
    rows = [(k, dice.randrange(3), [dice.randint(-spread, spread) for _ in range(dim)]) for k in range(n)]
    return rows + [(n + k, k % 3, rows[5][2]) for k in range(40)]  # many equal vectors


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(negatives, "SHARD", 50)
    monkeypatch.setattr(negatives, "SMALL_SHARD", 40)
    monkeypatch.setattr(negatives, "LEAF", 4)
    monkeypatch.setattr(negatives, "QUERIES", 3)
    monkeypatch.setattr(negatives, "DIRECTORY_BYTES", 300)
    rows = sample(250, 6, 4)
    assert found(spark, rows, 20) == brute(rows, 20)


def test_odd_rows(spark):
    rows = sample(60, 3, 3)
    rows += [(None, 1, [1, 1, 1]), (100, None, [1, 1, 1]), (101, 1, None), (102, 1, [1, None, 2]), (104, 1, []), (105, 2, [3]),
             rows[0], rows[7], (7, 0, [9, 9, 9])]
    assert found(spark, rows, 5) == brute(rows, 5)


def test_numbers_beyond_the_integers_of_a_double(spark):
    rows = [(k, k % 2, [(1 << 29) + 3 * k, -k, 1 << 20]) for k in range(30)] + [(31, 1, [-(1 << 30), 5, 0])]
    assert found(spark, rows, 7) == brute(rows, 7)


def test_few_rows(spark):
    assert found(spark, [], 1) == []
    assert found(spark, [(1, 1, [1])], 1) == []
    assert found(spark, [(1, 1, [1]), (2, 2, [1])], 5) == []
    rows = [(0, 1, [10, 0]), (1, 1, [10, 0]), (2, 2, [5, 0]), (3, 2, [9, 0]), (4, 2, [10, 0]), (5, 2, [3, 0]), (6, 2, [2, 0])]
    assert [r[3] for r in found(spark, rows, 100)] == [3, 2, 5] and found(spark, rows, 100) == brute(rows, 100)


@pytest.mark.parametrize("n", [1, 63, 64, 65, 1000])
def test_packing_keeps_every_row_once(n):
    vectors = np.random.default_rng(n).integers(-5, 5, (n, 7))
    leaves = negatives.packed_order(vectors, np.arange(n), 2)
    assert sorted(np.concatenate(leaves)) == list(range(n)) and max(map(len, leaves)) <= negatives.LEAF


def test_intervals_hold_all_products():
    dice = np.random.default_rng(3)
    a, v = dice.integers(-9, 9, (5, 8)), dice.integers(-9, 9, (40, 8))
    least, greatest = negatives._intervals(a, v.min(0)[None], v.max(0)[None], np.float64)
    products = a @ v.T
    assert (least[:, 0] <= products.min(1)).all() and (greatest[:, 0] >= products.max(1)).all()
