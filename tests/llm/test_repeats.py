"""Removal of repeated passages against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberlog.llm import repeats

SCHEMA = "doc_id bigint, text string, _key bigint, kept string, n_words int"


def brute(rows: list[tuple], window: int) -> list[tuple]:
    """(id, n_words, n_removed, kept) of each row, word by word."""
    texts = [(repeats.LAST if r[0] is None else r[0], (r[1] or "").encode().split()) for r in rows]
    least: dict[tuple, tuple] = {}
    for key, words in texts:
        for k in range(len(words) - window + 1):
            name = tuple(words[k : k + window])
            least[name] = min(least.get(name, (key, k)), (key, k))
    out = []
    for (doc, *_), (key, words) in zip(rows, texts, strict=True):
        gone = set()
        for k in range(len(words) - window + 1):
            if (key, k) > least[tuple(words[k : k + window])]:
                gone |= set(range(k, k + window))
        out.append((doc, len(words), len(gone), b" ".join(w for k, w in enumerate(words) if k not in gone).decode()))
    return sorted(out, key=repr)


def found(spark, rows, window, chunk):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)
    cut = repeats.without_repeats(df, window, chunk=chunk)
    return sorted((tuple(r) for r in cut.select("id", "n_words", "n_removed", "kept").collect()), key=repr)


def sample(dice: random.Random) -> list[tuple]:
    words = [f"w{k}" for k in range(300)] + ["été", "naïve gap", "odd\x1cmark", "x" * 5000, "y" * 5000, "abcdefgh", "abcdefghi"]
    rows: list[tuple] = []
    for k in range(120):
        own = dice.choices(words, k=dice.choice([0, 1, 3, 5, 30, 80]))
        for _ in range(2):
            if rows and own:
                other = (dice.choice(rows)[1] or "").split(" ")
                at = dice.randrange(len(other))
                own[dice.randrange(len(own)) :] = other[at : at + dice.choice([3, 6, 25, 60])]
        rows.append((dice.randrange(90), dice.choice([" ", "\t", "  ", "\r\n"]).join(own)))
    return rows


@pytest.mark.parametrize(("window", "chunk"), [(3, 60), (20, 100), (3, 1_000_000), (1, 40)])
def test_against_brute_force(spark, window, chunk):
    rows = sample(random.Random(window))
    rows += [(None, rows[5][1]), (None, rows[9][1]), (7, None), (7, ""), (8, rows[20][1]), (8, rows[20][1]), (-4, rows[30][1])]
    assert found(spark, rows, window, chunk) == brute(rows, window)


def test_a_repeat_inside_one_text_and_touching_repeats(spark):
    line = " ".join(f"a{k}" for k in range(20))
    rows = [(1, f"{line} {line} x {line}"), (2, f"y {line} {line}z")]
    assert found(spark, rows, 20, 1000) == brute(rows, 20)
    one = repeats.without_repeats(spark.createDataFrame([(1, f"{line} {line} x {line}")], "doc_id bigint, text string")).first()
    assert (one.starts, one.ends, one.kept) == ([20, 41], [40, 61], f"{line} x")


def test_one_long_text_of_equal_words_and_a_hot_passage(spark):
    rows = [(1, "same " * 100_000)] + [(k, "head " + "common words of all of them " * 5) for k in range(2, 400)]
    assert found(spark, rows, 20, 3000) == brute(rows, 20)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert repeats.without_repeats(df).count() == 0


def test_every_row_twice_changes_nothing(spark):
    rows = sample(random.Random(9))
    assert found(spark, rows + rows, 3, 100) == brute(rows + rows, 3)


def test_windows_in_blocks_are_those_of_one_go():
    words = np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64)
    whole = repeats.window_hashes(words, 20)
    assert (whole == repeats.window_hashes(words, 20, step=64)).all() and len(np.unique(whole)) == len(whole) == 4981


def test_columns_of_the_result(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string").withColumn("starts", F.lit(3))
    assert repeats.without_repeats(df).columns == ["id", "n_words", "n_removed", "starts", "ends", "kept"]
