"""Decontamination and the n-gram join against brute force, components, and the pipeline."""

from __future__ import annotations

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberlog.llm import decontaminate, ngram_join
from emberlog.llm.components import components

VOCABULARY = [f"w{k}" for k in range(400)]


def windows_hit(doc: str | None, items: list[tuple]) -> tuple[int, int, list[str]]:
    def split(text):
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)

    words, hit, found = split(doc), set(), set()
    for key, text in items:
        own = split(text)
        size = min(10, len(own))
        wanted = {tuple(own[k : k + size]) for k in range(len(own) - size + 1)} if size else set()
        places = [k for k in range(len(words) - size + 1) if size and tuple(words[k : k + size]) in wanted]
        hit |= {k + i for k in places for i in range(size)}
        if places and key is not None:
            found.add(str(key))
    return len(words), len(hit), sorted(found)


def test_decontamination_against_brute_force(spark):
    dice = random.Random(3)
    few = VOCABULARY[:3]
    items = [(k, " ".join(dice.choices(few if k % 4 == 0 else VOCABULARY, k=dice.choice([1, 2, 4, 9, 10, 11, 14, 40]))))
             for k in range(60)]
    items += [(60, None), (61, ""), (62, "...!"), (None, "nameless item of exactly ten words is looked for too"), (5, items[5][1]),
              (63, "ÉTÉ Straße naïve")]
    docs = []
    for k in range(250):
        words = dice.choices(VOCABULARY if k % 3 else few, k=dice.choice([0, 3, 9, 10, 30, 120]))
        for _, text in dice.sample(items, 2):
            at, own = dice.randrange(len(words) + 1), (text or "").split()
            start = dice.randrange(len(own) + 1)
            words[at:at] = own[start : start + dice.choice([5, 9, 10, 12, 99])]
        docs.append((k, dice.choice([" ", ", ", " - "]).join(words).upper() if k % 5 == 0 else " ".join(words), "c"))
    docs += [(7, None, "c"), (None, docs[0][1], "c"), (3, docs[3][1], "c"), (3, docs[9][1], "c"), (251, "été straße naïve", "c"),
             (252, "ÉTÉ Straße naïve", "c"), (253, "x " * 50_000 + items[1][1], "c")]
    docs_df = spark.createDataFrame(docs, "doc_id bigint, text string, items string")
    items_df = spark.createDataFrame(items, "item_id bigint, text string")
    for limit in (decontaminate.BROADCAST_WINDOWS, -1):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(decontaminate, "BROADCAST_WINDOWS", limit)
            got = decontaminate.decontaminated(docs_df, items_df).collect()
            assert len(got) == len(docs)
            want = [(d[0], d[1], *windows_hit(d[1], items)) for d in docs]
            assert sorted(((r.doc_id, r.text, r.n_words, r.n_hit, r["items"]) for r in got), key=repr) == sorted(want, key=repr)
    assert sum(r.n_hit > 0 for r in got) > 50


def test_decontamination_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "some words here")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "words here")], "item_id bigint, text string")
    assert [tuple(r) for r in decontaminate.decontaminated(docs, items.limit(0)).collect()] == [(1, "some words here", 3, 0, [])]
    assert decontaminate.decontaminated(docs.limit(0), items).count() == 0


def brute_components(docs: list[tuple]) -> dict:
    sets = {}
    for key, text, *_ in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c < "\x80" else c for c in text or ""))
        grams = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
        sets.setdefault(key, []).append(grams)
    root = {key: key for key in sets if key is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(root, 2):
        for x, y in itertools.product(sets[a], sets[b]):
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {key: find(key) for key in root} | {None: None}


def varied_documents() -> list[tuple]:
    dice = random.Random(11)
    docs, key = [], 0
    passage = dice.choices(VOCABULARY, k=60)
    for _ in range(40):
        base = dice.choices(VOCABULARY, k=dice.choice([6, 12, 40, 150, 400]))
        if dice.random() < 0.5:
            base[3:3] = passage
        for _ in range(dice.choice([1, 1, 2, 3, 12])):
            words = list(base)
            for _ in range(dice.choice([0, 0, 1, 2, 5])):
                words[dice.randrange(len(words))] = dice.choice(VOCABULARY)
            docs.append(((key * 7919) % 1000, " ".join(words), "c"))
            key += 1
    for k in range(60):  # a chain in which only neighbours link, and a star
        docs.append((1000 + k, " ".join(f"c{j}" for j in range(k * 3, k * 3 + 60)), "c"))
        docs.append((2000 + k, " ".join([f"s{j}" for j in range(60)] + [f"t{k}_{j}" for j in range(12)]), "c"))
    docs += [(3000, None, "c"), (3001, "", "c"), (3002, " \n", "c"), (3003, "One two", "c"), (3004, "one TWO", "c"), (None, "one two", "c"),
             (3005, "É é É é É é", "c"), (3006, "é é é é é é", "c"), (3007, "x " * 40_000, "c"), (3003, "one two", "c"),
             (3008, "c0 c1 c2 c3 c4", "c"), (3003, docs[0][1], "c")]
    return docs


@pytest.mark.parametrize(("rows", "broadcast"), [(2048, 1_000_000), (5, -1)])
def test_ngram_components_against_brute_force(spark, monkeypatch, rows, broadcast):
    from emberlog.llm import shared

    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", rows)
    monkeypatch.setattr(ngram_join, "COMMON_MOST", rows)
    real = shared.small_enough
    for module in (shared, ngram_join):
        monkeypatch.setattr(module, "small_enough", lambda df, limit=broadcast: real(df, limit))
    docs = varied_documents()
    df = spark.createDataFrame(docs, "doc_id bigint, text string, component_id string").repartition(5)
    got = ngram_join.ngram_components(df).collect()
    want = brute_components(docs)
    assert len(got) == len(docs)
    assert {r.doc_id: r.component_id for r in got} == want
    assert len(set(want.values())) < len(want) - 80
    sizes = {r.doc_id: r.n_shingles for r in got}
    assert (sizes[3000], sizes[3001], sizes[3002], sizes[3007]) == (0, 0, 0, 1)
    assert ngram_join.ngram_components(df.limit(0)).count() == 0


def test_ngram_components_of_repeated_rows(spark, monkeypatch):
    """The whole table united with itself, with nothing joined by the least hash."""
    monkeypatch.setattr(ngram_join, "joined_by_token", lambda docs, rows: spark.createDataFrame([], "a bigint, b bigint"))
    docs = varied_documents()
    df = spark.createDataFrame(docs, "doc_id bigint, text string, component_id string")
    got = ngram_join.ngram_components(df.union(df).repartition(5)).collect()
    want = brute_components(docs)
    assert len(got) == 2 * len(docs)
    assert all(r.component_id == want[r.doc_id] for r in got)


def test_ngram_components_near_the_threshold(spark, monkeypatch):
    """Stretches of one long line, so that sets overlap by a little more or less than the threshold."""
    monkeypatch.setattr(ngram_join, "COMMON_MOST", 60)
    dice = random.Random(4)
    line, docs = [f"x{k}" for k in range(300)], []
    for key in range(450):
        size, start = dice.choice([8, 12, 16, 20, 24, 30, 40]), dice.randrange(120)
        own = [f"r{dice.randrange(10**6)}" for _ in range(dice.choice([0, 0, 1, 2, 3, 5]))]
        docs.append((key * 31 % 997, " ".join(line[start : start + size] + own)))
    got = ngram_join.ngram_components(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    want = brute_components(docs)
    want.pop(None)
    assert {r.doc_id: r.component_id for r in got} == want and 100 < len(set(want.values())) < 400


def unlike_texts() -> list[tuple]:
    """Ids with a short and a long text, near copies of the short ones under other ids, and empty texts of the same ids."""
    dice, docs = random.Random(8), []
    for k in range(30):
        short, long = dice.choices(VOCABULARY, k=40), dice.choices(VOCABULARY, k=4000)
        near = [*short[:-1], "last"]
        docs += [(k, " ".join(near)), (100 + k, " ".join(long)), (100 + k, " ".join(short)), (100 + k, "")]
    return docs


def test_ngram_components_of_ids_with_unlike_texts(spark):
    docs = unlike_texts()
    want = brute_components(docs)
    got = ngram_join.ngram_components(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)).collect()
    assert len(got) == len(docs)
    assert [(r.doc_id, r.component_id) for r in got if r.component_id != want[r.doc_id]] == []
    assert all(want[100 + k] == k for k in range(30))


def test_one_row_of_each_keeps_unlike_texts(spark):
    docs = [(key, text, str(n % 3)) for n, (key, text) in enumerate(unlike_texts() * 2)] + [(None, "x", "0")] * 2
    for parts in (1, 7):
        df = spark.createDataFrame(docs, "doc_id bigint, text string, c string").repartition(parts)
        got = sorted((tuple(r) for r in ngram_join.one_row_of_each(df).collect()), key=repr)
        want = [(None, "x", "0")] * 2
        for k in range(30):
            near, long, _, empty = ({x for x in docs if x[:2] == y} for y in unlike_texts()[4 * k : 4 * k + 4])
            want += [min(near), min(long), min(empty)]
        assert got == sorted(want, key=repr)


def test_words_hash_alike_only_if_equal():
    shingler = ngram_join.Shingler()
    texts = ["a", "b", "aa", "ab", "ba", "a b", "b a", "a b c d e", "a b c d e f", "é", "\x00", "a\x00"]
    sets = [tuple(shingler(text).tolist()) for text in texts]
    assert len(set(sets)) == len(texts)
    assert (shingler("  A\tb\nC ") == shingler("a b c")).all() and not len(shingler(" \n"))


def test_bitmaps_never_rule_out_a_link():
    dice = np.random.default_rng(2)
    for _ in range(200):
        a = np.unique(dice.integers(0, 2**63, dice.integers(1, 300), dtype=np.uint64))
        keep = a[dice.random(len(a)) < 0.9]
        b = np.unique(np.r_[keep, dice.integers(0, 2**63, dice.integers(0, 40), dtype=np.uint64)])
        if len(b) and ngram_join.linked(a, b):
            width = min(ngram_join.fitting_width(len(a)), ngram_join.fitting_width(len(b)))
            x, y = (ngram_join.folded(ngram_join.bitmap(s, ngram_join.fitting_width(len(s))), width) for s in (a, b))
            differing = np.bitwise_count(x ^ y).sum(dtype=np.int64)
            assert ngram_join.possible(np.array([len(a)]), len(b), np.array([differing])).all()
            n = min(ngram_join.prefix_size(len(a)), len(a)), min(ngram_join.prefix_size(len(b)), len(b))
            assert np.intersect1d(a[: n[0]], b[: n[1]]).size


def test_components(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(5, 3), (3, 9), (9, 5), (7, 7), (None, 3), (200, 210), (5, 3)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {k: 100 for k in range(100, 161)} | {5: 3, 3: 3, 9: 3, 200: 200, 210: 200}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_pipeline_against_a_plain_version(spark):
    import corpus_pipeline
    from emberlog.llm.queries import queries

    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    good = {r.doc_id for r in queries()["op1_quality"](spark, sf).collect() if r.predicted == 1}
    groups = brute_components([(key, docs[key]) for key in good])
    single = {key for key in good if groups[key] == key}
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    clean = {key for key in single if windows_hit(docs[key], items)[1] == 0}
    tokens = {r.doc_id: r.n_tokens for r in queries()["op7_bpe"](spark, sf).collect()}
    got = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {key: tokens[key] for key in clean} and len(got) == len(clean)
    assert 0 < len(clean) < len(single) < len(good) < len(docs)


def test_stages_keep_rows_with_gaps(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60)
    extra = docs.select(F.lit(None).cast("bigint").alias("doc_id"), F.lit(None).cast("string").alias("text"), "lang", "source",
                        "n_chars").limit(2)
    rows = docs.union(extra).union(docs.limit(3))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, rows, sf)
        assert found.columns == docs.columns and 0 < found.count() <= rows.count()
        assert stage(spark, rows.limit(0), sf).count() == 0
    once = corpus_pipeline.keep_one_of_each(spark, rows, sf).collect()
    assert sum(r.doc_id is None for r in once) == 2 and len({r.doc_id for r in once}) == len(once) - 1


def test_stages_keep_the_values_of_any_other_column(spark):
    import corpus_pipeline
    from emberlog.llm import decontaminate, ngram_join

    names = ["_id", "_mark", "_n_hit", "_items", "_doc_mark", "n_words", "n_hit", "items", "key", "_key", "_of", "id", "mark", "node",
             "label", "first", "n", "score", "predicted", "held_out", "features", "labelled", "quality", "sealed_rest", "class", "row",
             "a.b", "words", "equal", "Text "]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(40)
    docs = docs.union(docs.limit(5)).union(docs.limit(3).selectExpr("doc_id", "text || ' other words at its end'"))
    rows = docs.select(*[F.concat(F.lit(f"{name} of "), F.col("doc_id")).alias(name) for name in names], "text", "doc_id").checkpoint()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, rows, "/root/testdata/sf0.001")
        assert found.columns == rows.columns
        got = found.collect()
        assert got and all(r[name] == f"{name} of {r.doc_id}" for r in got for name in names)
    assert {"doc_id", "n_tokens"} <= set(corpus_pipeline.encode(spark, rows.withColumn("ids", F.lit(1)), "").columns)
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    kept = [name for name in names if name not in ("n_words", "n_hit", "items")]
    judged = decontaminate.decontaminated(rows, items).collect()
    assert len(judged) == rows.count() and all(r[name] == f"{name} of {r.doc_id}" for r in judged for name in kept)
    assert all(isinstance(r.n_hit, int) and isinstance(r["items"], list) for r in judged)
    assert ngram_join.one_row_of_each(rows).columns == rows.columns
