"""Quality scores, fingerprints, chat rendering and license scans."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from emberlog.llm import chat, licenses, phrases, quality
from emberlog.llm.queries import scored

SF = "/root/testdata/sf0.1"


def test_quality_of_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))
    rows = scored(docs.join(labels.select("doc_id"), "doc_id", "left_semi"), labels).join(
        labels.select("doc_id", F.col("quality").alias("q")), "doc_id"
    )
    held = [r for r in rows.collect() if r.held_out]
    assert {r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in held} == {True}
    good, bad = [r.score for r in held if r.q == 1], [r.score for r in held if r.q == 0]
    assert len(good) > 100 and len(bad) > 50
    right = sum(r.predicted == r.q for r in held) / len(held)
    above = sum(g > b for g in good for b in bad) / (len(good) * len(bad))
    assert right > 0.98 and above > 0.99
    assert all(0 <= r.score <= 1 for r in held)


def test_quality_edge_cases(spark):
    rows = [(k, "A fine text, with words and sense." if k % 2 else "BUY!! NOW!! $$$ ###", None, 9.0) for k in range(60)]
    rows += [(100, None, "x", 0.0), (101, "", "x", 0.0), (None, "text", "x", 0.0), (1, "x " * 200_000, "x", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score double")
    labels = spark.createDataFrame([(k, k % 2, None) for k in range(60)] + [(3, None, 1)], "doc_id bigint, quality int, toxic int")
    got = scored(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by_id = {r.doc_id: r for r in got if r.text != "x " * 200_000}
    assert all(by_id[k].predicted == k % 2 for k in range(60))
    assert by_id[100].score == by_id[101].score and by_id[None].held_out
    # Too little to learn from: everything gets the share of label 1.
    few = scored(docs, labels.filter("doc_id IN (1, 3)")).collect()
    assert len({r.score for r in few}) == 1
    assert scored(docs.limit(0), labels).count() == 0
    assert len({r.score for r in scored(docs, labels.limit(0)).collect()}) == 1


def test_phrases_are_the_same_at_any_offset(spark):
    parser = phrases.Parser()
    text = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id = 0").first().text
    whole, moved = parser.phrases(text)[-1], parser.phrases("Something before it. " + text)[-1]
    assert len(set(whole.tolist()) - set(moved.tolist())) <= 4
    assert [len(x) for x in parser.phrases("aaaaaaaa" * 999)] == [1, 1, 1]
    assert parser.phrases("") == []


def test_phrase_labels_are_small_and_differ():
    import numpy as np

    names = np.random.default_rng(1).integers(0, 2**63, 5000, dtype=np.uint64)
    for _ in range(phrases.ROUNDS):
        names = phrases.tossed(names)
        assert (names[1:] != names[:-1]).all()
    assert names[5:].max() < 6


def test_sketches_of_texts_together_are_those_of_each_alone(monkeypatch):
    rng = random.Random(3)
    texts = ["", "a", "aaaaaaaa", "ab" * 700, "é𝄞 x"] + [
        "".join(rng.choice("ab c\n") for _ in range(rng.choice([0, 1, 2, 7, 90, 1500]))) for _ in range(200)
    ]
    parser = phrases.Parser()
    alone = [parser.sketch(text) for text in texts]
    for size in (1 << 20, 50):
        monkeypatch.setattr(phrases, "BATCH_CHARS", size)
        together = phrases.Parser().sketches(texts)
        assert [phrases.written(x) for x in together] == [phrases.written(x) for x in alone]


def test_fingerprints_against_brute_force(spark):
    texts = ["alpha beta gamma delta " * 9, "", None, "alpha beta gamma delta " * 9, "é" * 7, "x", "y" * 3000]
    rows = [(k * 3, text, "clash") for k, text in enumerate(texts)] + [(6, "also six", "c"), (None, "no id", "c")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, fingerprint string").repartition(4)
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    parser = phrases.Parser()
    want = []
    for k, (key, text, _) in enumerate(order):
        text, follower = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + follower[:half]
        a, b, c = map(parser.sketch, (text, edited, follower))
        want.append((key, len(text), hashlib.sha256(edited.encode()).hexdigest(), phrases.written(a), phrases.written(b),
                     phrases.likeness(a, b), phrases.likeness(a, c)))
    got = [tuple(r) for r in phrases.compared(df).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert phrases.compared(df.filter("doc_id = 15")).collect()[0].near_next == 1.0
    assert phrases.compared(df.limit(0)).count() == 0
    plain = {r.doc_id: r.fingerprint for r in phrases.fingerprints(df.filter("doc_id <> 6")).collect()}
    assert plain[0] == plain[9] and plain[3] == ""


def test_edited_texts_are_nearer_than_others(spark):
    rows = phrases.compared(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).filter("n_chars > 200").collect()
    nearer = sum(r.near_edited > r.near_next for r in rows) / len(rows)
    assert nearer > 0.97


def test_chat_by_every_speaker(spark):
    rows = [
        (1, 0, "system", "Be <|im_end|> kind.", "c"), (1, 1, "ann b", "Hi", "c"), (1, 2, "bob", "Hällo", "c"),
        (1, 3, None, None, "c"), (1, 3, None, None, "c"), (2, 0, "system", "alone", "c"), (None, None, "eve", "lost", "c"),
    ]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, segment string")
    got = chat.rotated(df).collect()
    whole = {}
    for r in sorted(got, key=lambda r: r.position):
        whole.setdefault((r.conv, r.participant), []).append(r)
    assert set(whole) == {(1, "ann_b"), (1, "bob"), (1, "unknown"), (None, "eve")}
    for (_, who), segments in whole.items():
        text = "".join(r.segment for r in segments)
        for r in segments:
            assert text[r.segment_start : r.segment_start + len(r.segment)] == r.segment
            if r.masked:
                assert r.segment.startswith("<|im_start|>assistant\n") and text[r.mask_start : r.mask_end].endswith("<|im_end|>")
            else:
                assert r.mask_start is None and "assistant" not in r.segment.split("\n")[0]
    bob = "".join(r.segment for r in whole[1, "bob"])
    assert bob.startswith(
        "<|im_start|>system\nBe <|im_end |> kind.<|im_end|>\n<|im_start|>user name=ann_b\nHi<|im_end|>\n"
        "<|im_start|>assistant\nHällo<|im_end|>\n<|im_start|>user name=unknown\n<|im_end|>\n"
    )
    assert chat.rotated(df.limit(0)).count() == 0


def test_chat_in_slices(spark, monkeypatch):
    rows = [(1, k, "ab"[k % 2], "t" * (k % 7)) for k in range(50)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    whole = sorted(map(tuple, chat.rotated(df).collect()))
    monkeypatch.setattr(chat, "SLICE", 8)
    assert sorted(map(tuple, chat.rotated(df).collect())) == whole


def test_chat_of_turns_without_order(spark, monkeypatch):
    """Null, equal, negative and repeated turns, against a plain rendering; slices and blocks are made small."""
    monkeypatch.setattr(chat, "SLICE", 4)
    monkeypatch.setattr(chat, "BLOCK", 7)
    dice = random.Random(2)
    long = "same beginning " * 20
    rows = [(k % 3, dice.choice([None, -9, 0, 5, 5]), dice.choice("abc"), long + dice.choice(["", "é", "z", "zz"])) for k in range(150)]
    rows += [(1, None, "a", None)] * 40 + [(1, 5, "b c", "x")] * 5 + [(1, 5, "b_c", "x")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    want = []
    for conv in range(3):
        turns = [(t, r.replace(" ", "_"), x or "") for c, t, r, x in rows if c == conv]
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2].encode()))
        for who in {role for _, role, _ in turns}:
            at = 0
            for position, (turn, role, text) in enumerate(turns, 1):
                head = "<|im_start|>" + ("assistant" if role == who else f"user name={role}") + "\n"
                segment = f"{head}{text}<|im_end|>\n"
                mask = (at + len(head), at + len(segment) - 1) if role == who else (None, None)
                want.append((conv, who, turn, position, segment, role == who, at, *mask))
                at += len(segment)
    assert sorted(map(tuple, chat.rotated(df).collect()), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize(
    ("text", "want"),
    [
        (licenses.NOTICES["MIT"], [("MIT", 0)]),
        ("Some text.\nLicensed under CC BY-NC 4.0.\nMore.", [("CC-BY-NC-4.0", 0)]),
        ("x " * 5000 + licenses.NOTICES["GPL-3.0"] + " y" * 5000, [("GPL-3.0", 0)]),
        (f"{licenses.NOTICES['GPL-2.0']}\n{licenses.NOTICES['Apache-2.0']}", [("GPL-2.0", 0), ("Apache-2.0", 0)]),
        ("Copyright 1999 X\n\n" + licenses.TEXTS["MIT"] + "\nint main", [("MIT", 0)]),
        (licenses.TEXTS["GPL-3.0"].replace("useful", "handy"), [("GPL-3.0", 2)]),
        ("This work is licensed under the GNU General Public License, version 9.", []),
        ("My driving license expired and the copyright is unclear.", []),
        ("", []),
    ],
)
def test_licenses(text, want):
    assert [(f[2], f[4]) for f in licenses.Scanner().findings(text)] == want


def test_license_rows(spark):
    notice = licenses.NOTICES["MIT"]
    df = spark.createDataFrame([(1, None, 0), (2, f"é\n{notice}", 0), (2, f"é\n{notice}", 0), (3, "", 0)],
                               "doc_id bigint, text string, license int")
    got = [(r.doc_id, r.start, r.end, r.license, r.exact) for r in licenses.license_scan(df).collect()]
    assert got == [(2, 2, 2 + len(notice) - 1, "MIT", True)] * 2


def test_license_notices_of_the_table(spark):
    """Every notice line of the table is found, and nothing else is."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = {text: name for name, text in licenses.NOTICES.items()}
    want = sorted((r.doc_id, names[line]) for r in docs.collect() for line in r.text.split("\n") if line in names)
    got = sorted((r.doc_id, r.license) for r in licenses.license_scan(docs).collect())
    assert len(want) > 200 and got == want


@pytest.mark.parametrize("between", [" ", "\n\n", "\nCopyright 2001 Y\n" + "other words " * 30])
def test_repeated_licenses_are_each_found(between):
    scanner = licenses.Scanner()
    for name, text, most in (("MIT", licenses.TEXTS["MIT"], 7), ("ISC", licenses.TEXTS["ISC"], 7), ("GPL-2.0", licenses.NOTICES["GPL-2.0"], 30)):
        found = scanner.findings(between.join([text] * most))
        assert [(x[2], x[4]) for x in found] == [(name, 0)] * most
        assert all(a[1] <= b[0] for a, b in zip(found, found[1:], strict=False))


def test_a_changed_license_does_not_hide_a_whole_one():
    changed = licenses.TEXTS["MIT"].replace("free of charge", "for much money, in advance, and never to be paid back by us")
    changed = changed.replace("NONINFRINGEMENT", "a b c d e f g h i j k l m")
    found = licenses.Scanner().findings(f"{changed}\n{licenses.TEXTS['MIT']}\n{changed}")
    assert [(x[2], x[4]) for x in found] == [("MIT", 0)]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("It is licensed under the MIT License, see there.", "MIT"),
        ("Code licensed under the Apache License 2.0", "Apache-2.0"),
        ("Distributed under the terms of the GNU General Public License v3.0", "GPL-3.0"),
        ("available under the GNU LGPL 2.1", "LGPL-2.1"),
        ("// SPDX-License-Identifier: BSD-3-Clause", "BSD-3-Clause"),
        ("Shared under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0"),
        (licenses.TEXTS["BSD-2-Clause"], "BSD-2-Clause"),
        (licenses.TEXTS["BSD-3-Clause"], "BSD-3-Clause"),
        (licenses.TEXTS["MPL-2.0"], "MPL-2.0"),
        (licenses.TEXTS["GPL-2.0"], "GPL-2.0"),
        (licenses.TEXTS["AGPL-3.0"], "AGPL-3.0"),
    ],
)
def test_other_wordings_and_texts(text, want):
    found = licenses.Scanner().findings(text)
    assert [x[2] for x in found] == [want] and found[0][4] == 0


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("# SPDX-License-Identifier: MIT OR Apache-2.0\ncode", ["MIT", "Apache-2.0"]),
        ("/* SPDX-License-Identifier: (MIT AND BSD-3-Clause) */", ["MIT", "BSD-3-Clause"]),
        ("SPDX-License-Identifier: GPL-3.0-or-later", ["GPL-3.0-or-later"]),
        ("SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0 OR Zlib", ["GPL-2.0-only", "Zlib"]),
        ("SPDX-License-Identifier: MIT and then some more words", ["MIT"]),
        ("SPDX-License-Identifier: MIT see the file", ["MIT"]),
        ("SPDX-License-Identifier: NONE", []),
    ],
)
def test_spdx_expressions(text, want):
    assert [x[2] for x in licenses.Scanner().findings(text)] == want


def aligned_everywhere(scanner, text):
    """The findings without any compression: every template aligned with the whole text, the longest places first."""
    split = licenses.words(text)
    plain = [word for word, _, _ in split]
    found = [(split[a][1], split[b - 1][2], name, d) for kind in (scanner.short, scanner.long) for name, _, _, template in kind
             for d, a, b in licenses.wording(template, plain)]
    chosen = []
    for x in sorted(found, key=lambda x: (x[0] - x[1], x[3], x[0])):
        if all(x[1] <= y[0] or y[1] <= x[0] for y in chosen):
            chosen.append(x)
    return sorted(chosen)


def test_ranking_finds_what_full_alignment_finds_with_fewer_alignments(monkeypatch):
    draw, scanner, calls = random.Random(8), licenses.Scanner(), []
    unranked, ranked = licenses.Scanner(), 0
    unranked.ranked = lambda block, line: [(1, 1.0, name, words) for name, _, _, words in (unranked.short if line else unranked.long)]
    full = 0
    plain = licenses.wording
    monkeypatch.setattr(licenses, "wording", lambda *x: calls.append(1) or plain(*x))
    pool = [*licenses.NOTICES.values(), *(" ".join(x.split()) for x in licenses.TEXTS.values())]
    for _ in range(25):
        parts = []
        for text in draw.sample(pool, draw.randint(1, 4)):
            split = text.split(" ")
            if len(split) > 40 and draw.random() < 0.5:
                split[draw.randrange(20, 30)] = "changed"
            parts += [" ".join(split), " ".join(draw.choice(["some", "other", "words", "here"]) for _ in range(draw.randint(0, 60)))]
        text = "\n".join(parts)
        calls.clear()
        got = [(a, b, name, d) for a, b, name, _, d in scanner.findings(text)]
        ranked += len(calls)
        assert got == aligned_everywhere(scanner, text), text
        calls.clear()
        unranked.findings(text)
        full += len(calls)
    assert ranked < full / 3


def test_the_first_confirmed_in_rank_wins(monkeypatch):
    scanner = licenses.Scanner()
    text = licenses.NOTICES["Apache-2.0"]
    assert [x[2] for x in scanner.findings(text)] == ["Apache-2.0"]
    monkeypatch.setattr(scanner, "ranked", lambda *x: [])
    assert scanner.findings(text) == []
