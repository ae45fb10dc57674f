"""Token counts and BPE against the tokenizers library."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from emberlog.llm import bpe, token_counts

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def odd_texts() -> list[str]:
    dice = random.Random(5)
    made = [
        "", " ", "\n\n  \t", "It's  WE'LL <|endoftext|>x <|startoftext|>y <|endof", "Σίσυφος ΟΔΥΣΣΕΥΣ", "a\x1cb\x85c᠎d\xa0e",
        "İstanbul ǅ ﬁ é", "aaaa" * 700, "日本語テスト123４５", "😀😀 👍🏽", "\x00\x01 '''s", "x" * 5000, "word " * 3000,
        "a  b\n\nc \n d", "tab\tend\n",
    ]
    ranges = [(32, 127), (1, 0x2FFF), (0x2000, 0xD7FF), (0x1F300, 0x1FAFF), (9, 33)]
    made += ["".join(chr(dice.randrange(*dice.choice(ranges))) for _ in range(40)) for _ in range(400)]
    return made + made[:5]


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(k, text, "clash") for k, text in enumerate(odd_texts())] + [(-1, None, "x")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string")


def test_counts(texts):
    library = Tokenizer.from_file(BYTES)
    want = {k: len(library.encode(x, add_special_tokens=False)) for k, x in enumerate(odd_texts())} | {-1: 0}
    got = token_counts.token_counts(texts, BYTES).collect()
    assert {r.doc_id: r.n_tokens for r in got} == want
    assert {r.doc_id: r.n_bytes for r in got} == {k: len(x.encode()) for k, x in enumerate(odd_texts())} | {-1: 0}


def test_counts_forget_what_is_too_much(monkeypatch):
    monkeypatch.setattr(token_counts, "KNOWN_PIECES", 3)
    monkeypatch.setattr(token_counts, "PART_CHARS", 50)
    library = Tokenizer.from_file(BYTES)
    counter = token_counts.Counter(lambda x: [len(e) for e in library.encode_batch_fast(x, add_special_tokens=False)])
    assert counter.counts(odd_texts()) == [len(library.encode(x, add_special_tokens=False)) for x in odd_texts()]


def test_counts_of_sentence_pieces(spark):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["", "two  words", "long " * 50]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(texts)], "doc_id int, text string")
    got = token_counts.token_counts(df, path).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {k: len(library.encode(x)) for k, x in enumerate(texts)}


def test_coding(texts):
    library = Tokenizer.from_file(WORDS)
    got = {r.doc_id: r for r in bpe.bpe_code(texts, WORDS).collect()}
    for k, text in [*enumerate(odd_texts()), (-1, "")]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert got[k].ids == " ".join(map(str, ids)), repr(text)
        assert got[k].n_tokens == len(ids)
        assert got[k].decoded == library.decode(ids, skip_special_tokens=False)


def test_coding_letters_that_are_settled():
    """Every letter that is not left to the library, alone and beside others."""
    library = Tokenizer.from_file(WORDS)
    ranges = [(1, 0x250), (0x391, 0x3AA), (0x3B1, 0x3CA), (0x410, 0x450), (0x4E00, 0x9FA6)]
    texts = [f"{chr(c)} a{chr(c)}b" for a, b in ranges for c in range(a, b) if chr(c).isprintable() or c < 0x250]
    coder = bpe.Coder(bpe.Vocabulary(WORDS))
    assert [ids for ids, _ in coder.code(texts)] == [
        " ".join(map(str, e.ids)) for e in library.encode_batch(texts, add_special_tokens=False)
    ]


def test_coding_keeps_no_more_words_than_known(monkeypatch):
    """The words kept from earlier parts and those of a new part are at most KNOWN_WORDS together; ids as the library's."""
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 10)
    monkeypatch.setattr(bpe, "PART_CHARS", 20)
    library = Tokenizer.from_file(WORDS)
    texts = [f"w{k}a w{k}b w{k}c w{k}d" for k in range(6)] + ["w0a w5d", "", "<|endoftext|> w1b"]
    coder = bpe.Coder(bpe.Vocabulary(WORDS))
    sizes = []
    for text in texts:
        assert coder.code([text])[0][0] == " ".join(map(str, library.encode(text, add_special_tokens=False).ids))
        sizes.append(len(coder.ids))
    assert max(sizes) <= 10 and len(coder.decoded) == len(coder.ids)


def test_coding_digests_and_empty_table(spark, texts):
    plain, digests = bpe.bpe_code(texts, WORDS), bpe.bpe_code(texts, WORDS, digests=True)
    want = {r.doc_id: hashlib.sha256(r.ids.encode()).hexdigest() for r in plain.collect()}
    assert {r.doc_id: r.ids_sha256 for r in digests.collect()} == want
    empty = texts.filter(F.lit(False))
    assert bpe.bpe_code(empty, WORDS).count() == 0
    assert token_counts.token_counts(empty, BYTES).count() == 0
