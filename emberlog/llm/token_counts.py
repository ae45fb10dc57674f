"""Token counts: texts are encoded in Arrow batches and only the lengths come back.

Texts are cut where no token can span the cut: before a single space or line feed between two other characters, which
the pre-tokenizer always makes the beginning of a new piece. So a long text is never encoded whole, and what recurs is
encoded once: the distinct pieces go to the library in batches of about equal bytes, and the counts of known pieces are
added up. A text without such a place stays whole.

A null text counts as empty and has no tokens. Repeated rows are counted each; an empty table gives an empty one.
Columns beyond the two named ones are ignored, so clashing names do no harm.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCH_BYTES = 1 << 20
# Texts are worked on in parts of so many characters; the pieces of finished parts are kept up to so many.
PART_CHARS = 4_000_000
KNOWN_PIECES = 500_000
SAFE_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")


def encoded(pieces: Iterable[str], encode: Callable[[list[str]], list[int]]) -> Iterator[tuple[str, int]]:
    """Each piece and its tokens, from batches of about ``BATCH_BYTES``."""
    batch, size = [], 0
    for piece in pieces:
        batch.append(piece)
        size += len(piece.encode())
        if size >= BATCH_BYTES:
            yield from zip(batch, encode(batch), strict=True)
            batch, size = [], 0
    yield from zip(batch, encode(batch), strict=True)


class Counter:
    """Counts the tokens of texts; ``encode`` gives the token numbers of a list of pieces."""

    def __init__(self, encode: Callable[[list[str]], list[int]], cut: bool = True):
        self.encode, self.cut = encode, cut
        self.known: dict[str, int] = {}

    def counts(self, texts: list[str]) -> list[int]:
        result: list[int] = []
        start = 0
        while start < len(texts):
            end, size = start, 0
            while end < len(texts) and (end == start or size + len(texts[end]) <= PART_CHARS):
                size += len(texts[end])
                end += 1
            split = [SAFE_CUT.split(text) if self.cut else [text] for text in texts[start:end]]
            if len(self.known) > KNOWN_PIECES:
                self.known.clear()
            new = set().union(*split) - self.known.keys()
            self.known.update(encoded(new, self.encode))
            result += [sum(map(self.known.__getitem__, pieces)) for pieces in split]
            start = end
        return result


def token_counts(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) of each row, as the library for the file ``tokenizer`` (.json or .model) counts them."""
    kind = df.schema[id_col].dataType

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if tokenizer.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=tokenizer)

            def encode(parts: list[str]) -> list[int]:
                return [len(ids) for ids in model.encode(parts, num_threads=1)]

            counter = Counter(encode, cut=False)  # its tokens may span white space
        else:
            from tokenizers import Tokenizer

            library = Tokenizer.from_file(tokenizer)
            library.no_truncation()
            library.no_padding()

            def encode(parts: list[str]) -> list[int]:
                return [len(e) for e in library.encode_batch_fast(parts, add_special_tokens=False)]

            counter = Counter(encode)
        for batch in batches:
            texts = [text or "" for text in batch.column(1).to_pylist()]
            tokens = [n for start in range(0, len(texts), 256) for n in counter.counts(texts[start : start + 256])]
            sizes = [len(text.encode()) for text in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64())], ["id", "bytes", "tokens"]
            )

    chosen = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    result = chosen.mapInArrow(count, f"id {kind.simpleString()}, bytes bigint, tokens bigint")
    return result.toDF(id_col, "n_bytes", "n_tokens")
