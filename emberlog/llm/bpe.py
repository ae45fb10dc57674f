"""BPE encoding and decoding with a pair occurrence index.

The distinct words that a part of a partition brings are laid out in one array of symbols. An index maps each pair,
named by its merge rank, to all its positions there. The lowest active rank is applied to all its positions at once,
left to right; the pairs that arise beside the merged symbols are added to the index. As every merge has a higher rank
than the merges that made its two parts (checked when the vocabulary is read), ascending ranks give the same result
as merging word by word.

A null text counts as empty: no tokens, empty decoded text. Repeated rows are encoded each, from the words known by then.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, pre_tokenizers

from emberlog.llm.shared import released

# Texts are worked on in parts of so many characters, and the words of finished parts are kept up to so many, those of the
# part at hand included.
PART_CHARS = 4_000_000
KNOWN_WORDS = 200_000

WORD_END = "</w>"
# Letters whose class and lower case don't depend on the version of Unicode; others are left to the library.
SETTLED = re.compile("[\\x00-\u024F\u0391-\u03A9\u03B1-\u03C9\u0410-\u044F\u4E00-\u9FA5]*")
PLAIN_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+", re.ASCII)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself where printable, else the next letter from U+0100 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """The merges of a tokenizers file with lower-case words that end in ``</w>``, as arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        ids = content["model"]["vocab"]
        self.tokens = {i: token for token, i in ids.items()}
        self.size = max(self.tokens) + 1
        pairs = [m if isinstance(m, list) else m.split(" ") for m in content["model"]["merges"]]
        left, right, made = (np.array(x) for x in zip(*((ids[a], ids[b], ids[a + b]) for a, b in pairs), strict=True))
        self.left, self.right, self.made = left, right, made
        born = np.full(self.size, -1)
        born[made] = np.arange(len(pairs))
        if len(np.unique(made)) < len(made) or (np.maximum(born[left], born[right]) >= np.arange(len(pairs))).any():
            raise ValueError("the merges don't ascend, so ranks can't be applied in order")
        keys = left * self.size + right
        self.rank_at = np.argsort(keys)
        self.keys = keys[self.rank_at]
        letters = byte_letters()
        self.inner = np.array([ids[x] for x in letters])
        self.final = np.array([ids[x + WORD_END] for x in letters])
        self.special = {x["content"]: x["id"] for x in content["added_tokens"]}
        pattern = content["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.split = regex.compile(pattern)
        library = Tokenizer.from_file(path)
        self.normalizer = library.normalizer
        self.splitter = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
        self.marks = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where it has none."""
        keys = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.rank_at[at], -1)

    def words(self, text: str) -> list[str]:
        """The words of a text in lower case; a special token is a word of its own."""
        found: list[str] = []
        parts = self.marks.split(text) if "<|" in text else [text]
        for k, part in enumerate(parts):
            if k % 2:
                found.append(part)
            elif part.isascii():
                found += PLAIN_SPLIT.findall(part.lower())
            elif not SETTLED.fullmatch(part):
                found += [piece for piece, _ in self.splitter.pre_tokenize_str(self.normalizer.normalize_str(part))]
            else:
                # A final sigma is no special case for the library, which lowers letter by letter.
                found += self.split.findall(unicodedata.normalize("NFC", part).replace("Σ", "σ").lower())
        return found


def merged(vocabulary: Vocabulary, words: list[str]) -> tuple[list[int], list[int]]:
    """Token ids of all words one after the other, and where each word ends among them."""
    if not words:
        return [], []
    raw = [word.encode() for word in words]
    lengths = np.array([len(x) for x in raw])
    ends = np.cumsum(lengths)
    data = np.frombuffer(b"".join(raw), np.uint8)
    symbols = vocabulary.inner[data]
    symbols[ends - 1] = vocabulary.final[data[ends - 1]]
    n = len(symbols)
    following, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    following[ends - 1] = -1
    before[ends - lengths] = -1

    index: dict[int, list[np.ndarray]] = {}

    def add(ranks: np.ndarray, positions: np.ndarray) -> list[int]:
        """Put positions into the index; the ranks that were not active before."""
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        starts = np.flatnonzero(np.r_[True, ranks[1:] != ranks[:-1]])
        fresh = []
        for start, end in zip(starts, [*starts[1:], len(ranks)], strict=True):
            rank = int(ranks[start])
            if rank not in index:
                index[rank] = []
                fresh.append(rank)
            index[rank].append(positions[start:end])
        return fresh

    heads = np.flatnonzero(following >= 0)
    ranks = vocabulary.ranks(symbols[heads], symbols[heads + 1])
    active = add(ranks[ranks >= 0], heads[ranks >= 0]) if (ranks >= 0).any() else []
    heapq.heapify(active)
    while active:
        rank = heapq.heappop(active)
        at = np.concatenate(index.pop(rank))
        left, right = vocabulary.left[rank], vocabulary.right[rank]
        at = at[(symbols[at] == left) & (following[at] >= 0)]
        at = np.unique(at[symbols[following[at]] == right])
        if left == right:  # of overlapping pairs the left one counts
            free, kept = -1, []
            for position in at.tolist():
                if position != free:
                    kept.append(position)
                    free = int(following[position])
            at = np.array(kept, dtype=np.int64)
        if not len(at):
            continue
        gone = following[at]
        symbols[at], symbols[gone] = vocabulary.made[rank], -1
        after = following[gone]
        following[at] = after
        before[after[after >= 0]] = at[after >= 0]
        following[gone] = -1
        heads = np.concatenate([before[at][before[at] >= 0], at[after >= 0]])
        if len(heads):
            ranks = vocabulary.ranks(symbols[heads], symbols[following[heads]])
            if (ranks >= 0).any():
                for new in add(ranks[ranks >= 0], heads[ranks >= 0]):
                    heapq.heappush(active, new)
    alive = symbols >= 0
    return symbols[alive].tolist(), np.cumsum(alive)[ends - 1].tolist()


class Coder:
    """Encodes texts as decimal ids and decodes them, remembering the words of earlier texts up to a bound."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.ids: dict[str, str] = {}
        self.decoded: dict[str, str] = {}

    def learn(self, words: set[str]) -> None:
        known = self.ids
        new = {word for word in words if word not in known}  # a difference with the keys would go through all of them
        if len(known) + len(new) > KNOWN_WORDS:  # the words of this part stay, as the most likely to come again
            self.ids = {word: known[word] for word in words - new}
            self.decoded = {word: self.decoded[word] for word in self.ids}
        special = self.vocabulary.special
        for word in new & special.keys():
            self.ids[word], self.decoded[word] = str(special[word]), word
        plain = list(new - special.keys())
        tokens, ends = merged(self.vocabulary, plain)
        numbers = list(map(str, tokens))
        names = list(map(self.vocabulary.tokens.__getitem__, tokens))
        start = 0
        for word, end in zip(plain, ends, strict=True):
            self.ids[word] = " ".join(numbers[start:end])
            self.decoded[word] = " ".join(names[start:end])
            start = end

    def code(self, texts: list[str]) -> list[tuple[str, str]]:
        """(ids joined by spaces, decoded text) of each text; tokens are joined by spaces, as there is no decoder."""
        result: list[tuple[str, str]] = []
        start = 0
        while start < len(texts):
            end, size = start, 0
            while end < len(texts) and (end == start or size + len(texts[end]) <= PART_CHARS):
                size += len(texts[end])
                end += 1
            split = [self.vocabulary.words(text) for text in texts[start:end]]
            self.learn(set().union(*split))
            ids, decoded = self.ids.__getitem__, self.decoded.__getitem__
            result += [(" ".join(map(ids, words)), " ".join(map(decoded, words))) for words in split]
            start = end
        return result


def bpe_code(
    df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", digests: bool = False
) -> DataFrame:
    """(id, n_tokens, ids, decoded) of each row: the token ids joined by spaces and the text decoded from them.

    With ``digests`` the last two are ``ids_sha256`` and ``decoded_sha256`` in lower-case hex instead.
    Columns beyond the two named ones are ignored, so clashing names do no harm.
    """
    kind = df.schema[id_col].dataType

    def code(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(Vocabulary(tokenizer))
        for batch in batches:
            for start in range(0, batch.num_rows, 256):  # what is held of results is bounded by so many texts
                part = batch.slice(start, 256)
                numbers, ids, decoded = [], [], []
                for listed, text in coder.code([text or "" for text in part.column(1).to_pylist()]):
                    numbers.append(listed.count(" ") + 1 if listed else 0)
                    ids.append(hashlib.sha256(listed.encode()).hexdigest() if digests else listed)
                    decoded.append(hashlib.sha256(text.encode()).hexdigest() if digests else text)
                columns = [pa.array(numbers, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], ["id", "n", "ids", "decoded"])
            pa.default_memory_pool().release_unused()

    chosen = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    result = chosen.mapInArrow(released(code), f"id {kind.simpleString()}, n bigint, ids string, decoded string")
    return result.toDF(id_col, "n_tokens", *(("ids_sha256", "decoded_sha256") if digests else ("ids", "decoded")))
