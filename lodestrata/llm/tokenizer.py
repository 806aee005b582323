"""Encoding texts with a public byte-level BPE vocabulary (problem 8).

Texts are split into words by the vocabulary's pattern; each distinct word of a batch is encoded once.
The words of a batch that are no token by themselves go through batched merge rounds: their symbols
lie in one flat array, every round looks up all neighbouring pairs by binary search in the sorted
pair keys, takes the lowest rank of each word and merges all its occurrences at once.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Folder of the vocabulary files, in their own format: one base64 token and its rank a line.
TOKENIZER_DIR = os.environ.get("LODESTRATA_TOKENIZERS", "/opt/tokenizers")
# Fixed value: the split pattern of these vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same over texts of ASCII alone, for the faster standard module; \x1c to \x1f are no white space here.
ASCII_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
UNICODE_PATTERN = PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"[^\p{White_Space}", r"[^\p{White_Space}").replace(r"\S", r"[^\p{White_Space}]")
_SHIFT = 20
_NONE = np.int64(1 << 40)


class ByteBpe:
    """A vocabulary of byte tokens with ranks; a token's id is its rank."""

    def __init__(self, path: str):
        import regex

        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines if line.strip())
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        keys, merged = [], []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << _SHIFT | right)
                    merged.append(rank)
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        self.keys, self.merged = np.array(keys, np.int64)[order], np.array(merged, np.int64)[order]
        self.bytes = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        self.ascii, self.unicode = re.compile(ASCII_PATTERN), regex.compile(UNICODE_PATTERN)

    def words(self, text: str) -> list[str]:
        return (self.ascii if text.isascii() else self.unicode).findall(text)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in one array, and the count of each word's ids."""
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        sizes = np.array([len(w) for w in words], np.int64)
        symbols = self.bytes[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), sizes)
        done_symbols, done_owner = [], []
        while symbols.size:
            ranks = np.full(symbols.size, _NONE)
            inside = np.flatnonzero(owner[:-1] == owner[1:])
            wanted = symbols[inside] << _SHIFT | symbols[inside + 1]
            at = np.minimum(np.searchsorted(self.keys, wanted), self.keys.size - 1)
            ranks[inside] = np.where(self.keys[at] == wanted, self.merged[at], _NONE)
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lowest = np.minimum.reduceat(ranks, starts)
            lengths = np.diff(np.r_[starts, symbols.size])
            lowest_here = np.repeat(lowest, lengths)
            still = lowest_here < _NONE
            if not still.all():  # finished words leave the array
                done_symbols.append(symbols[~still])
                done_owner.append(owner[~still])
                symbols, owner, ranks, lowest_here = symbols[still], owner[still], ranks[still], lowest_here[still]
                if not symbols.size:
                    break
            hit = ranks == lowest_here
            # Overlapping hits (a pair of equal symbols in a run): from the left, every second one merges.
            position = np.arange(hit.size)
            last_miss = np.maximum.accumulate(np.where(hit, -1, position))
            hit &= (position - last_miss) % 2 == 1
            chosen = np.flatnonzero(hit)
            symbols[chosen] = lowest_here[chosen]
            keep = np.ones(symbols.size, bool)
            keep[chosen + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        symbols, owner = np.concatenate(done_symbols), np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        return symbols[order], np.bincount(owner, minlength=len(words))


@lru_cache(maxsize=4)
def vocabulary_at(path: str) -> ByteBpe:
    """The vocabulary of a file, built once in each Python worker rather than in each task."""
    return ByteBpe(path)


class BatchEncoder:
    """Encodes batches of texts, remembering the words it has seen."""

    def __init__(self, path: str, most_words: int = 300_000):
        self.bpe, self.most_words = vocabulary_at(path), most_words
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.flat, self.start, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of texts in one array, and the count of each text's ids; none for null and empty texts."""
        if len(self.index) > self.most_words:
            self._forget()
        index, known = self.index, len(self.index)
        split = [self.bpe.words(t) if t else [] for t in texts]
        # setdefault evaluates len(index) before it inserts, so new words are numbered in turn.
        uses = np.array([index.setdefault(w, len(index)) for words in split for w in words], np.int64)
        self._learn(list(index)[known:] if len(index) > known else [])
        per_text = np.array([len(words) for words in split], np.int64)
        sizes = self.size[uses]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if ends.size else 0
        take = np.arange(total) + np.repeat(self.start[uses] - (ends - sizes), sizes)
        bounds = np.r_[0, ends][np.r_[0, np.cumsum(per_text)]]
        return self.flat[take], np.diff(bounds)

    def _learn(self, words: list[str]) -> None:
        if not words:
            return
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        whole = [self.bpe.ranks.get(w, -1) for w in raw]
        apart = [w for w, rank in zip(raw, whole) if rank < 0]
        flat, counts = self.bpe.encode_words(apart)
        whole = np.array(whole, np.int64)
        size = np.ones(len(words), np.int64)
        size[whole < 0] = counts
        out = np.empty(int(size.sum()), np.int32)
        start = np.cumsum(size) - size
        out[start[whole >= 0]] = whole[whole >= 0]
        inside = np.repeat(whole < 0, size)
        out[inside] = flat
        self.start = np.r_[self.start, start + self.flat.size]
        self.size = np.r_[self.size, size]
        self.flat = np.r_[self.flat, out]


def _chunks(texts: list[str | None], most_chars: int) -> Iterator[tuple[int, int]]:
    start = chars = 0
    for i, text in enumerate(texts):
        chars += len(text) if text else 0
        if chars >= most_chars:
            yield start, i + 1
            start, chars = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _encoded(df: DataFrame, key: str, text: str, path: str, counts_only: bool) -> DataFrame:
    texts = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = dict(texts.dtypes)["key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = BatchEncoder(path)
        for batch in batches:
            column = batch.column(1).to_pylist()
            for a, b in _chunks(column, 2_000_000):
                ids, sizes = encode(column[a:b])
                keys = batch.column(0).slice(a, b - a)
                if counts_only:
                    values = pa.array(sizes, pa.int64())
                else:
                    values = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([keys, values], ["key", "value"])

    return texts.mapInArrow(run, f"key {kind}, value {'long' if counts_only else 'array<int>'}").withColumnRenamed("key", key)


def encode(df: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = "byte_bpe_50k", folder: str = TOKENIZER_DIR) -> DataFrame:
    """key, ids: the token ids of each text without special tokens, one row per row of df.

    Null and empty texts have the empty list. Strings that look like special tokens are ordinary
    text. Texts of any length are encoded whole. Null keys stay; other columns are ignored.
    """
    return _encoded(df, key, text, f"{folder}/{vocabulary}.tiktoken", False).withColumnRenamed("value", "ids")


def count_tokens(df: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = "byte_bpe_50k", folder: str = TOKENIZER_DIR) -> DataFrame:
    """key, n_tokens: as encode, but only the number of ids."""
    return _encoded(df, key, text, f"{folder}/{vocabulary}.tiktoken", True).withColumnRenamed("value", "n_tokens")
