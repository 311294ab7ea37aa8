"""Byte-pair encoding of a text column with a public tokenizer's ranks.

A text is divided by the vocabulary's pattern; within a piece the merges are found by a segment tree over the ranks of
adjacent pairs: the root holds the leftmost pair of lowest rank, a merge changes three leaves, and each change climbs to
the root in logarithmic time. The cost of a piece of n bytes is O(n log n), so one very long piece (a run of letters or
blanks) is no worse than many short ones.

Cases: null and empty texts encode to the empty list; texts are encoded whole, whatever their length; repeated rows are
encoded each; special tokens' strings are ordinary text; other columns are carried along.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Where the public vocabularies lie; a parameter of every function that reads one.
TOKENIZER_DIR = "/opt/tokenizers"
#: Fixed value: the division pattern of the byte-level vocabularies.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces kept with their ids by each Python worker; only a cache, any piece not in it is computed.
CACHE_PIECES = 200_000
CACHE_PIECE_BYTES = 512

_NONE = 1 << 62


class SegmentTree:
    """Minimum over leaves, kept in one array; equal ranks are told apart by position, so the leftmost wins."""

    __slots__ = ("size", "tree")

    def __init__(self, keys: list[int]):
        size = 1
        while size < len(keys):
            size *= 2
        tree = [_NONE] * size + keys + [_NONE] * (size - len(keys))
        for i in range(size - 1, 0, -1):
            a, b = tree[2 * i], tree[2 * i + 1]
            tree[i] = a if a < b else b
        self.size, self.tree = size, tree

    def root(self) -> int:
        return self.tree[1]

    def update(self, leaf: int, key: int) -> None:
        tree, i = self.tree, self.size + leaf
        tree[i] = key
        while i > 1:
            a, b = tree[i], tree[i ^ 1]
            low = a if a < b else b
            i >>= 1
            if tree[i] == low:
                return
            tree[i] = low


class Bpe:
    """Encoder for one vocabulary of ranks (bytes to id; merges are ordered by id)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        import regex

        self.ranks = ranks
        self.find = regex.compile(pattern).findall
        self.cache: dict[str, list[int]] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece."""
        n, ranks = len(piece), self.ranks
        parts: list[bytes | None] = [piece[i : i + 1] for i in range(n)]
        if n == 1:
            return [ranks[piece]]
        shift = n.bit_length()
        mask = (1 << shift) - 1
        get = ranks.get
        keys = []
        for i in range(n - 1):
            r = get(piece[i : i + 2])
            keys.append(_NONE if r is None else (r << shift) | i)
        tree = SegmentTree(keys)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while (low := tree.root()) != _NONE:
            i = low & mask
            j = after[i]
            parts[i] += parts[j]
            parts[j] = None
            k = after[i] = after[j]
            if j < n - 1:
                tree.update(j, _NONE)
            if k < n:
                before[k] = i
                r = get(parts[i] + parts[k])
                tree.update(i, _NONE if r is None else (r << shift) | i)
            else:
                tree.update(i, _NONE)
            h = before[i]
            if h >= 0:
                r = get(parts[h] + parts[i])
                tree.update(h, _NONE if r is None else (r << shift) | h)
        return [ranks[p] for p in parts if p is not None]

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text; the empty list for null and empty ones."""
        out: list[int] = []
        if not text:
            return out
        cache = self.cache
        for piece in self.find(text):
            ids = cache.get(piece)
            if ids is None:
                raw = piece.encode("utf-8", "surrogatepass")
                ids = self.merge(raw)
                if len(raw) <= CACHE_PIECE_BYTES and len(cache) < CACHE_PIECES:
                    cache[piece] = ids
            out += ids
        return out


def load_ranks(name: str, folder: str = TOKENIZER_DIR) -> dict[bytes, int]:
    """Ranks of a byte-level vocabulary file ``<name>.tiktoken``."""
    with open(f"{folder}/{name}.tiktoken", "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


_encoders: dict[int, Bpe] = {}


def _encoder(shared) -> Bpe:
    """One encoder per Python worker and vocabulary."""
    ranks = shared.value
    if id(ranks) not in _encoders:
        _encoders[id(ranks)] = Bpe(ranks)
    return _encoders[id(ranks)]


def token_ids(spark: SparkSession, text: Column, name: str = "byte_bpe_50k", folder: str = TOKENIZER_DIR) -> Column:
    """``ARRAY<INT>`` of the text's ids, never null. The vocabulary (under 1 MB) is read here and broadcast."""
    shared = spark.sparkContext.broadcast(load_ranks(name, folder))

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = _encoder(shared)
        for batch in batches:
            yield pa.array([bpe.encode(t) for t in batch.to_pylist()], type=pa.list_(pa.int32()))

    return encode(text)


def token_counts(spark: SparkSession, text: Column, name: str = "byte_bpe_50k", folder: str = TOKENIZER_DIR) -> Column:
    """Number of ids of the text, 0 for null and empty ones."""
    shared = spark.sparkContext.broadcast(load_ranks(name, folder))

    @F.pandas_udf("int")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = _encoder(shared)
        for batch in batches:
            yield pd.Series([len(bpe.encode(t)) for t in batch], dtype="int32")

    return count(text)
