"""BPE encoding and decoding by a contiguous rank array.

A word holds the ids between its part boundaries and, beside them, the ranks of
adjacent pairs.  The smallest rank is found by scanning, its boundary deleted
and the two neighbouring ranks refreshed, until no pair has a rank.  Words are
short, so scanning beats any heap; words over ``SCAN`` bytes take a heap with the
same order (rank, then position).
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.bpe import byte_chars
from .common import slices, text_or_empty
from .tokens import ChunkEncoder, id_type

#: Fixed: the published split pattern of this kind of vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SCAN = 512
_NONE = 1 << 60


class RankBpe:
    """The vocabulary and merges of a byte-level ``tokenizers`` file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, symbols = spec["model"]["vocab"], byte_chars()
        self.byte_ids = [vocab[s] for s in symbols]
        self.ranks: dict[int, int] = {}   # pair -> rank
        self.merged: list[int] = []       # rank -> id
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks.setdefault(vocab[a] << 32 | vocab[b], rank)
            self.merged.append(vocab[a + b])
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._split = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        self._words = regex.compile(PATTERN)
        self._known: dict[str, bytes] = {}
        self.dtype = id_type(path)
        byte_of = {s: b for b, s in enumerate(symbols)}
        top = max([*vocab.values(), *self.added.values()]) + 1
        self.pieces = np.full(top, b"", dtype=object)
        for token, i in vocab.items():
            self.pieces[i] = bytes(byte_of[c] for c in token)
        for token, i in self.added.items():
            self.pieces[i] = token.encode()
        self.encoder = ChunkEncoder(lambda strings: [self._encode(x) for x in strings], self.dtype, list(self.added))

    def word(self, data: bytes) -> list[int]:
        """Ids of one word."""
        if len(data) > SCAN:
            return self._long_word(data)
        ids = [self.byte_ids[b] for b in data]
        rank_of = self.ranks.get
        ranks = [rank_of(a << 32 | b, _NONE) for a, b in zip(ids, ids[1:], strict=False)]
        while ranks:
            best = min(ranks)
            if best == _NONE:
                break
            i = ranks.index(best)
            ids[i] = new = self.merged[best]
            del ids[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = rank_of(new << 32 | ids[i + 1], _NONE)
            if i:
                ranks[i - 1] = rank_of(ids[i - 1] << 32 | new, _NONE)
        return ids

    def _long_word(self, data: bytes) -> list[int]:
        ids = [self.byte_ids[b] for b in data]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap: list[tuple[int, int, int]] = []

        def offer(i: int) -> None:
            if 0 <= i and after[i] < len(ids):
                pair = ids[i] << 32 | ids[after[i]]
                if (rank := self.ranks.get(pair)) is not None:
                    heapq.heappush(heap, (rank, i, pair))

        for i in range(len(ids) - 1):
            offer(i)
        while heap:
            rank, i, pair = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= len(ids) or ids[i] << 32 | ids[j] != pair:
                continue  # a part of the pair has changed since
            ids[i], ids[j], after[i] = self.merged[rank], -1, after[j]
            if after[j] < len(ids):
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [x for x in ids if x >= 0]

    def _encode(self, text: str) -> bytes:
        out = []
        for k, part in enumerate(self._split.split(text)) if self.added else [(0, text)]:
            if k % 2:  # a matched added token
                out.append(np.array([self.added[part]], dtype=self.dtype).tobytes())
                continue
            for w in self._words.findall(part):
                ids = self._known.get(w)
                if ids is None:
                    ids = np.array(self.word(w.encode()), dtype=self.dtype).tobytes()
                    if len(w) <= 32:
                        if len(self._known) >= 200_000:
                            self._known.clear()
                        self._known[w] = ids
                out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> np.ndarray:
        return self.encoder.ids(text)

    def decode(self, ids: np.ndarray) -> str:
        """Text of the ids, added tokens included; invalid UTF-8 is replaced."""
        return b"".join(self.pieces[ids].tolist()).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def load(path: str) -> RankBpe:
    return RankBpe(path)


def _ints(ids: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
    flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def encode_decode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``ids`` (array<int>), ``decoded`` (the text those
    ids decode to).

    Null or empty texts have no ids and decode to the empty text.  Rows are
    handled one by one, so repeats, ties and null ids do not matter; an empty table
    gives an empty result; other columns are not read.  ``path``: a byte-level BPE
    file of the tokenizers library, readable on every executor.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for b in slices(batches):
            ids = bpe.encoder.batch(b.column("t").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), _ints(ids), pa.array([bpe.decode(i) for i in ids], pa.string())],
                ["_id", "ids", "decoded"])

    schema = T.StructType([T.StructField("_id", df.schema[id_col].dataType),
                           T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("decoded", T.StringType())])
    return (df.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("t"))
            .mapInArrow(run, schema).withColumnRenamed("_id", id_col))


def decode_ids(df: DataFrame, path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """Adds the text that an array<int> column decodes to (null array: null)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for b in slices(batches):
            text = [None if i is None else bpe.decode(np.array(i, dtype=np.int64))
                    for i in b.column(ids_col).to_pylist()]
            yield b.append_column(out_col, pa.array(text, pa.string()))

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out_col, T.StringType())]))
