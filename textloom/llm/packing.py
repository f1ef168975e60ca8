"""Vector bin packing of examples into training sequences.

A sequence is a bin with three limits at once: tokens, segments and loss-bearing
tokens.  Bins are filled one at a time; of the examples that fit, the one whose
demand has the largest dot product with the bin's remaining room goes in.
Examples are dealt by a hash of their id into groups of bounded size, and each
group is packed on its own, so packing is one shuffle and holds a few thousand
examples at a time.  Where examples may be cut, a bin that nothing fits any more
is filled by the head of the largest one left.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, text_or_empty
from .tokens import library_encoder

#: Examples per group, on average.
GROUP = 512


@dataclass(frozen=True)
class Limits:
    tokens: int = 1024
    segments: int = 256
    loss: int = 1024


def pack_vectors(tokens: np.ndarray, loss: np.ndarray, limits: Limits, cut: bool = False
                 ) -> list[list[tuple[int, int, int]]]:
    """Sequences as lists of (example, first token, tokens), in order.

    An example over a limit of its own gets a sequence for itself.  With ``cut``
    every token is loss-bearing and any example may be split."""
    todo = np.array(tokens, dtype=np.int64)     # tokens left of each example
    weigh = todo if cut else np.array(loss, dtype=np.int64)  # with ``cut`` all tokens are loss-bearing
    begin = np.zeros(len(todo), dtype=np.int64)
    room = np.array([limits.tokens, limits.segments, limits.loss], dtype=np.float64)
    top = min(limits.tokens, limits.loss) if cut else limits.tokens
    left = np.arange(len(todo))
    if not cut:
        big = (todo > limits.tokens) | (weigh > limits.loss)
        left = left[~big]
        out = [[(int(i), 0, int(todo[i]))] for i in np.flatnonzero(big)]
    else:
        out = []
        for i in np.flatnonzero(todo > top):
            while todo[i] > top:
                out.append([(int(i), int(begin[i]), int(top))])
                begin[i] += top
                todo[i] -= top
    left = left[np.lexsort((left, -todo[left]))]  # largest first: the order of ties
    t, w = todo[left].astype(np.float64), weigh[left].astype(np.float64)  # demands, in place
    here, first = np.ones(len(left), dtype=bool), 0
    while first < len(left):
        free, bin_ = room.copy(), []
        while True:
            fits = here & (t <= free[0]) & (w <= free[2])
            # the dot product of demand and room, both as shares of the limits
            weight = free / room ** 2
            score = np.where(fits, t * weight[0] + weight[1] + w * weight[2], -1.0)
            k = int(np.argmax(score)) if free[1] >= 1 else 0
            if free[1] < 1 or not fits[k]:
                break
            i = int(left[k])
            bin_.append((i, int(begin[i]), int(t[k])))
            free -= (t[k], 1, w[k])
            here[k] = False
        gap = int(min(free[0], free[2]))
        if cut and gap and free[1] >= 1 and here.any():
            k = int(np.argmax(np.where(here, t, -1)))
            i = int(left[k])
            bin_.append((i, int(begin[i]), gap))
            begin[i] += gap
            t[k] -= gap
            w[k] = t[k]
        out.append(bin_)
        while first < len(left) and not here[first]:
            first += 1
    return out


def padded_length(length: int, tokens: int = 1024) -> int:
    """A sequence is padded to the full length unless its own is a power of two."""
    return length if length & (length - 1) == 0 else tokens


def _packer(limits: Limits, cut: bool):
    def solve(t: pa.Table) -> pa.RecordBatch:
        group = t.column("_g")[0].as_py()
        length = t.column("length").to_numpy()
        sequences = pack_vectors(length, t.column("loss").to_numpy(), limits, cut)
        row = [(s, i, begin, n) for s, seq in enumerate(sequences) for i, begin, n in seq]
        seq, item, begin, n = (np.array(x, dtype=np.int64) for x in zip(*row, strict=True))
        offset = np.cumsum(n) - n
        first = np.r_[True, seq[1:] != seq[:-1]]
        offset = offset - np.repeat(offset[first], np.diff(np.r_[np.flatnonzero(first), len(seq)]))
        take = pa.array(item)
        t = t.combine_chunks()
        crc = t.column("crc").take(take).to_pylist()
        data = t.column("ids")
        for k, (i, b, m) in enumerate(zip(item.tolist(), begin.tolist(), n.tolist(), strict=True)):
            if m != length[i]:  # a part: its own checksum
                crc[k] = crc_u32(np.frombuffer(data[i].as_py(), dtype="<u2" if t.column("narrow")[i].as_py() else "<u4")[b:b + m])
        return pa.RecordBatch.from_arrays(
            [t.column("_id").take(take).combine_chunks(),
             pa.array(t.column("start").to_numpy()[item] + begin), pa.array(n), pa.array(crc, pa.int64()),
             t.column("doc_tokens").take(take).combine_chunks(), pa.array((group << 32) + seq), pa.array(offset)],
            ["_id", "start", "length", "crc", "doc_tokens", "sequence_id", "offset"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            while b.num_rows:
                group = b.column("_g").to_numpy()
                if held and held[0].column("_g")[0].as_py() != group[0]:
                    yield solve(pa.Table.from_batches(held))
                    held = []
                end = int(np.searchsorted(group, group[0], side="right"))
                held.append(b.slice(0, end))
                b = b.slice(end)
        if held:
            yield solve(pa.Table.from_batches(held))
    return run


def crc_u32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4"))


def token_pieces(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 tokens: int = 1024, end_id: int | None = 0) -> DataFrame:
    """Tokenized documents in pieces of at most ``tokens`` ids: all but the last
    piece are full.  Only a last piece carries its ids (it may be cut further)."""
    id_t = df.schema[id_col].dataType
    fields = [("_id", id_t), ("_rk", T.LongType()), ("doc_tokens", T.LongType()), ("start", T.LongType()),
              ("length", T.LongType()), ("loss", T.LongType()), ("crc", T.LongType()), ("narrow", T.BooleanType()),
              ("ids", T.BinaryType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = library_encoder(tokenizer)
        narrow, end = enc.dtype == "<u2", np.array([end_id or 0], dtype=enc.dtype)
        for b in slices(batches, 1024):
            index, rows = [], []
            for i, ids in enumerate(enc.batch(b.column("t").to_pylist())):
                if end_id is not None:
                    ids = np.concatenate([ids, end])
                for at in range(0, len(ids), tokens):
                    part = ids[at:at + tokens]
                    index.append(i)
                    rows.append((len(ids), at, len(part), crc_u32(part),
                                 part.tobytes() if len(part) < tokens else None))
            take = pa.array(index, pa.int64())
            n, start, length, crc, data = zip(*rows, strict=True) if rows else ([],) * 5
            yield pa.RecordBatch.from_arrays(
                [b.column("_id").take(take), b.column("_rk").take(take), pa.array(n, pa.int64()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(length, pa.int64()),
                 pa.array(crc, pa.int64()), pa.array([narrow] * len(rows), pa.bool_()), pa.array(data, pa.binary())],
                [f[0] for f in fields])

    return (df.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("t"))
            .withColumn("_rk", F.xxhash64("t"))
            .mapInArrow(run, T.StructType([T.StructField(*f) for f in fields])))


def pack_pieces(pieces: DataFrame, groups: int, limits: Limits, cut: bool = False) -> DataFrame:
    """Place rows (_id, _rk, doc_tokens, start, length, loss, crc, narrow, ids)
    into sequences.  Deterministic: groups and their order depend on the rows only."""
    order = ["_g", "_id", "_rk", "start"]
    out = T.StructType([T.StructField("_id", pieces.schema["_id"].dataType)] + [
        T.StructField(n, T.LongType()) for n in ("start", "length", "crc", "doc_tokens", "sequence_id", "offset")])
    return (pieces.withColumn("_g", F.pmod(F.xxhash64("_id", "_rk"), F.lit(groups)).cast("long"))
            .repartition("_g").sortWithinPartitions(*order).mapInArrow(_packer(limits, cut), out))


def conversation_demands(turns: DataFrame, tokenizer: str, conv_col: str = "conv_id", role_col: str = "role",
                         text_col: str = "text", learned: str = "assistant") -> DataFrame:
    """One row per conversation: ``tokens`` of its turns, an end id behind each, and
    ``loss``: those of the turns whose role is ``learned``.  Null texts are empty; turns
    without a conversation belong to none."""
    id_t = turns.schema[conv_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = library_encoder(tokenizer)
        for b in slices(batches, 1024):
            n = [len(ids) + 1 for ids in enc.batch(b.column("t").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("_id"), b.column("learned"), pa.array(n, pa.int64())],
                                             ["_id", "learned", "n"])

    sizes = (turns.filter(F.col(conv_col).isNotNull())
             .select(F.col(conv_col).alias("_id"), F.coalesce(F.col(role_col) == learned, F.lit(False)).alias("learned"),
                     text_or_empty(text_col).alias("t"))
             .mapInArrow(run, T.StructType([T.StructField("_id", id_t), T.StructField("learned", T.BooleanType()),
                                            T.StructField("n", T.LongType())])))
    return sizes.groupBy(F.col("_id").alias(conv_col)).agg(
        F.sum("n").alias("tokens"), F.coalesce(F.sum(F.when(F.col("learned"), F.col("n"))), F.lit(0)).cast("long").alias("loss"))


def pack_examples(df: DataFrame, id_col: str, tokens_col: str, loss_col: str, limits: Limits = Limits()) -> DataFrame:
    """Instruction data: whole examples under all three limits.  One row per
    example: id, ``sequence_id``, ``offset``.  Null counts are 0; an example over a
    limit is alone in its sequence."""
    rows = df.select(F.col(id_col).alias("_id"), F.coalesce(F.col(tokens_col), F.lit(0)).cast("long").alias("length"),
                     F.coalesce(F.col(loss_col), F.lit(0)).cast("long").alias("loss"))
    zero = F.lit(0).cast("long")
    rows = rows.select("_id", F.xxhash64("length", "loss").alias("_rk"), F.col("length").alias("doc_tokens"),
                       zero.alias("start"), "length", "loss", zero.alias("crc"), F.lit(True).alias("narrow"),
                       F.lit(None).cast("binary").alias("ids"))
    return pack_pieces(rows, -(-df.count() // GROUP) or 1, limits).select(
        F.col("_id").alias(id_col), "sequence_id", "offset")


def pack_documents(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                   limits: Limits = Limits(), end_id: int | None = 0) -> DataFrame:
    """One row per piece: id, ``start`` (ids of its document before it), ``length``,
    ``crc`` (of its ids as little-endian 32-bit integers), ``doc_tokens``,
    ``sequence_id``, ``offset``.

    Every id of every document (and its end id) is in exactly one piece.  Null or
    empty texts give a piece of the end id alone.  Documents are told apart by id
    and text hash; repeated rows are packed each.  An empty table gives an empty
    result; other columns are not read.
    """
    pieces = token_pieces(df, tokenizer, id_col, text_col, limits.tokens, end_id)
    return (pack_pieces(pieces, -(-df.count() // GROUP) or 1, limits, cut=True)
            .withColumnRenamed("_id", id_col))
