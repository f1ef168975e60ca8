"""SimHash near-dedup with bit-sliced comparison.

Fingerprints of all documents are reduced to distinct ones, keyed by every
choice of equal bit blocks (two fingerprints within ``radius`` bits share at
least ``blocks - radius`` of ``blocks`` blocks, so no link is lost), and compared
inside each key.  The comparison stores 64 bit planes vertically, 64
fingerprints to a machine word; a shift by ``d`` lanes meets every fingerprint
with its ``d``-th successor.  Distances of all lanes are updated together with
carry-save counters, and words whose lanes all exceed the radius are abandoned.
A key yields links that span its classes, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import join_hot_split, slices, stage, text_or_empty
from .graph import components

SEED = 42
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
#: A key with more fingerprints is cut into chunks of this many, compared pairwise
#: in tasks of their own.
CHUNK = 32768
#: Up to so many cut keys are broadcast (24 bytes each); beyond, they are joined in shares.
LARGE, SHARES = 100_000, 64
#: Rows gathered before a comparison.
BATCH = 1 << 18


def fingerprint(text: str, words_per_shingle: int = 4) -> int:
    """64-bit SimHash of the word shingles (repeats count); 0 without words."""
    words = text.encode().lower().split()  # bytes: ASCII case and white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
    if len(words) > words_per_shingle:
        starts = [0, *[e + 1 for e in ends[:-words_per_shingle]]]
        h = xxhash.xxh64_intdigest
        hashes = [h(joined[s:e], SEED) for s, e in zip(starts, ends[words_per_shingle - 1:], strict=True)]
    else:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    bits = np.unpackbits(np.array(hashes, dtype=">u8").view(np.uint8)).reshape(-1, 64)
    ones = bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(df: DataFrame, id_col: str, text_col: str, words_per_shingle: int) -> DataFrame:
    """(_id, _rk: text hash, fp: the fingerprint as a signed long)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            fp = np.array([fingerprint(t, words_per_shingle) for t in b.column("t").to_pylist()],
                          dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("_id"), b.column("_rk"), pa.array(fp.view(np.int64))],
                                             ["_id", "_rk", "fp"])

    schema = T.StructType([T.StructField("_id", df.schema[id_col].dataType), T.StructField("_rk", T.LongType()),
                           T.StructField("fp", T.LongType())])
    text = text_or_empty(text_col)
    return df.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_rk"), text.alias("t")).mapInArrow(run, schema)


def key_masks(radius: int, blocks: int) -> list[int]:
    """Masks (signed longs) of all choices of ``blocks - radius`` bit blocks."""
    if not 0 <= radius < blocks <= 64:
        raise ValueError("0 <= radius < blocks <= 64 is needed")
    cut = [64 * i // blocks for i in range(blocks + 1)]
    block = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(cut, cut[1:], strict=False)]
    masks = [sum(c) for c in combinations(block, blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def bit_planes(fp: np.ndarray) -> np.ndarray:
    """(64, words): bit b of row r is bit r % 64 of word r // 64 of plane b."""
    n = len(fp)
    words = -(-n // 64)
    bits = np.zeros((64, words * 64), dtype=np.uint8)
    bits[:, :n] = np.unpackbits(fp.astype(">u8").view(np.uint8)).reshape(n, 64).T
    return np.packbits(bits, axis=1, bitorder="little").view("<u8")


def _over(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose carry-save count exceeds the radius."""
    more, equal = np.zeros_like(counters[0]), np.full_like(counters[0], ALL)
    for k in range(len(counters) - 1, -1, -1):
        if radius >> k & 1:
            equal &= counters[k]
        else:
            more |= equal & counters[k]
            equal &= ~counters[k]
    return more


def near_lanes(planes: np.ndarray, d: int, lanes: np.ndarray, radius: int) -> np.ndarray:
    """Of the rows ``lanes`` those within ``radius`` bits of the row ``d`` further
    on.  ``planes`` needs ``d // 64 + 2`` words of padding behind the last row."""
    word, wanted = np.unique(lanes >> 6), None
    wanted = np.zeros(len(word), dtype=np.uint64)
    np.bitwise_or.at(wanted, np.searchsorted(word, lanes >> 6), np.uint64(1) << (lanes & 63).astype(np.uint64))
    q, r = d >> 6, np.uint64(d & 63)
    counters = [np.zeros(len(word), dtype=np.uint64) for _ in range(max(1, radius.bit_length()))]
    dead = ~wanted
    for b in range(0, 64, 8):
        ahead = planes[b:b + 8, word + q]
        if r:
            ahead = (ahead >> r) | (planes[b:b + 8, word + q + 1] << (np.uint64(64) - r))
        differ = planes[b:b + 8, word] ^ ahead
        for carry in differ:
            for k in range(len(counters)):
                counters[k], carry = counters[k] ^ carry, counters[k] & carry
            dead |= carry  # the counters overflowed
        dead |= _over(counters, radius)
        live = dead != ALL
        if not live.any():
            return lanes[:0]
        if 2 * np.count_nonzero(live) < len(live):  # abandon blocks
            word, dead, counters = word[live], dead[live], [c[live] for c in counters]
    row = np.unpackbits((~dead).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    at, lane = np.nonzero(row)
    return word[at] * 64 + lane


def spanning_links(run: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all rows of equal ``run`` (sorted) that are connected
    through distances of at most ``radius``."""
    edge = np.flatnonzero(np.diff(run)) + 1
    size = np.diff(np.r_[0, edge, len(run)])
    many = np.repeat(size > 1, size)
    fp, size = fp[many], size[size > 1]
    n = len(fp)
    if not n:
        return fp, fp
    left = np.concatenate([np.arange(s - 1, -1, -1) for s in size])  # rows of the run behind each row
    longest = int(size.max())
    planes = bit_planes(fp)
    planes = np.pad(planes, ((0, 0), (0, (longest >> 6) + 2)))
    parent = np.arange(n)

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    a, b, lanes = [], [], np.arange(n)
    for d in range(1, longest):
        lanes = lanes[left[lanes] >= d]
        open_ = lanes[parent[lanes] != parent[lanes + d]]  # rows already connected need no comparison
        if not len(open_):
            continue
        met = False
        for i in near_lanes(planes, d, open_, radius).tolist():
            x, y = root(i), root(i + d)
            if x != y:
                parent[max(x, y)] = min(x, y)
                a.append(i)
                b.append(i + d)
                met = True
        while met:
            up = parent[parent]
            met = not np.array_equal(up, parent)
            parent = up
    return fp[np.array(a, dtype=np.int64)], fp[np.array(b, dtype=np.int64)]


def _link_partition(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0

        def flush(last: bool):
            nonlocal held, rows
            t = pa.Table.from_batches(held).combine_chunks()
            k = [t.column(c).to_numpy() for c in ("t", "key", "sub", "fp")]
            new = np.r_[True, (k[0][1:] != k[0][:-1]) | (k[1][1:] != k[1][:-1]) | (k[2][1:] != k[2][:-1])]
            end = t.num_rows if last else int(np.flatnonzero(new)[-1])  # the last run may go on
            held, rows = ([] if last else t.slice(end).to_batches()), t.num_rows - end
            if end:
                a, b = spanning_links(np.cumsum(new)[:end], k[3][:end].view(np.uint64), radius)
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        waiting = BATCH
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
            if rows >= waiting:
                yield from flush(False)
                waiting = max(BATCH, 2 * rows)
        if held:
            yield from flush(True)
    return run


def fingerprint_links(fps: DataFrame, radius: int, blocks: int) -> DataFrame:
    """``fps``: distinct ``fp``.  Links (a, b) that span every class of
    fingerprints connected within ``radius`` bits."""
    masks = key_masks(radius, blocks)
    keys = F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                     for i, m in enumerate(masks)])
    cand = fps.select("fp", F.explode(keys).alias("k")).select("k.t", "k.key", "fp")
    # keys with very many fingerprints: c chunks, every pair of chunks its own task
    large = stage(cand.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > CHUNK)
                  .select("t", "key", F.ceil(F.col("n") / CHUNK).cast("int").alias("c")), "large-keys")
    if large.count() <= LARGE:
        cand = cand.join(F.broadcast(large), ["t", "key"], "left")
    else:  # every key in as many shares as a chunk's rows are cut into
        share = F.pmod(F.xxhash64("fp", "t"), F.lit(SHARES)).cast("int")
        spread = large.withColumn("_share", F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1))))
        cand = cand.withColumn("_share", share).join(spread, ["t", "key", "_share"], "left").drop("_share")
    cand = cand.withColumn("c", F.coalesce("c", F.lit(1)))
    chunk = F.pmod(F.xxhash64("fp"), F.col("c")).cast("int")
    subs = F.transform(F.sequence(F.lit(0), F.col("c") - 1),
                       lambda j: F.least(chunk, j) * F.col("c") + F.greatest(chunk, j))
    cand = cand.select("t", "key", F.explode(subs).alias("sub"), "fp")
    return (cand.repartition("t", "key", "sub").sortWithinPartitions("t", "key", "sub", "fp")
            .mapInArrow(_link_partition(radius), "a long, b long"))


def fp_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _reachable(df: DataFrame, id_col: str, text_col: str, words_per_shingle: int, radius: int, blocks: int) -> DataFrame:
    """(_id, _rk: text hash, fp, root: smallest fingerprint reachable, component_id)."""
    rows = stage(fingerprints(df, id_col, text_col, words_per_shingle), "fingerprints")
    nodes = stage(rows.groupBy("fp").agg(F.min("_id").alias("least"), F.count(F.lit(1)).alias("n")), "fp-nodes")
    comp = components(fingerprint_links(nodes.select("fp"), radius, blocks))
    nodes = nodes.join(comp, nodes["fp"] == comp["node"], "left").withColumn("root", F.coalesce("root", "fp"))
    nodes = stage(nodes.select("fp", "least", "n", "root"), "fp-roots")
    roots = stage(nodes.groupBy("root").agg(F.min("least").alias("component_id"),
                                            F.count(F.lit(1)).alias("fps")), "fp-components")
    named = stage(join_hot_split(nodes, roots, "root", "fps", nodes.count())
                  .select("fp", "n", "root", "component_id"), "fp-named")
    return join_hot_split(rows, named, "fp", "n", rows.count())


def simhash_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  words_per_shingle: int = 4, radius: int = 4, blocks: int = 6) -> DataFrame:
    """One row per input row: id, ``fingerprint`` (16 hex digits), ``component_id``
    (smallest id reachable through fingerprints at most ``radius`` bits apart).

    ``blocks``: bit blocks of the candidate keys; more blocks mean more keys per
    fingerprint and smaller groups (the result is the same).  Null or empty texts
    have fingerprint 0, linked like any other.  Null ids are ignored when the
    smallest is chosen (null if the whole component has no other); repeated rows
    share fingerprint and component.  An empty table gives an empty result; other
    columns are not read.
    """
    return _reachable(df, id_col, text_col, words_per_shingle, radius, blocks).select(
        F.col("_id").alias(id_col), fp_hex(F.col("fp")).alias("fingerprint"), "component_id")


def simhash_distinct(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     words_per_shingle: int = 4, radius: int = 4, blocks: int = 6) -> DataFrame:
    """One row of ``df`` per component, with all its columns: the one of the smallest
    id (null ids last; of equal ids that of the smallest text hash).  A row that repeats
    the survivor's id and text goes too."""
    rows = _reachable(df, id_col, text_col, words_per_shingle, radius, blocks)
    # partially aggregated: a component of very many rows is one row per task here
    same = rows.groupBy("_id", "_rk").agg(F.min("root").alias("root"), F.count(F.lit(1)).alias("n"))
    best = stage(same.groupBy("root").agg(F.min(F.struct(F.col("_id").isNull().alias("no_id"), "_id", "_rk", "n")).alias("b"))
                 .select(F.col("b._id").alias("_keep"), F.col("b._rk").alias("_keep_rk"), F.col("b.n").alias("_keep_n")),
                 "survivors")
    rk = F.xxhash64(text_or_empty(text_col))
    kept = df.join(best, df[id_col].eqNullSafe(best["_keep"]) & (rk == best["_keep_rk"]), "left_semi")
    if best.filter("_keep_n > 1").isEmpty():
        return kept
    return kept.withColumn("_keep_rk", rk).dropDuplicates([id_col, "_keep_rk"]).drop("_keep_rk")
