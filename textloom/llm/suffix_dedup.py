"""Removal of long byte strings that occur twice, by a sparse suffix array.

A suffix here is a position and the ``length`` bytes that follow; it is removed
when an equal one starts anywhere else.  Shipping every suffix costs hundreds of
bytes per byte of text, so suffixes travel in runs:

1. Within the ``length`` bytes of a suffix the 32-byte token of least hash is its
   leading token; equal suffixes have equal ones.  Neighbouring suffixes with one
   leading token form a run (about 200 suffixes in prose).
2. Runs that repeat as a whole are duplicates, by count alone.  Runs whose token
   occurs once are unique.  Only the rest (edges of copies) need their bytes.
3. Those are range-partitioned by leading token (Spark samples the splitters).
   Each bucket sorts its suffixes by multikey quicksort on 8-byte words, three-way
   and vectorised, and equal neighbours are duplicates.
4. A token with more kinds of runs than two buckets hold on average is cut across
   buckets: its suffixes, as 126-bit keys with their position, are range-partitioned
   and sorted, neighbours are compared, and the ends of adjacent buckets are compared
   with one another.

Whole runs are told apart within a token by a hash modulo two primes (structured texts
that defeat a hash modulo a power of two do not defeat it), and so is half of the keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, join_hot_split, slices, text_or_empty

TOKEN = 32
#: Suffixes handled at a time; a longer document is cut into such pieces.
PIECE = 1 << 17
#: A leading token with more kinds of runs than this, and than twice the kinds per
#: shuffle partition, takes the bucket-crossing path.
HOT_RUNS = 512
#: Bytes of runs sorted at a time in a bucket.
SORT_BATCH = 4 << 20

_U = np.uint64
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)  # odd, so invertible modulo 2**64
_TABLES: dict = {}


def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse, at least ``n``; kept per worker."""
    have = _TABLES.get(which)
    if have is None or len(have[0]) < n:
        size = max(n, PIECE + 4096)
        have = tuple(np.multiply.accumulate(np.r_[_U(1), np.full(size - 1, b, dtype=_U)])
                     for b in (_BASES[which], pow(_BASES[which], -1, 1 << 64)))
        _TABLES[which] = have
    return have


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


class RollingHash:
    """Hashes of any substring of ``data`` from one prefix sum."""

    def __init__(self, data: np.ndarray, which: int):
        power, self.inverse = _powers(which, len(data) + 1)
        self.sums = np.zeros(len(data) + 1, dtype=_U)
        np.cumsum((data.astype(_U) + _U(1)) * power[:len(data)], out=self.sums[1:])

    def at(self, start, end):
        return _mix((self.sums[end] - self.sums[start]) * self.inverse[start])


#: The two largest primes below 2**31, and a base for each.
_PRIMES, _PRIME_BASES = (2147483647, 2147483629), (1000003, 1664525)


def _prime_powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse modulo a prime, at least ``n``; kept per worker."""
    have = _TABLES.get(("prime", which))
    if have is None or len(have[0]) < n:
        p, tables = _PRIMES[which], []
        for base in (_PRIME_BASES[which], pow(_PRIME_BASES[which], -1, _PRIMES[which])):
            x = np.ones(1, dtype=_U)
            while len(x) < max(n, PIECE + 4096):  # doubling: the powers so far times the next one
                x = np.r_[x, x * _U(pow(base, len(x), p)) % _U(p)]
            tables.append(x)
        have = _TABLES["prime", which] = tuple(tables)
    return have


class PrimeHash:
    """Hashes of any substring of ``data`` modulo two primes, as one number of 62 bits."""

    def __init__(self, data: np.ndarray):
        self.sums = []
        for which, p in enumerate(_PRIMES):
            power, _ = _prime_powers(which, len(data) + 1)
            sums = np.zeros(len(data) + 1, dtype=_U)
            np.cumsum((data.astype(_U) + _U(1)) * power[:len(data)] % _U(p), out=sums[1:])  # below 2**31 * length
            self.sums.append(sums)

    def at(self, start, end):
        out = []
        for which, (p, sums) in enumerate(zip(_PRIMES, self.sums, strict=True)):
            _, inverse = _prime_powers(which, len(sums))
            out.append((sums[end] - sums[start]) % _U(p) * inverse[start] % _U(p))
        return out[0] << _U(31) | out[1]


def sliding(pick: np.ufunc, x: np.ndarray, width: int) -> np.ndarray:
    """``pick`` (minimum or maximum) over every ``width`` neighbours."""
    k = 1
    while 2 * k <= width:
        x = pick(x[:-k], x[k:])
        k *= 2
    return pick(x[:len(x) - (width - k)], x[width - k:]) if width > k else x


def runs_of(data: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(first suffix, suffixes, leading token, content, twice) of each run, piece by
    piece.  ``twice``: the token may stand in the run more than once, as in
    periodic text, so the run may repeat within itself."""
    for at in range(0, len(data) - length + 1, PIECE):
        part = data[at:at + PIECE + length - 1]
        h = RollingHash(part, 0)
        n = len(part) - TOKEN + 1
        token, width = h.at(slice(0, n), slice(TOKEN, None)), length - TOKEN + 1
        least = sliding(np.minimum, token, width)
        edge = np.zeros(width - 1, dtype=_U)
        leading = token[token == sliding(np.maximum, np.r_[edge, least, edge], width)]
        again = leading[1:][leading[1:] == leading[:-1]]
        first = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
        count = np.diff(np.r_[first, len(least)])
        content = PrimeHash(part).at(first, first + count - 1 + length)
        twice = np.isin(least[first], again) if len(again) else np.zeros(len(first), dtype=bool)
        yield at + first, count, least[first], content, twice


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _runs(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            index, out = [], []
            for i, t in enumerate(b.column("bytes").to_pylist()):
                for piece in runs_of(np.frombuffer(t, dtype=np.uint8), length):
                    index.append(np.full(len(piece[0]), i))
                    out.append(piece)
            if out:
                rows = pa.array(np.concatenate(index))
                first, count, token, content, twice = (np.concatenate(x) for x in zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [b.column("_id").take(rows), b.column("_rk").take(rows), pa.array(first.astype(np.int64)),
                     pa.array(count.astype(np.int32)), _signed(token), _signed(content), pa.array(twice)],
                    ["_id", "_rk", "first", "n", "token", "content", "twice"])
    return run


def _segments(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 64):
            index, out = [], []
            for i, (data, runs) in enumerate(zip(b.column("bytes").to_pylist(), b.column("runs").to_pylist(),
                                                 strict=True)):
                for r in runs:
                    index.append(i)
                    out.append((r["token"], r["hot"], r["first"],
                                data[r["first"]:r["first"] + r["n"] - 1 + length]))
            rows = pa.array(index, pa.int64())
            token, hot, first, data = zip(*out, strict=True) if out else ([],) * 4
            yield pa.RecordBatch.from_arrays(
                [b.column("_id").take(rows), b.column("_rk").take(rows), pa.array(token, pa.int64()),
                 pa.array(hot, pa.bool_()), pa.array(first, pa.int64()), pa.array(data, pa.binary())],
                ["_id", "_rk", "token", "hot", "first", "bytes"])
    return run


def repeated_suffixes(buf: np.ndarray, starts: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Indices into ``starts`` of the suffixes that equal another one of their
    group: multikey quicksort by 8-byte words.  At each depth the suffixes of a
    group that equal its pivot stay together without a sort; only groups with
    other words are sorted and split.  Groups of one suffix drop out."""
    words = np.lib.stride_tricks.sliding_window_view(np.r_[buf, np.zeros(8, np.uint8)], 8)
    words = np.ascontiguousarray(words).view(">u8").ravel()
    idx = np.argsort(group, kind="stable")
    grp = group[idx]
    depths = [*range(0, length - 7, 8)]
    if length % 8:
        depths.append(length - 8)  # overlaps the word before it
    for depth in depths:
        head = np.flatnonzero(np.r_[True, grp[1:] != grp[:-1]])
        size = np.diff(np.r_[head, len(grp)])
        alone = np.repeat(size < 2, size)
        if alone.any():
            idx, size = idx[~alone], size[size > 1]
            head = np.cumsum(size) - size
        if not len(idx):
            return idx
        grp = np.repeat(np.arange(len(size)), size)
        key = words[starts[idx] + depth].astype(np.uint64)
        mixed = np.bincount(grp[key != np.repeat(key[head], size)], minlength=len(size)) > 0
        if mixed.any():
            part = np.flatnonzero(mixed[grp])
            order = np.lexsort((key[part], grp[part]))
            idx[part], key[part] = idx[part][order], key[part][order]
            grp = np.cumsum(np.r_[True, (grp[1:] != grp[:-1]) | (key[1:] != key[:-1])])
    head = np.flatnonzero(np.r_[True, grp[1:] != grp[:-1]])
    size = np.diff(np.r_[head, len(grp)])
    return idx[np.repeat(size > 1, size)]


def spans(starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal covered ranges of suffixes at sorted ``starts``."""
    if not len(starts):
        return starts, starts
    new = np.r_[True, starts[1:] > starts[:-1] + length]
    last = np.r_[np.flatnonzero(new)[1:] - 1, len(starts) - 1]
    return starts[new], starts[last] + length


def _sort_bucket(length: int):
    names = ["_id", "_rk", "s", "e"]

    def solve(t: pa.Table) -> pa.RecordBatch:
        data = t.column("bytes").to_pylist()
        size = np.array([len(x) for x in data])
        base = np.cumsum(size) - size
        count = size - length + 1
        seg = np.repeat(np.arange(len(size)), count)
        offset = np.arange(len(seg)) - np.repeat(np.cumsum(count) - count, count)
        _, token = np.unique(t.column("token").to_numpy(), return_inverse=True)
        dup = np.sort(repeated_suffixes(np.frombuffer(b"".join(data), dtype=np.uint8),
                                        base[seg] + offset, token[seg], length))
        seg, offset = seg[dup], offset[dup]
        # suffixes of one run that follow within the length merge into one span
        new = np.flatnonzero(np.r_[True, (seg[1:] != seg[:-1]) | (offset[1:] > offset[:-1] + length)][:len(seg)])
        last = np.r_[new[1:] - 1, len(seg) - 1] if len(new) else new
        rows, first = pa.array(seg[new]), t.column("first").to_numpy()[seg[new]]
        t = t.combine_chunks()
        return pa.RecordBatch.from_arrays(
            [t.column("_id").take(rows).combine_chunks(), t.column("_rk").take(rows).combine_chunks(),
             pa.array(first + offset[new]), pa.array(first + offset[last] + length)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n, waiting = 0, SORT_BATCH
        for b in slices(batches, 2048):
            held.append(b)
            n += b.column("bytes").nbytes
            if n >= waiting:
                t = pa.Table.from_batches(held)
                token = t.column("token").to_numpy()
                cut = int(np.searchsorted(token, token[-1]))  # the last token may go on
                if cut:
                    yield solve(t.slice(0, cut))
                held = t.slice(cut).to_batches()
                n = sum(x.column("bytes").nbytes for x in held)
                waiting = max(SORT_BATCH, 2 * n)
        if held and sum(x.num_rows for x in held):
            yield solve(pa.Table.from_batches(held))
    return run


def _suffix_keys(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            index, at, k1, k2 = [], [], [], []
            for i, (data, first) in enumerate(zip(b.column("bytes").to_pylist(), b.column("first").to_pylist(),
                                                  strict=True)):
                part = np.frombuffer(data, dtype=np.uint8)
                s = np.arange(len(part) - length + 1)
                index.append(np.full(len(s), i))
                at.append(first + s)
                k1.append(RollingHash(part, 0).at(s, s + length))
                k2.append(PrimeHash(part).at(s, s + length))
            if index:
                rows = pa.array(np.concatenate(index))
                yield pa.RecordBatch.from_arrays(
                    [b.column("_id").take(rows), b.column("_rk").take(rows), pa.array(np.concatenate(at)),
                     _signed(np.concatenate(k1)), _signed(np.concatenate(k2))], ["_id", "_rk", "at", "k1", "k2"])
    return run


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key: marks those that equal a neighbour.  ``side`` names the
    first and last row of the bucket, for the comparison across buckets."""
    def mark(t: pa.Table, before, after, first: bool, last: bool):
        k = np.stack([t.column("k1").to_numpy(), t.column("k2").to_numpy()])
        same = (k[:, 1:] == k[:, :-1]).all(axis=0)
        head = before is not None and bool((k[:, 0] == before).all())
        tail = after is not None and bool((k[:, -1] == after).all())
        dup = np.r_[head, same] | np.r_[same, tail]
        side = np.zeros(t.num_rows, dtype=np.int32)
        side[0] |= 1 if first else 0
        side[-1] |= 2 if last else 0
        out = t.append_column("dup", pa.array(dup)).append_column("side", pa.array(side))
        yield from out.filter(pa.array(dup | (side > 0))).to_batches()

    before, held, first = None, None, True
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b])
        if held is not None:
            yield from mark(held, before, (t.column("k1")[0].as_py(), t.column("k2")[0].as_py()), first, False)
            before, first = (held.column("k1")[-1].as_py(), held.column("k2")[-1].as_py()), False
        held = t
    if held is not None:
        yield from mark(held, before, None, first, True)


def _hot_spans(run: Scratch, segments: DataFrame, length: int, id_type) -> DataFrame:
    keys = segments.filter("hot").select("_id", "_rk", "first", "bytes").mapInArrow(
        _suffix_keys(length), T.StructType([
            T.StructField("_id", id_type), T.StructField("_rk", T.LongType()), T.StructField("at", T.LongType()),
            T.StructField("k1", T.LongType()), T.StructField("k2", T.LongType())]))
    parts = int(segments.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["k1", "k2", "_id", "_rk", "at"]  # position last: one key may span buckets
    marked = (keys.repartitionByRange(parts, *order).sortWithinPartitions(*order)
              .mapInArrow(_neighbours, T.StructType([*keys.schema.fields, T.StructField("dup", T.BooleanType()),
                                                     T.StructField("side", T.IntegerType())])))
    marked = run.stage(marked.withColumn("part", F.spark_partition_id()))
    # two rows per bucket, in sorted order: the whole comparison across boundaries
    edge = marked.filter("side > 0").withColumn("end", F.explode(F.expr(
        "filter(array(0, 1), x -> (side & (1 + x)) > 0)")))  # side: 1 first, 2 last, 3 both
    w = Window.orderBy("part", "end")
    key = F.struct("k1", "k2")
    crossing = edge.select("_id", "_rk", "at", "dup", (
        ((F.col("end") == 0) & (F.lag(key).over(w) == key)) |
        ((F.col("end") == 1) & (F.lead(key).over(w) == key))).alias("cross")).filter("cross and not dup")
    found = marked.filter("dup").select("_id", "_rk", "at").unionByName(crossing.select("_id", "_rk", "at"))
    return found.select("_id", "_rk", F.col("at").alias("s"), (F.col("at") + length).alias("e"))


def repeated_spans(src: DataFrame, length: int, hot_runs: int = HOT_RUNS) -> DataFrame:
    """``src``: _id, _rk, bytes.  Spans (_id, _rk, s, e) that cover exactly the
    bytes of suffixes that occur twice; spans may overlap.  ``hot_runs``: see
    ``HOT_RUNS``; 0 sends every token over the bucket-crossing path."""
    id_type = src.schema["_id"].dataType
    run_type = T.StructType([
        T.StructField("_id", id_type), T.StructField("_rk", T.LongType()), T.StructField("first", T.LongType()),
        T.StructField("n", T.IntegerType()), T.StructField("token", T.LongType()), T.StructField("content", T.LongType()),
        T.StructField("twice", T.BooleanType())])
    run = Scratch(src.sparkSession, "suffix")
    runs = run.stage(src.mapInArrow(_runs(length), run_type))
    key = ["token", "content", "n"]
    kinds = run.stage(runs.groupBy(*key).agg(F.count(F.lit(1)).alias("copies"), F.max("twice").alias("twice")))
    tokens = run.stage(kinds.groupBy("token").agg(F.sum("copies").alias("uses"), F.sum(
        F.when(F.col("copies") == 1, 1).otherwise(0)).alias("single"), F.count(F.lit(1)).alias("kinds"),
        F.max("twice").alias("twice")).filter("uses > 1 or twice").drop("twice"))
    parts = int(src.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # kinds of runs that are sorted: those of tokens with a run that does not repeat whole
    sorted_kinds = tokens.filter("single > 0").agg(F.sum("kinds")).first()[0] or 0
    limit = max(hot_runs, 2 * sorted_kinds // parts) if hot_runs else 0
    shared = run.stage(join_hot_split(kinds.drop("twice"), tokens, "token", "kinds", kinds.count())
                       .select(*key, "copies", (F.col("kinds") > limit).alias("hot")))
    state = run.stage(join_hot_split(runs.drop("twice"), shared, key, "copies", runs.count()))
    run.drop(runs, kinds, shared)
    whole = state.filter("copies > 1").select("_id", "_rk", F.col("first").alias("s"),
                                              (F.col("first") + F.col("n") - 1 + length).alias("e"))
    # a run that repeats as a whole still stands for its token's other runs: one copy is enough
    again = state.filter("copies > 1").groupBy(*key).agg(
        F.min(F.struct("_id", "_rk", "first")).alias("m"), F.first("hot").alias("hot")).select(
        "m._id", "m._rk", "m.first", "n", "token", "hot")
    mixed = tokens.filter(F.col("single") > 0).select("token")
    need = state.filter("copies = 1").select("_id", "_rk", "first", "n", "token", "hot").unionByName(
        again.join(mixed, "token", "left_semi"))
    wanted = need.groupBy("_id", "_rk").agg(F.collect_list(F.struct("first", "n", "token", "hot")).alias("runs"))
    wanted = wanted.withColumnsRenamed({"_id": "_wid", "_rk": "_wrk"})
    text = src.join(wanted, src["_id"].eqNullSafe(wanted["_wid"]) & (src["_rk"] == wanted["_wrk"]))
    segments = run.stage(text.select("_id", "_rk", "bytes", "runs").mapInArrow(_segments(length), T.StructType([
        T.StructField("_id", id_type), T.StructField("_rk", T.LongType()), T.StructField("token", T.LongType()),
        T.StructField("hot", T.BooleanType()), T.StructField("first", T.LongType()),
        T.StructField("bytes", T.BinaryType())])))
    span_type = T.StructType([T.StructField("_id", id_type), T.StructField("_rk", T.LongType()),
                              T.StructField("s", T.LongType()), T.StructField("e", T.LongType())])
    cold = (segments.filter("not hot").drop("hot").repartitionByRange(parts, "token")
            .sortWithinPartitions("token").mapInArrow(_sort_bucket(length), span_type))
    # the spans are small beside what they were found in, which goes
    found = run.stage(whole.unionByName(cold).unionByName(_hot_spans(run, segments, length, id_type)))
    run.drop_all_but(found)
    return found


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        out, removed, found = [], [], []
        for data, cover in zip(b.column("bytes").to_pylist(), b.column("cover").to_pylist(), strict=True):
            merged: list[list[int]] = []
            for s, e in sorted((c["s"], c["e"]) for c in cover or ()):
                if merged and s <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], e)
                else:
                    merged.append([s, e])
            at, kept = 0, []
            for s, e in merged:
                kept.append(data[at:s])
                at = e
            out.append(b"".join([*kept, data[at:]]) if merged else data)
            removed.append(len(data) - len(out[-1]))
            found.append([{"s": s, "e": e} for s, e in merged])
        yield pa.RecordBatch.from_arrays(
            [b.column("_id"), b.column("_rk"),
             pa.array([len(x) for x in b.column("bytes").to_pylist()], pa.int64()), pa.array(removed, pa.int64()),
             pa.array(found, pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))), pa.array(out, pa.binary())],
            ["_id", "_rk", "n_bytes", "n_removed", "spans", "kept_bytes"])


def _cover(src: DataFrame, length: int, hot_runs: int) -> DataFrame:
    """Per document the list of its spans (bounded by the document)."""
    if length < TOKEN + 8:
        raise ValueError(f"length must be at least {TOKEN + 8}")
    return (repeated_spans(src, length, hot_runs).groupBy("_id", "_rk")
            .agg(F.collect_list(F.struct("s", "e")).alias("cover"))
            .withColumnsRenamed({"_id": "_cid", "_rk": "_crk"}))


def suffix_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400,
                 hot_runs: int = HOT_RUNS) -> DataFrame:
    """One row per input row: id, ``n_bytes``, ``n_removed``, ``spans`` (maximal
    removed ranges s, e), ``kept_bytes`` (the rest, concatenated).

    Every byte covered by a ``length``-byte string that also starts anywhere
    else, in the same document too, is removed; all are judged on the input.
    Null or empty texts have no bytes.  Documents are told apart by id and text
    hash: rows that repeat both lose every string of that length, as copies of one
    another.  A null id is an id like any other.  An empty table gives an empty result;
    other columns are not read.  ``length`` must be at least 40.
    """
    src = df.select(F.col(id_col).alias("_id"), F.xxhash64(text_or_empty(text_col)).alias("_rk"),
                    text_or_empty(text_col).cast("binary").alias("bytes"))
    cover = _cover(src, length, hot_runs)
    full = src.join(cover, src["_id"].eqNullSafe(cover["_cid"]) & (src["_rk"] == cover["_crk"]), "left")
    span = T.ArrayType(T.StructType([T.StructField("s", T.LongType()), T.StructField("e", T.LongType())]))
    out = full.select("_id", "_rk", "bytes", "cover").mapInArrow(_cut, T.StructType([
        T.StructField("_id", df.schema[id_col].dataType), T.StructField("_rk", T.LongType()),
        T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
        T.StructField("spans", span), T.StructField("kept_bytes", T.BinaryType())]))
    return out.select(F.col("_id").alias(id_col), "n_bytes", "n_removed", "spans", "kept_bytes")


def suffix_cut(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400,
               hot_runs: int = HOT_RUNS) -> DataFrame:
    """``df`` with the repeated strings cut out of its text, other columns as they
    are.  A cut may split a character; its left-over bytes are dropped.  Null stays
    null."""
    others = [c for c in df.columns if c != text_col]
    src = df.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("_row"), F.col(id_col).alias("_id"),
                    F.xxhash64(text_or_empty(text_col)).alias("_rk"), F.col(text_col).isNull().alias("_null"),
                    text_or_empty(text_col).cast("binary").alias("bytes"))
    cover = _cover(src.select("_id", "_rk", "bytes"), length, hot_runs)
    full = src.join(cover, src["_id"].eqNullSafe(cover["_cid"]) & (src["_rk"] == cover["_crk"]), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            kept = next(_cut(iter([b.select(["_id", "_rk", "bytes", "cover"])]))).column("kept_bytes")
            text = [x.decode("utf-8", "ignore") for x in kept.to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("_row"), b.column("_null"), pa.array(text, pa.string())],
                                             ["_row", "_null", "_text"])

    out = full.select("_row", "_null", "_id", "_rk", "bytes", "cover").mapInArrow(run, T.StructType([
        src.schema["_row"], T.StructField("_null", T.BooleanType()), T.StructField("_text", T.StringType())]))
    return out.select(*[(F.when(~F.col("_null"), F.col("_text")) if c == text_col else F.col(f"_row.`{c}`")).alias(c)
                        for c in df.columns])
