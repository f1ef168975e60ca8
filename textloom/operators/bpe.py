"""Byte-level BPE as Spark jobs.

* T1 pre-token counts: one native regex scan of the corpus (``regexp_extract_all``
  with the published GPT-2 split pattern) + ``groupBy().count()``.
* T2/T3 merge learning: rounds over the *distinct word* table (symbols as binary, four
  bytes each, weighted by count).  Each round: all merges down to a count floor on
  the distinct segments that can change, a rewrite of the words, and an update of the
  adjacent-pair counts by what the changed words lost and gained, which the rewrite adds
  up per batch.  Both tables are written to the shared folder every round and the previous
  ones dropped.
* T4 encode: one Arrow pass per document over its natively split pre-tokens, with
  a bounded cache of encoded pre-tokens per worker; no shuffle.  Token totals
  (T5/A3) come from the same pass without arrays: a number per document, added up per
  group in the same stage, so no word is shuffled.
* T6 decode: one Arrow pass over the id arrays; no shuffle.

Ids: special token 0, the 256 byte symbols 1..256 in the order of their
printable character, merges from 257 in learned order.  Ties between pairs
with equal counts go to the smallest (left id, right id).
"""

from __future__ import annotations

import heapq
import json
import uuid
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import nfc
from .staging import Staging

# The special token and the published GPT-2 pre-tokenisation
# pattern (Java syntax, Unicode whitespace).
SPECIAL = "<|endoftext|>"
# (the endings behind an apostrophe as one branch).
PRETOKEN_PATTERN = ("(?U)'(?:[stmd]|re|ve|ll)| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+"
                    "|\\s+(?!\\S)|\\s+")
SPECIAL_REGEX = "<\\|endoftext\\|>"


def byte_chars() -> list[str]:
    """GPT-2's reversible byte -> printable character map (rule-built)."""
    keep = (list(range(ord("!"), ord("~") + 1)) + list(range(ord("¡"), ord("¬") + 1))
            + list(range(ord("®"), ord("ÿ") + 1)))
    out, extra = {}, 0
    for b in range(256):
        if b in keep:
            out[b] = chr(b)
        else:
            out[b] = chr(256 + extra)
            extra += 1
    return [out[b] for b in range(256)]


def byte_ids() -> list[int]:
    """id of each byte value: 1 + rank of its printable character."""
    chars = byte_chars()
    order = sorted(range(256), key=lambda b: chars[b])
    ids = [0] * 256
    for rank, b in enumerate(order):
        ids[b] = rank + 1
    return ids


BYTE_IDS = byte_ids()
_BYTES = np.array(BYTE_IDS, np.int64)


# --------------------------------------------------------------------------- T1
def pretokens(text: Column) -> Column:
    """Pre-tokens of NFC(text) with the special token split out first:
    array<string>; the special token appears as itself."""
    found = F.regexp_extract_all(text, F.lit(PRETOKEN_PATTERN), 0)
    pieces = F.split(text, SPECIAL_REGEX, -1)
    per_piece = F.transform(pieces, lambda p: F.regexp_extract_all(p, F.lit(PRETOKEN_PATTERN), 0))
    with_special = F.transform(per_piece, lambda ws, i: F.when(i == 0, ws).otherwise(
        F.concat(F.array(F.lit(SPECIAL)), ws)))
    return F.when(text.contains(SPECIAL), F.flatten(with_special)).otherwise(found)


def pretoken_counts(df: DataFrame, text: str = "text", group: tuple = ()) -> DataFrame:
    """``(*group, word, n)`` over NFC text.  Partial aggregation absorbs the
    very frequent pre-tokens (' the', ',') on the map side."""
    t = df.select(*group, nfc(text).alias("_t"))
    return (t.select(*group, F.explode(pretokens(F.col("_t"))).alias("word"))
            .groupBy(*group, "word").agg(F.count(F.lit(1)).alias("n")))


def word_symbols(word: Column) -> Column:
    """Initial symbols of a pre-token: one id per UTF-8 byte."""
    lut = F.array(*[F.lit(i) for i in BYTE_IDS])
    hx = F.hex(F.encode(word, "UTF-8"))
    pairs = F.regexp_extract_all(hx, F.lit("(..)"), 1)
    return F.transform(pairs, lambda h: F.element_at(lut, F.conv(h, 16, 10).cast("int") + 1))


def byte_words(counts: DataFrame) -> DataFrame:
    """Words of two bytes or more as byte symbols: ``(symbols, n)`` from ``(word, n)``; the
    special token is no word."""
    return (counts.filter((F.col("word") != SPECIAL) & (F.octet_length("word") > 1))
            .select(word_symbols(F.col("word")).alias("symbols"), F.col("n").cast("long").alias("n")))


# --------------------------------------------------------------------------- T2
def pair_counts(words: DataFrame, symbols: str = "symbols", weight: str = "n") -> DataFrame:
    """Σ over words of count per adjacent symbol pair -> (left, right, cnt)."""
    n = F.size(symbols)
    zipped = F.arrays_zip(F.slice(symbols, 1, n - 1).alias("l"), F.slice(symbols, 2, n - 1).alias("r"))
    return (words.filter(n > 1)
            .select(F.explode(zipped).alias("p"), weight)
            .groupBy(F.col("p.l").alias("left"), F.col("p.r").alias("right"))
            .agg(F.sum(weight).cast("long").alias("cnt")))


def pair_delta(changed: DataFrame, before: str = "old", after: str = "symbols", weight: str = "n") -> DataFrame:
    """What words that changed add to the pair counts: (left, right, cnt), negative for
    what they lost."""
    lost = pair_counts(changed, before, weight).withColumn("cnt", -F.col("cnt"))
    return lost.unionByName(pair_counts(changed, after, weight))


def update_pair_counts(pairs: DataFrame, delta: DataFrame) -> DataFrame:
    """T2, incremental: the counts after ``delta``; pairs that are gone drop out."""
    return (pairs.unionByName(delta).groupBy("left", "right").agg(F.sum("cnt").alias("cnt"))
            .filter(F.col("cnt") > 0))


# --------------------------------------------------------------------------- T3
#: Distinct segments that the driver merges in one round, and pairs it asks for at most.
SEGMENTS, HOT_PAIRS = 100_000, 1 << 16


def learn_merges(counts: DataFrame, num_merges: int, min_frequency: int = 2,
                 segments: int = SEGMENTS, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """Learn up to ``num_merges`` merges from ``(word, n)`` counts.
    Returns ``merges(rank, left, right, id)`` (id = 257 + rank).  The special
    token is not split into bytes (it has its own id).

    A round takes every merge whose count is at least a floor.  Counts of pairs only
    fall, and a pair of merged symbols is no more frequent than the pair at its inner
    border, so a border whose pair is below the floor stays for the whole round: words
    fall apart there into segments.  Their distinct kinds (at most ``segments``; the floor
    is raised until they fit) are merged one pair at a time on the driver, with exact
    counts, and the words take over the result.

    Where the pairs of the highest count alone are too many, the round takes those up to
    a bound in (left, right) order.  A pair made at a border that is not among them is
    (x, new) for a border (x, a) behind the bound, or (new, y); new ids are the largest,
    so it lies behind the bound as well.  Hence the pairs up to the bound are the next
    ones whatever becomes of the others, and the round ends when none is left.  A single
    pair is merged by the tasks alone.  The driver holds at most ``hot_pairs`` pairs and
    ``segments`` segments."""
    spark = counts.sparkSession
    run = Staging(spark, "merges")
    start = (counts.groupBy("word").agg(F.sum("n").cast("long").alias("n"))
             .filter((F.col("word") != SPECIAL) & (F.octet_length("word") > 1)))
    words = run.write(start.select("word", "n").mapInArrow(_pack_words, _PACKED))
    pairs = run.write(_packed_delta(words).groupBy("left", "right").agg(F.sum("cnt").alias("cnt")))
    merges: list[tuple] = []
    wanted = hot_pairs if words.filter(F.col("symbols").isNotNull()).count() <= segments else min(64, hot_pairs)
    while len(merges) < num_merges:
        often = pairs.filter(F.col("cnt") >= min_frequency)
        top = [r["cnt"] for r in often.orderBy(F.col("cnt").desc()).limit(hot_pairs + 1).select("cnt").collect()]
        if not top:
            break
        live = words.filter(F.octet_length("symbols") > 4).select("symbols", "n")
        while True:
            floor = top[wanted] + 1 if len(top) > wanted else min_frequency
            tied = floor > top[0]
            if tied:  # part of a count level, in order
                floor = top[0]
                level = often.filter(F.col("cnt") == floor).orderBy("left", "right").limit(wanted)
            else:
                level = often.filter(F.col("cnt") >= floor)
            hot = sorted(r["left"] << 32 | r["right"] for r in level.select("left", "right").collect())
            if len(hot) == 1:
                found = []
                break
            found = (live.mapInArrow(_segments(hot), "seg binary, n long").groupBy("seg").agg(F.sum("n").alias("n"))
                     .limit(segments + 1).collect())
            if len(found) <= segments:
                break
            wanted = max(1, min(wanted, len(hot)) // 2)
        room = next((k for k in (8, 4, 2) if len(found) * k * k <= segments), 1)
        if len(hot) == 1:
            pair = hot[0] >> 32, hot[0] & 0xFFFFFFFF
            merges.append((len(merges), *pair, 257 + len(merges)))
            rewrite = _merge_one(*pair, merges[-1][3])
        else:
            seqs = [np.frombuffer(r["seg"], "<i4").tolist() for r in found]
            merges += _merge_segments(seqs, [r["n"] for r in found], floor, 257, len(merges), num_merges,
                                      last=(hot[-1] >> 32, hot[-1] & 0xFFFFFFFF) if tied else None)
            new = {bytes(r["seg"]): np.array(q, "<i4").tobytes() for r, q in zip(found, seqs, strict=True)}
            if floor <= min_frequency and not tied:
                break  # every pair of that count was hot
            rewrite = _replace(hot, new)
        if len(merges) >= num_merges:
            break
        moved = run.write(live.mapInArrow(_packed(rewrite), _PACKED))
        counted = run.write(update_pair_counts(pairs, _packed_delta(moved)))
        run.drop(words, pairs)
        words, pairs = moved, counted
        wanted = min(hot_pairs, wanted * room)
    run.drop(words, pairs)
    return spark.createDataFrame(merges, "rank int, left int, right int, id int")


#: Words as their symbols, four bytes each, with their counts; beside them rows without
#: symbols that say by how much a pair (left << 32 | right) became more or less frequent.
_PACKED = "symbols binary, n long, pair long"


def _packed_delta(packed: DataFrame) -> DataFrame:
    return packed.filter(F.col("pair").isNotNull()).select(
        F.shiftright("pair", 32).cast("int").alias("left"),
        F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("right"), F.col("n").alias("cnt"))


def _lists(column: pa.Array, width: int = 4) -> pa.ListArray:
    """A binary column without nulls as lists of its numbers of ``width`` bytes."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int32)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]].view("<i4" if width == 4 else "u1")
    return pa.ListArray.from_arrays(pa.array((ends - ends[0]) // width), pa.array(data))


def _pair_keys(column: pa.Array, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs in lists of symbols, each with the ``n`` of its list."""
    flat = np.asarray(column.flatten()).astype(np.int64)
    row = np.repeat(np.arange(len(column)), np.asarray(column.value_lengths()))
    inside = row[:-1] == row[1:]
    return (flat[:-1] << 32 | flat[1:])[inside], n[row[:-1][inside]]


def _pack(symbols: pa.Array, n: pa.Array, old: pa.Array | None = None):
    """Batches of ``_PACKED``: the words, and what those that changed (all if ``old`` is not
    given) add to the pair counts."""
    ends = np.asarray(symbols.offsets) * 4
    data = np.asarray(symbols.flatten(), dtype="<i4").tobytes()
    packed = pa.Array.from_buffers(pa.binary(), len(symbols), [None, pa.py_buffer((ends - ends[0]).astype(np.int32)), pa.py_buffer(data)])
    yield pa.RecordBatch.from_arrays([packed, n, pa.nulls(len(n), pa.int64())], ["symbols", "n", "pair"])
    weight = np.asarray(n)
    if old is not None:
        changed = old.is_valid()
        symbols, old, weight = symbols.filter(changed), old.filter(changed), weight[np.asarray(changed)]
    keys, cnt = _pair_keys(symbols, weight)
    if old is not None:
        lost, less = _pair_keys(old, weight)
        keys, cnt = np.concatenate([keys, lost]), np.concatenate([cnt, -less])
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[:len(keys)])
    total = np.add.reduceat(cnt[order], first) if len(first) else np.zeros(0, np.int64)
    keys, total = keys[first][total != 0], total[total != 0]
    yield pa.RecordBatch.from_arrays([pa.nulls(len(keys), pa.binary()), pa.array(total), pa.array(keys)], ["symbols", "n", "pair"])


def _pack_words(batches):
    """Words as byte symbols, and their pair counts."""
    for b in batches:
        letters = _lists(b.column("word").cast(pa.binary()), 1)
        symbols = pa.ListArray.from_arrays(letters.offsets, pa.array(_BYTES[np.asarray(letters.flatten())].astype(np.int32)))
        yield from _pack(symbols, b.column("n"))


def _packed(rewrite):
    """``rewrite`` on packed words, and what it does to the pair counts."""
    def run(batches):
        for b in batches:
            lists = pa.RecordBatch.from_arrays([_lists(b.column("symbols")), b.column("n")], ["symbols", "n"])
            for out in rewrite([lists]):
                yield from _pack(*out.columns)
    return run


def _runs(batch: pa.RecordBatch, hot: np.ndarray):
    """(flat symbols, row starts, row of each segment, its first and its end position):
    runs of two or more symbols whose pairs are all in ``hot``."""
    col = batch.column("symbols")
    flat = np.asarray(col.flatten(), dtype="<i4")
    starts = np.concatenate([[0], np.cumsum(np.asarray(col.value_lengths()))])
    row = np.repeat(np.arange(len(col)), np.diff(starts))
    keys = flat[:-1].astype(np.int64) << 32 | flat[1:]
    at = np.minimum(np.searchsorted(hot, keys), len(hot) - 1)
    on = np.concatenate([[False], (hot[at] == keys) & (row[:-1] == row[1:]), [False]])
    first = np.flatnonzero(~on[:-1] & on[1:])
    end = np.flatnonzero(on[:-1] & ~on[1:]) + 1
    return flat, starts, row[first], first, end


def _segments(hot: list[int]):
    def run(batches):
        known = np.array(hot, np.int64)
        for b in batches:
            b = pa.RecordBatch.from_arrays([_lists(b.column("symbols")), b.column("n")], ["symbols", "n"])
            flat, _, row, first, end = _runs(b, known)
            data, n, total = flat.tobytes(), np.asarray(b.column("n")), {}
            for r, s, e in zip(n[row].tolist(), (first * 4).tolist(), (end * 4).tolist(), strict=True):
                total[data[s:e]] = total.get(data[s:e], 0) + r
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()),
                                              pa.array(list(total.values()), pa.int64())], ["seg", "n"])
    return run


def _rewritten(b: pa.RecordBatch, ends: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
    """The batch with new symbols (flat ``ids``, row ends), and the old ones where a row changed."""
    kept = np.diff(ends) == np.diff(starts)
    symbols = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))
    old = b.column("symbols").take(pa.array(np.arange(b.num_rows), mask=kept))
    return pa.RecordBatch.from_arrays([symbols, b.column("n"), old], ["symbols", "n", "old"])


def _replace(hot: list[int], new: dict[bytes, bytes]):
    def run(batches):
        known = np.array(hot, np.int64)
        for b in batches:
            flat, starts, row, first, end = _runs(b, known)
            data, out, at = flat.tobytes(), [], 0
            less = np.zeros(b.num_rows, np.int64)
            for r, s, e in zip(row.tolist(), (first * 4).tolist(), (end * 4).tolist(), strict=True):
                seg = new[data[s:e]]
                out += (data[at:s], seg)
                at = e
                less[r] += (e - s - len(seg)) // 4
            out.append(data[at:])
            ends = np.concatenate([[0], np.cumsum(np.diff(starts) - less)])
            yield _rewritten(b, ends, np.frombuffer(b"".join(out), "<i4"), starts)
    return run


def _merge_one(left: int, right: int, new: int):
    """One merge in the tasks: occurrences from the left, not overlapping."""
    def run(batches):
        for b in batches:
            flat, starts, row, first, end = _runs(b, np.array([left << 32 | right], np.int64))
            # a run of one pair is (left, right), or of equal symbols, which pair up from the left
            size = end - first
            at = np.concatenate([np.arange(f, e - 1, 2) for f, e in zip(first.tolist(), end.tolist(), strict=True)]
                                or [np.zeros(0, np.int64)]).astype(np.int64)
            flat = flat.copy()
            flat[at] = new
            less = np.bincount(row, weights=size // 2, minlength=b.num_rows).astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(np.diff(starts) - less)])
            yield _rewritten(b, ends, np.delete(flat, at + 1), starts)
    return run


def _merge_segments(seqs: list[list[int]], n: list[int], floor: int, base: int, done: int, upto: int,
                    last: tuple | None = None) -> list[tuple]:
    """Merges of count ``floor`` or more, most frequent first, then the smallest
    (left, right), up to pair ``last`` if given; ``seqs`` are changed in place."""
    cnt: dict[tuple, int] = {}
    where: dict[tuple, set] = {}
    for k, q in enumerate(seqs):
        for p in zip(q, q[1:], strict=False):
            cnt[p] = cnt.get(p, 0) + n[k]
            where.setdefault(p, set()).add(k)
    heap = [(-c, p) for p, c in cnt.items() if c >= floor]
    heapq.heapify(heap)
    out = []
    while heap and done + len(out) < upto:
        c, p = heapq.heappop(heap)
        if cnt.get(p, 0) != -c:  # stale: the count has fallen since
            if cnt.get(p, 0) >= floor:
                heapq.heappush(heap, (-cnt[p], p))
            continue
        if last is not None and p > last:
            break  # pairs that are not here may come first
        a, b = p
        new = base + done + len(out)
        out.append((done + len(out), a, b, new))
        born = set()
        for k in where.pop(p):
            q, i, merged = seqs[k], 0, []
            while i < len(q):
                if q[i] == a and i + 1 < len(q) and q[i + 1] == b:
                    merged.append(new)
                    i += 2
                else:
                    merged.append(q[i])
                    i += 1
            if len(merged) == len(q):
                continue
            for x in zip(q, q[1:], strict=False):
                cnt[x] -= n[k]
            for x in zip(merged, merged[1:], strict=False):
                cnt[x] = cnt.get(x, 0) + n[k]
                if new in x:
                    where.setdefault(x, set()).add(k)
                    born.add(x)
            seqs[k][:] = merged
        cnt.pop(p, None)
        for x in born:
            if cnt[x] >= floor:
                heapq.heappush(heap, (-cnt[x], x))
    return out


def read_merges(spark: SparkSession, path: str) -> DataFrame:
    """The merges of a byte-level BPE file of the tokenizers library, in this module's
    ids (special 0, bytes 1..256, then ``257 + rank``)."""
    with open(path, encoding="utf-8") as f:
        pairs = json.load(f)["model"]["merges"]
    ids = {c: i for c, i in zip(byte_chars(), BYTE_IDS, strict=True)}
    rows = []
    for rank, pair in enumerate(pairs):
        a, b = pair if isinstance(pair, list) else pair.split(" ")
        rows.append((rank, ids[a], ids[b], 257 + rank))
        ids.setdefault(a + b, 257 + rank)
    return spark.createDataFrame(rows, "rank int, left int, right int, id int")


def vocab(spark: SparkSession, merges: DataFrame) -> DataFrame:
    """Vocabulary ``(id, hex)``: the special token, 256 bytes, then merges (the
    bytes of a merge are the concatenation of its parts).  Bounded by the
    vocabulary size; built from the merge list on the driver."""
    m = sorted(merges.collect(), key=lambda r: r["rank"])
    hexes = {0: SPECIAL.encode().hex().upper()}
    for b, i in enumerate(BYTE_IDS):
        hexes[i] = f"{b:02X}"
    for r in m:
        hexes[r["id"]] = hexes[r["left"]] + hexes[r["right"]]
    return spark.createDataFrame(sorted(hexes.items()), "id int, hex string")


# --------------------------------------------------------------------------- T4
#: Encoded pre-tokens, and lengths of pre-tokens, kept per worker; when full, the older half
#: stays (frequent ones are met first).
CACHE, LENGTHS = 200_000, 600_000
#: Pre-tokens of more bytes are merged with a heap.
SHORT = 48
ID_BITS, PLACE_BITS, NONE = 24, 6, 1 << 62
#: Documents encoded or decoded at a time, the items of theirs that are enough, and words merged at a time.
ROWS, ITEMS, WORDS = 1024, 500_000, 16_384
#: Bytes that words are filled up to when they are merged together.
WIDTHS = (2, 4, 6, 8, 10, 12, 16, 24, 32, SHORT)


class WordEncoder:
    """Applies the merges of least rank first, leftmost first: short words by scanning
    for the least rank, many of about one length at a time; long ones with a heap of adjacent
    pairs over a linked list, n log n in the word's length."""

    def __init__(self, merge_rows: list[tuple]):
        self.ranks = {(a, b): (rank, new) for rank, a, b, new in merge_rows}
        self.packed = {a << ID_BITS | b: rank << ID_BITS | new for rank, a, b, new in merge_rows}
        self.cache: dict[str, bytes] = {}
        self.lengths: dict[str, int] = {}
        # pairs in order, each with its place among the merges; new ids by place
        by_rank = sorted(self.packed.items(), key=lambda x: x[1])
        keys = np.array([k for k, _ in by_rank] + [NONE], np.int64)
        place = np.argsort(keys)
        self.pairs, self.places = keys[place], np.where(keys[place] == NONE, NONE, place << PLACE_BITS)
        self.new = np.array([v & (1 << ID_BITS) - 1 for _, v in by_rank], np.int64)
        byte = np.array([*range(257), -1])
        self.first = self.find(byte[:, None], byte, 0)  # pairs of bytes, the last is none

    def encode(self, word: str) -> list[int]:
        return [0] if word == SPECIAL else self.merge([BYTE_IDS[b] for b in word.encode("utf-8")])

    def sizes(self, words: list[str]) -> np.ndarray:
        """Tokens of each of some different words."""
        fresh = [w for w in words if w not in self.lengths]
        for at, _, size in self.encode_all(fresh):
            self.lengths.update(zip(map(fresh.__getitem__, at.tolist()), size.tolist(), strict=True))
        n = np.fromiter(map(self.lengths.__getitem__, words), np.int64, len(words))
        if len(self.lengths) > LENGTHS:
            self.lengths = dict(islice(self.lengths.items(), LENGTHS // 2))
        return n

    def encode_all(self, words: list[str]):
        """Ids of different words, as some ``(which words, their ids in a row, ids of each)``."""
        raw = [w.encode("utf-8") for w in words]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        if SPECIAL in words:
            size[words.index(SPECIAL)] = SHORT + 1
        for i in np.flatnonzero(size > SHORT).tolist():
            ids = np.array(self.encode(words[i]), np.int32)
            yield np.array([i]), ids, np.array([len(ids)])
        for least, width in zip((-1, *WIDTHS), WIDTHS, strict=False):
            group = np.flatnonzero((size > least) & (size <= width))
            for at in (group[i:i + WORDS] for i in range(0, len(group), WORDS)):
                ids = np.full((len(at), width + 1), -1, np.int64)
                data = np.frombuffer(b"".join([raw[i] for i in at.tolist()]), np.uint8)
                ids[np.arange(width + 1) < size[at][:, None]] = _BYTES[data]
                ids = self.scan_all(np.ascontiguousarray(ids.T)).T
                left = ids >= 0
                yield at, ids[left].astype(np.int32), left.sum(axis=1)

    def find(self, a: np.ndarray, b: np.ndarray, i) -> np.ndarray:
        """Merge and position ``i`` as one number for pairs of symbols, ``NONE`` or more if none."""
        key = a << ID_BITS | b
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.places[at] | i, NONE)

    def scan_all(self, ids: np.ndarray) -> np.ndarray:
        """``scan`` of a word in each column, in place: -1 behind a word's end and, on return,
        where a symbol went into the one before it.  The last row is -1."""
        rows, n = ids.shape
        at = np.arange(rows)[:, None]
        found = np.full((rows, n), NONE)
        found[:-1] = self.first[ids[:-1], ids[1:]] + at[:-1]
        after, before = np.repeat(at + 1, n, axis=1), np.repeat(at - 1, n, axis=1)
        while True:
            best = found.min(axis=0)
            on = np.flatnonzero(best < NONE)
            if not len(on):
                return ids
            best = best[on]
            i = best & (1 << PLACE_BITS) - 1
            j = after[i, on]
            k, p, new = after[j, on], before[i, on], self.new[best >> PLACE_BITS]
            ids[i, on], ids[j, on], found[j, on] = new, -1, NONE
            after[i, on], before[k, on] = k, i  # the last row stands for both ends
            found[i, on] = self.find(new, ids[k, on], i)
            found[p, on] = self.find(ids[p, on], new, p)

    def totals(self, column: pa.Array) -> np.ndarray:
        """Tokens of each list of words: only the different words of a batch become
        Python strings."""
        coded = column.flatten().dictionary_encode()
        each = self.sizes(_strings(coded.dictionary))[np.asarray(coded.indices)]
        ends = np.cumsum(np.asarray(column.value_lengths().fill_null(0)))
        upto = np.concatenate([[0], np.cumsum(each)])
        return upto[ends] - upto[np.concatenate([[0], ends[:-1]])] if len(ends) else ends

    def lists(self, column: pa.Array) -> pa.ListArray:
        """Ids of each list of words, put together from those of its different words."""
        coded = column.flatten().dictionary_encode()
        known = self.known(_strings(coded.dictionary))
        size = np.fromiter(map(len, known), np.int64, len(known)) // 4
        return pa.ListArray.from_arrays(*_joined(column, np.frombuffer(b"".join(known), "<i4"), size, np.asarray(coded.indices)))

    def known(self, words: list[str]) -> list[bytes]:
        """Ids of each of some words, four bytes each."""
        fresh = [w for w in dict.fromkeys(words) if w not in self.cache]
        for at, flat, size in self.encode_all(fresh):
            data, ends = flat.astype("<i4").tobytes(), (np.cumsum(size) * 4).tolist()
            self.cache.update({fresh[i]: data[begin:end] for i, begin, end in
                               zip(at.tolist(), [0, *ends[:-1]], ends, strict=True)})
        out = list(map(self.cache.__getitem__, words))
        if len(self.cache) > CACHE:
            self.cache = dict(islice(self.cache.items(), CACHE // 2))
        return out

    def __call__(self, word: str) -> list[int]:
        return np.frombuffer(self.known([word])[0], "<i4").tolist()

    def merge(self, ids: list[int]) -> list[int]:
        return self.scan(ids) if len(ids) <= SHORT else self.heap(ids)

    def scan(self, ids: list[int]) -> list[int]:
        # pairs and (rank, new id) as one number each: least rank, then leftmost
        get, bits = self.packed.get, ID_BITS
        found = [get(a << bits | b, NONE) for a, b in zip(ids, ids[1:], strict=False)]
        while found:
            best = min(found)
            if best == NONE:
                break
            i = found.index(best)
            ids[i:i + 2] = [best & (1 << bits) - 1]
            del found[i]
            if i:
                found[i - 1] = get(ids[i - 1] << bits | ids[i], NONE)
            if i < len(found):
                found[i] = get(ids[i] << bits | ids[i + 1], NONE)
        return ids

    def heap(self, ids: list[int]) -> list[int]:
        n = len(ids)
        after, before, heap = list(range(1, n + 1)), list(range(-1, n - 1)), []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < n:
                found = self.ranks.get((ids[i], ids[after[i]]))
                if found:
                    heapq.heappush(heap, (found[0], i, ids[i], ids[after[i]], found[1]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i]
            if j >= n or ids[i] != a or ids[j] != b:
                continue  # stale: a part of the pair was merged since
            ids[i], ids[j], after[i] = new, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [x for x in ids if x >= 0]


def _slices(batches, column: str):
    """The batches in slices of up to ``ROWS`` rows, that end once they hold ``ITEMS`` items of ``column``."""
    for b in batches:
        ends, at = np.cumsum(np.asarray(b.column(column).value_lengths().fill_null(0), np.int64)), 0
        while at < b.num_rows:
            to = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + ITEMS)) + 1
            yield b.slice(at, min(to - at, ROWS))
            at += min(to - at, ROWS)


def _strings(words: pa.Array) -> list[str]:
    return words.to_numpy(zero_copy_only=False).tolist()


def _joined(column: pa.Array, flat: np.ndarray, size: np.ndarray, index: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """``(offsets, values)`` of the lists of ``column`` when each of its items, piece ``index``,
    gives way to that piece: ``size`` elements each of ``flat``, in order."""
    each = size[index]
    upto = np.concatenate([[0], np.cumsum(each)])
    ends = np.concatenate([[0], np.cumsum(np.asarray(column.value_lengths().fill_null(0)))])
    at = np.repeat((np.cumsum(size) - size)[index] - upto[:-1], each) + np.arange(upto[-1])
    return pa.array(upto[ends], pa.int32()), pa.array(flat[at])


_ENCODERS: dict[str, WordEncoder] = {}


def _encoder(name: str, rows) -> WordEncoder:
    """The worker's encoder of a broadcast merge list, with its cache; the last two are kept."""
    if name not in _ENCODERS:
        while len(_ENCODERS) > 1:
            del _ENCODERS[next(iter(_ENCODERS))]
        _ENCODERS[name] = WordEncoder(rows.value)
    return _ENCODERS[name]


def _shared_encoder(merges: DataFrame):
    """A function for tasks that gives the worker's encoder.  The merge list is bounded by
    the vocabulary size and broadcast."""
    rows, name = merges.sparkSession.sparkContext.broadcast(_merge_rows(merges)), uuid.uuid4().hex
    return lambda: _encoder(name, rows)


def encode_words(words: DataFrame, merges: DataFrame, word: str = "word") -> DataFrame:
    """T4 on distinct pre-tokens: adds ``ids array<int>``."""
    encoder = _shared_encoder(merges)

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def _enc(s: pa.Array) -> pa.Array:
        enc = encoder()
        words = s.to_pylist()
        found = iter(enc.known([w for w in words if w is not None]))
        return pa.array([None if w is None else np.frombuffer(next(found), "<i4") for w in words],
                        type=pa.list_(pa.int32()))

    return words.withColumn("ids", _enc(F.col(word)))


def _merge_rows(merges: DataFrame) -> list[tuple]:
    """The merge list, bounded by the vocabulary size."""
    return [tuple(r) for r in merges.select("rank", "left", "right", "id").collect()]


def encode(df: DataFrame, merges: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """T4 per document: ``(*key, ids)``, in one pass without a shuffle."""
    encoder = _shared_encoder(merges)
    src = df.select(*key, pretokens(nfc(text)).alias("_words"))

    def run(batches):
        enc = encoder()
        for b in _slices(batches, "_words"):
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], enc.lists(b.column("_words"))],
                                             [*b.schema.names[:-1], "ids"])

    return src.mapInArrow(run, T.StructType([*src.schema.fields[:-1],
                                             T.StructField("ids", T.ArrayType(T.IntegerType()))]))


# --------------------------------------------------------------------------- T5 / A3
def token_lengths(df: DataFrame, merges: DataFrame, key: list[str], text: str = "text",
                  count_eos: bool = False) -> DataFrame:
    """T5 per document: ``(*key, tokens)`` of NFC text, in one pass without a shuffle and
    without token arrays; ``count_eos`` adds the one EOS that training appends."""
    encoder = _shared_encoder(merges)
    src = df.select(*key, pretokens(nfc(text)).alias("_words"))

    def run(batches):
        enc = encoder()
        for b in _slices(batches, "_words"):
            n = enc.totals(b.column("_words")) + int(count_eos)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(n, pa.int64())], [*b.schema.names[:-1], "tokens"])

    return src.mapInArrow(run, T.StructType([*src.schema.fields[:-1], T.StructField("tokens", T.LongType())]))


def token_counts(df: DataFrame, merges: DataFrame, group: list[str], text: str = "text",
                 count_eos: bool = False) -> DataFrame:
    """T5/A3: Σ tokens of NFC text per group (no truncation); one scan of the corpus, and
    only sums per task and group are shuffled.  The audit counts no EOS (default);
    ``count_eos=True`` adds the one EOS per document that training appends."""
    return (token_lengths(df, merges, group, text, count_eos)
            .groupBy(*group).agg(F.sum("tokens").cast("long").alias("tokens")))


# --------------------------------------------------------------------------- T6 / T7
def decode(df: DataFrame, voc: DataFrame, ids: str = "ids", key: list[str] = (),
           skip_special: bool = False) -> DataFrame:
    """``(*key, decoded)``: ids -> text (invalid UTF-8 -> U+FFFD, null or no
    ids -> ''), in one pass without a shuffle.  ``voc`` is bounded by the
    vocabulary size; an id that it lacks decodes to nothing."""
    piece = {r["id"]: bytes.fromhex(r["hex"]) for r in voc.collect()}
    if skip_special:
        piece[0] = b""
    lacking = max(piece, default=-1) + 1  # stands for every id that is not there
    src = df.select(*key, F.col(ids).alias("_ids"))

    def run(batches):
        size = np.array([len(piece.get(i, b"")) for i in range(lacking + 1)], np.int64)
        flat = np.frombuffer(b"".join([piece.get(i, b"") for i in range(lacking)]), np.uint8)
        for b in _slices(batches, "_ids"):
            column = b.column("_ids")
            index = np.asarray(column.flatten().fill_null(-1)).astype(np.int64)
            index[(index < 0) | (index > lacking)] = lacking
            offsets, data = _joined(column, flat, size, index)
            text = pa.Array.from_buffers(pa.binary(), b.num_rows, [None, offsets.buffers()[1], data.buffers()[1]])
            try:
                text = text.cast(pa.string())
            except pa.ArrowInvalid:  # some is no UTF-8
                text = pa.array([x.decode("utf-8", "replace") for x in text.to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], text], [*b.schema.names[:-1], "decoded"])

    return src.mapInArrow(run, T.StructType([*src.schema.fields[:-1], T.StructField("decoded", T.StringType())]))


def roundtrip_errors(df: DataFrame, merges: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """One row ``(docs, errors)``: documents whose decode(encode(text)) is
    not NFC(text).  The normalised text travels beside the ids: no join."""
    docs = df.select(*key, F.coalesce(nfc(text), F.lit("")).alias("_n"))
    enc = encode(docs, merges, [*key, "_n"], "_n")
    dec = decode(enc, vocab(df.sparkSession, merges), "ids", [*key, "_n"])
    return dec.agg(F.count(F.lit(1)).alias("docs"),
                   F.count_if(F.col("decoded") != F.col("_n")).alias("errors"))
