"""Sharding by minimax contiguous partition, DataFrame functions only.

Groups of equal texts are atomic.  They are ordered by digest, and the smallest
shard capacity for which a greedy left-to-right cut needs at most ``shards``
shards is searched over the running sizes.  The search keeps an interval and
probes ``PROBES`` capacities per round (a wider binary search: one pass over the
running sizes serves all of them), so the driver holds a few numbers per probe.
Because the order is the digest order, a row finds its shard by comparing its
digest with the cut digests: no join, whatever the size of its group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import scratch, stage, text_or_empty

#: Capacities tried per round of the search.
PROBES = 63
#: Length of the digest prefixes (hex digits) within which running sizes are summed.
_PREFIX = 3


def running_sizes(groups: DataFrame) -> DataFrame:
    """``cum``: running sum of ``size`` in digest order, by prefix buckets (the
    buckets' sums are at most 16**3 rows, whatever the input)."""
    g = groups.withColumn("_b", F.substring("digest", 1, _PREFIX))
    sums = g.groupBy("_b").agg(F.sum("size").alias("_s"))
    before = sums.select("_b", F.coalesce(
        F.sum("_s").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("_before"))
    w = Window.partitionBy("_b").orderBy("digest").rowsBetween(Window.unboundedPreceding, 0)
    return (g.withColumn("_in", F.sum("size").over(w)).join(before, "_b")
            .select("digest", "size", (F.col("_before") + F.col("_in")).cast("long").alias("cum")))


def _furthest(cum: DataFrame, starts: list[int], ends: list[int], largest: int) -> list[int]:
    """For each probe the end of a shard that starts at ``starts[i]`` and may reach
    ``ends[i]``: the largest running size up to there."""
    steps = sorted(set(ends))
    # the rows between two neighbouring ends share a step: at most PROBES + 1 rows come back
    step = F.size(F.filter(F.lit(steps), lambda e: e < F.col("cum")))
    near = cum.filter((F.col("cum") > steps[0] - largest) & (F.col("cum") <= steps[-1]))
    top = dict(near.groupBy(step.alias("step")).agg(F.max("cum")).collect())
    reach, best = {}, 0
    for i, e in enumerate(steps):
        best = max(best, top.get(i, 0))
        reach[e] = best
    return [max(s, reach[e]) for s, e in zip(starts, ends, strict=True)]


def _greedy(cum: DataFrame, caps: list[int], shards: int, total: int, largest: int) -> list[list[int]]:
    """The cuts (running sizes) of the greedy check for each capacity."""
    cuts: list[list[int]] = [[] for _ in caps]
    at = [0] * len(caps)
    for _ in range(shards):
        live = [i for i, a in enumerate(at) if a < total]
        if not live:
            break
        ends = [min(at[i] + caps[i], total) for i in live]
        found = _furthest(cum, [at[i] for i in live], ends, largest)
        for i, e in zip(live, found, strict=True):
            at[i] = e
            cuts[i].append(e)
    return cuts


def minimax_cuts(cum: DataFrame, shards: int) -> tuple[int, list[int]]:
    """(smallest feasible capacity, its cuts as running sizes)."""
    total, largest = cum.agg(F.max("cum"), F.max("size")).first()
    if not total:
        return 0, []
    lo = max(-(-total // shards), largest)  # nothing below can be feasible
    hi = -(-total // shards) + largest      # always feasible
    best = None
    while best is None or lo < hi:
        span = hi - lo
        caps = sorted({lo + span * i // PROBES for i in range(PROBES)} | {hi})
        cuts = _greedy(cum, caps, shards, total, largest)
        ok = next(i for i, c in enumerate(cuts) if c[-1] >= total)
        best, hi = cuts[ok], caps[ok]
        lo = hi if ok == 0 else caps[ok - 1] + 1
    return hi, best


def _heavy(cum: DataFrame, shards: int, total: int) -> list[tuple[int, int]]:
    """(begin, end) as running sizes of the groups larger than an even share of what the
    others leave: fewer than ``shards``."""
    heavy: list[tuple[int, int]] = []
    while True:
        rest, free = total - sum(e - b for b, e in heavy), shards - len(heavy)
        found = [(r["cum"] - r["size"], r["cum"]) for r in
                 cum.filter(F.col("size") * free > rest).orderBy("cum").select("cum", "size").collect()]
        if len(found) == len(heavy):
            return heavy
        heavy = found


def even_cuts(cum: DataFrame, shards: int, total: int, capacity: int) -> list[int] | None:
    """Cuts where some groups are larger than an even share: such a group is a shard of
    its own, and the groups between are cut evenly into the other shards.  None if there
    is no such group, or if no such cuts stay within the capacity."""
    heavy = _heavy(cum, shards, total)
    if not heavy:
        return None
    marks = [0, *[x for h in heavy for x in h], total]
    between = [(b, e) for b, e in zip(marks[::2], marks[1::2], strict=True) if e > b]
    free = shards - len(heavy)
    if len(between) > free:
        return None
    share = [1] * len(between)
    for _ in range(free - len(between) if between else 0):  # one more to the one with the largest shards
        share[max(range(len(between)), key=lambda i: (between[i][1] - between[i][0]) / share[i])] += 1
    ideal = [b + (e - b) * i // n for (b, e), n in zip(between, share, strict=True) for i in range(1, n)]
    nearest = []
    if ideal:  # the group borders at or below and above each point: two numbers each
        row = cum.agg(*[f(F.when(c, F.col("cum"))).alias(f"{k}{i}") for i, x in enumerate(ideal) for k, f, c in (
            ("lo", F.max, F.col("cum") <= x), ("hi", F.min, F.col("cum") > x))]).first()
        for i, x in enumerate(ideal):
            lo, hi = row[f"lo{i}"] or 0, row[f"hi{i}"]
            nearest.append(lo if x - lo <= hi - x else hi)
    cuts = sorted({*nearest, *[e for _, e in between], *[x for h in heavy for x in h]} - {0})
    sizes = [e - b for b, e in zip([0, *cuts], cuts, strict=False)]
    return cuts if len(cuts) == shards and max(sizes) <= capacity else None


def assign_shards(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  shards: int = 8, slot_buckets: int = 256) -> DataFrame:
    """One row per input row: id, ``size`` (UTF-8 bytes + 1), ``text_crc32``,
    ``shard``, ``slot`` (gapless from 0 in each shard).

    Equal texts share a shard; null equals empty (size 1).  Slots follow a hash
    of the id, then id and checksum, inside hash buckets, so a large group of
    copies is numbered by many tasks; repeated rows get slots of their own.
    A group larger than an even share bounds the capacity from below; it is a shard of its
    own then, and the others are cut evenly (where that stays within the capacity).
    An empty table gives an empty result; other columns are not read.
    """
    text = text_or_empty(text_col)
    rows = stage(df.select(
        F.col(id_col), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.sha2(text, 256).alias("digest")), "shard-rows")
    groups = rows.groupBy("digest").agg(F.sum("size").alias("size"))
    path = scratch(df.sparkSession, "shard-cum")
    running_sizes(groups).sortWithinPartitions("cum").write.parquet(path)
    cum = df.sparkSession.read.parquet(path)
    capacity, cuts = minimax_cuts(cum, shards)
    if cuts:
        cuts = even_cuts(cum, shards, cuts[-1], capacity) or cuts
    last = ([r[0] for r in cum.filter(F.col("cum").isin(cuts)).orderBy("cum").select("digest").collect()]
            if cuts else [])  # at most one digest per shard
    shard = F.lit(0)
    for d in last[:-1]:
        shard = shard + F.when(F.col("digest") > d, 1).otherwise(0)
    rows = rows.withColumn("shard", shard.cast("int")).withColumn(
        "_b", F.pmod(F.xxhash64(F.col(id_col), F.col("text_crc32")), F.lit(slot_buckets)).cast("int"))
    n = rows.groupBy("shard", "_b").agg(F.count(F.lit(1)).alias("_n"))
    off = n.select("shard", "_b", F.coalesce(F.sum("_n").over(
        Window.partitionBy("shard").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("_off"))
    w = Window.partitionBy("shard", "_b").orderBy(F.xxhash64(F.col(id_col)), F.col(id_col),
                                                  "text_crc32", "digest")
    return (rows.withColumn("_i", F.row_number().over(w) - 1).join(off, ["shard", "_b"])
            .select(id_col, "size", "text_crc32", "shard",
                    (F.col("_off") + F.col("_i")).cast("long").alias("slot")))
