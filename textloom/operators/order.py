"""Ordering primitives: seeded shuffle key, distributed global row index,
first-N rows in a given order.

No un-partitioned window over the data: a row's bucket is a function of its order
key alone, buckets are counted, and a row's index is its bucket's offset plus its
rank inside the bucket.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def shuffle_key(seed: int, *cols) -> Column:
    """O1: reproducible uniform order key, independent of partitioning (never
    ``rand()``): sha256 of ``seed:col1:col2:...``."""
    parts = [F.lit(str(seed))] + [F.col(c).cast("string") if isinstance(c, str) else c.cast("string")
                                  for c in cols]
    return F.sha2(F.concat_ws(":", *parts), 256)


#: Order keys sampled per bucket to choose the bounds.
SAMPLE = 32
_SPACE = 1 << 40


def _order_key(order: list[str]) -> Column:
    return F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(order)])


def _bounds(df: DataFrame, order: list[str], buckets: int, rows: int) -> list[Column]:
    """At most ``buckets - 1`` sorted order keys that cut the data into about equal
    buckets, as literals.  The sample is the keys whose hash lies below a threshold
    that the row count gives (about ``SAMPLE`` per bucket reach the driver), the same
    whatever the partitioning.  Any bounds give right positions; these only make the
    buckets even."""
    keys = df.select(*order)
    if rows > SAMPLE * buckets:
        keys = keys.filter(F.pmod(F.xxhash64(*order), F.lit(_SPACE)) < _SPACE * SAMPLE * buckets // rows)
    found = keys.distinct().orderBy(*order).collect()
    cuts = sorted({len(found) * i // buckets for i in range(1, buckets)} - {0})
    types = [keys.schema[c].dataType for c in order]
    return [F.struct(*[F.lit(v).cast(t).alias(f"k{i}") for i, (v, t) in enumerate(zip(r, types, strict=True))])
            for r in (found[i] for i in cuts)]


def _bucket(key: Column, bounds: list[Column]) -> Column:
    """Number of bounds at or below the key, by two levels of sorted literals: about
    the square root of their number is compared on each."""
    if not bounds:
        return F.lit(0)
    size = math.isqrt(len(bounds) - 1) + 1
    groups = [bounds[at:at + size] for at in range(0, len(bounds), size)]

    def below(literals: Column) -> Column:
        return F.size(F.filter(literals, lambda b: b <= key))

    # groups whose first bound is at or below the key; the last of them is looked through
    level = below(F.array(*[g[0] for g in groups]))
    inner = F.element_at(F.array(*[F.array(*g) for g in groups]), F.greatest(level, F.lit(1)))
    return F.when(level == 0, 0).otherwise((level - 1) * size + below(inner)).cast("int")


def with_global_index(df: DataFrame, order: list[str], name: str = "g", buckets: int | None = None,
                      total: str | None = None, first: int | None = None) -> DataFrame:
    """O3: 0-based rank of each row in the total order ``order`` (must be unique).

    Three small jobs run when this is called, on the order columns alone: one
    counts the rows, one samples the bounds of the buckets, one counts the buckets.
    There are as many as shuffle partitions (``buckets`` to choose), and a row finds
    its own from the key by literal bounds, so counts and positions agree however the
    rows are partitioned, sampled or recomputed.
    ``total``: also add the row count under this name.  ``first``: keep only rows
    with a smaller index; buckets beyond are dropped before the shuffle.
    """
    if buckets is None:
        buckets = max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    key = df.select(*order)
    bucket = _bucket(_order_key(order), _bounds(df, order, buckets, key.count()))
    counts = dict(key.select(bucket.alias("_b")).groupBy("_b").agg(F.count(F.lit(1))).collect())
    offsets = [0]
    for b in range(max(counts, default=0) + 1):
        offsets.append(offsets[-1] + counts.get(b, 0))
    out = df.withColumn("_b", bucket)
    if first is not None:
        out = out.filter(F.col("_b") < sum(o < first for o in offsets[:-1]))
    rank = F.row_number().over(Window.partitionBy("_b").orderBy(*order)) - 1
    before = F.element_at(F.lit(offsets).cast("array<bigint>"), F.col("_b") + 1)
    out = out.withColumn(name, (before + rank).cast("long")).drop("_b")
    if total:
        out = out.withColumn(total, F.lit(offsets[-1]).cast("long"))
    return out if first is None else out.filter(F.col(name) < first)


def head_rows(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """First ``n`` rows in ``order``, by the global index at every size."""
    return with_global_index(df, order, "_g", first=n).drop("_g")
