"""Training mixtures: weight lookup, weighted replication, union of sources,
seeded exact-ratio train/eval split."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .order import shuffle_key, with_global_index


def with_weight(df: DataFrame, registry: DataFrame, default: int = 1) -> DataFrame:
    """Source -> weight from the (broadcast) registry, default 1."""
    w = registry.select("source", F.col("weight").alias("_w"))
    return (df.join(F.broadcast(w), "source", "left")
            .withColumn("weight", F.coalesce("_w", F.lit(default)).cast("int")).drop("_w"))


def replicate(df: DataFrame, weight_col: str = "weight", copy_col: str = "copy") -> DataFrame:
    """Each row emitted ``weight`` times (0 or 1 -> once); ``copy`` = 0..w-1.
    A narrow generator: no shuffle, the copies stay in the source partition."""
    n = F.greatest(F.coalesce(F.col(weight_col), F.lit(1)), F.lit(1))
    return df.withColumn(copy_col, F.explode(F.sequence(F.lit(0), n - 1)))


def union_sources(dfs: list[DataFrame]) -> DataFrame:
    """UNION ALL by column name, duplicates kept."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def eval_size(n: int, ratio: float) -> int:
    """Eval rows for a float test ratio: ceil(ratio * n), computed in double."""
    return int(math.ceil(float(ratio) * n))


def split_exact(df: DataFrame, ratio: float, seed: int, keys: list[str],
                split_col: str = "split", size_col: str | None = None) -> DataFrame:
    """O2: exact-size seeded split.  Rows are ordered by the O1 key of ``keys``;
    the first ceil(ratio*n) are 'eval', the rest 'train'.  Adds ``shuffle_key``
    and the 0-based shuffle position ``g``; with ``size_col``, also each row's
    0-based position inside its split (``{size_col}_pos``) and its split's size."""
    keyed = df.withColumn("shuffle_key", shuffle_key(seed, *keys))
    idx = with_global_index(keyed, ["shuffle_key"], "g", total="_n")
    # ceil(ratio * n) in double, n taken from the index's own counts
    k = F.ceil(F.lit(float(ratio)) * F.col("_n").cast("double"))
    out = idx.withColumn(split_col, F.when(F.col("g") < k, "eval").otherwise("train"))
    if size_col:
        ev = F.col(split_col) == "eval"
        out = (out.withColumn(f"{size_col}_pos", F.when(ev, F.col("g")).otherwise(F.col("g") - k).cast("long"))
               .withColumn(size_col, F.when(ev, k).otherwise(F.col("_n") - k).cast("long")))
    return out.drop("_n")


def training_mixture(df: DataFrame, registry: DataFrame, seed: int, ratio: float,
                     keys: list[str], split_first: bool = False,
                     size_col: str | None = None) -> DataFrame:
    """Weighted, shuffled, exactly split training mixture (G7 + O1 + O2).

    Default (the original order): replicate by source weight, then shuffle and
    split, so copies of one document can land in both train and eval.
    ``split_first=True``: split the unique documents first, then replicate
    inside each split (no document in both)."""
    w = with_weight(df, registry)
    if not split_first:
        return split_exact(replicate(w), ratio, seed, keys + ["copy"], size_col=size_col)
    s = split_exact(w, ratio, seed, keys)
    return replicate(s.drop("g", "shuffle_key")).withColumn(
        "shuffle_key", shuffle_key(seed, *keys, "copy"))
