"""Tokenised-sample shaping: EOS append, fixed-length packing into blocks,
truncate/pad/label-mask of short samples.

Packing reproduces batched concatenation: rows are cut into ``shards``
contiguous shards of the ordered data, each shard into batches of
``batch_docs`` consecutive rows; every batch is concatenated and cut into
``block``-token blocks; the remainder of a batch is dropped unless the whole
batch has fewer than ``block`` tokens (then it is one short block).

Distributed form: a running sum of lengths inside each (bounded) batch gives
every document its token offset; each document is sliced into the pieces that
fall in each block, and blocks are assembled by grouping on
``(shard, batch, block)`` -- a group never exceeds ``block`` tokens, and no
per-token rows are created.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import nfc


def code_point_ids(text) -> Column:
    """Test tokeniser: the Unicode code points of NFC(text) (empty -> [])."""
    t = nfc(text)
    return F.when(t == "", F.array().cast("array<int>")).otherwise(
        F.transform(F.split(t, ""), lambda c: F.ascii(c)))


def append_eos(ids: Column, eos_id: int) -> Column:
    """Add the EOS id to each document."""
    return F.concat(ids, F.array(F.lit(eos_id)))


def shard_batch(g: Column, n, shards: int, batch_docs: int):
    """(shard, batch) of a 0-based row index ``g`` among ``n`` rows split into
    contiguous shards (first n % shards shards one row larger).  ``n`` is an
    int or a Column (e.g. a per-split row count carried on every row)."""
    if isinstance(n, int):
        div, mod = F.lit(n // shards), F.lit(n % shards)
    else:
        div, mod = F.floor(n / F.lit(shards)), F.pmod(n, F.lit(shards))
    big = (div + 1) * mod                       # rows covered by the larger shards
    shard = F.when(g < big, F.floor(g / (div + 1))) \
             .otherwise(mod + F.floor((g - big) / F.greatest(div, F.lit(1))))
    start = F.when(shard < mod, shard * (div + 1)).otherwise(big + (shard - mod) * div)
    batch = F.floor((g - start) / F.lit(batch_docs))
    return shard.cast("long"), batch.cast("long")


def pack(df: DataFrame, ids_col: str, g_col: str, n, block: int = 1024,
         batch_docs: int = 1000, shards: int = 30, group_cols: tuple = ()) -> DataFrame:
    """``df`` has token arrays ``ids_col`` and a 0-based order index ``g_col``
    (0..n-1 within each ``group_cols`` group, e.g. a split).  ``n``: the group's
    row count as an int, or a column name / Column carried on every row.
    Returns ``(*group_cols, shard, batch, block_idx, input_ids, labels)``."""
    n = F.col(n) if isinstance(n, str) else n
    sb = shard_batch(F.col(g_col), n, shards, batch_docs)
    d = (df.withColumn("shard", sb[0]).withColumn("batch", sb[1])
         .select(*group_cols, g_col, ids_col, "shard", "batch")
         .withColumn("_len", F.size(ids_col)))
    grp = [*group_cols, "shard", "batch"]
    # running token offset inside the batch: a window over <= batch_docs rows
    w_prev = Window.partitionBy(*grp).orderBy(g_col).rowsBetween(Window.unboundedPreceding, -1)
    w_all = Window.partitionBy(*grp)
    d = (d.withColumn("_off", F.coalesce(F.sum("_len").over(w_prev), F.lit(0)))
         .withColumn("_tot", F.sum("_len").over(w_all)))
    # tokens kept from the batch: whole blocks only, unless the batch is short
    keep = F.when(F.col("_tot") >= block, F.floor(F.col("_tot") / block) * block).otherwise(F.col("_tot"))
    d = d.withColumn("_keep", keep).filter((F.col("_len") > 0) & (F.col("_off") < F.col("_keep")))
    first_b = F.floor(F.col("_off") / block)
    last_b = F.floor((F.least(F.col("_off") + F.col("_len"), F.col("_keep")) - 1) / block)
    pieces = d.select(*grp, g_col, ids_col, "_off", "_keep",
                      F.explode(F.sequence(first_b, last_b)).alias("block_idx"))
    lo = F.greatest(F.col("block_idx") * block, F.col("_off"))
    hi = F.least((F.col("block_idx") + 1) * block, F.col("_off") + F.size(ids_col), F.col("_keep"))
    pieces = pieces.select(*grp, "block_idx", g_col,
                           F.slice(ids_col, (lo - F.col("_off") + 1).cast("int"),
                                   (hi - lo).cast("int")).alias("_piece"))
    blocks = pieces.groupBy(*grp, "block_idx").agg(
        F.array_sort(F.collect_list(F.struct(F.col(g_col).alias("g"), "_piece"))).alias("_ps"))
    ids = F.flatten(F.transform("_ps", lambda x: x["_piece"]))
    return blocks.select(*grp, F.col("block_idx").cast("long"), ids.alias("input_ids"),
                         ids.alias("labels"))


def pad_and_mask(ids: Column, max_len: int, prefix_len: int, pad_id: int):
    """Truncate to ``max_len``, right-pad with ``pad_id``; attention 1/0;
    labels -100 for the prefix and for padding (decided by attention, since the
    pad id may equal a real id such as EOS).  Returns three columns."""
    t = F.slice(ids, 1, max_len)
    n = F.size(t)
    pad = F.array_repeat(F.lit(pad_id), F.lit(max_len) - n)
    input_ids = F.concat(t, pad)
    attention = F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), F.lit(max_len) - n))
    labels = F.transform(input_ids, lambda x, i: F.when((i < prefix_len) | (i >= n), F.lit(-100)).otherwise(x))
    return input_ids, attention, labels


def block_stats(blocks: DataFrame, block: int, split_col: str = "split", real: str | None = None) -> DataFrame:
    """Blocks per split and the (over-counting) blocks*block token total;
    ``real``: also the tokens the blocks hold, under this name."""
    aggs = [F.count(F.lit(1)).alias("blocks")]
    if real:
        aggs.append(F.sum(F.size("input_ids")).cast("long").alias(real))
    out = blocks.groupBy(split_col).agg(*aggs)
    return out.select(split_col, "blocks", (F.col("blocks") * block).cast("long").alias("tokens"),
                      *([real] if real else []))


def tokenize(df: DataFrame, merges: DataFrame, key: list[str], eos_id: int = 0,
             text: str = "text") -> DataFrame:
    """NFC, BPE-encode (distinct pre-tokens once), append EOS per document."""
    from .bpe import encode
    return encode(df, merges, key, text).withColumn("ids", append_eos(F.col("ids"), eos_id))
