"""Exact dedup by a heavy-hitter split, DataFrame functions only.

A Misra-Gries sketch (Spark's ``approx_top_k``) names frequent digests.  Their
winners are recounted exactly and broadcast (at most ``k`` rows), so rows of
frequent digests are resolved on the map side; all other digests take an
ordinary shuffle.  What the sketch names affects only the route of a row,
never its result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WS, stage, text_or_empty


def text_digest(text_col: str) -> Column:
    """SHA-256 (hex) of the text without white space; null counts as empty."""
    return F.sha2(F.translate(text_or_empty(text_col), WS, ""), 256)


def _winner(id_col: str) -> list[Column]:
    # longest text first, then smallest id; a null id loses to any other
    best = F.min(F.struct(-F.col("n"), F.col(id_col).isNull(), F.col(id_col).alias("id")))
    return [best["id"].alias("keep_id"), F.count(F.lit(1)).alias("group_size")]


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                k: int = 1000, tracked: int = 16384) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``,
    ``text_sha256``.

    Texts are equal when identical after removal of white space.  Of equal
    texts the one with the most code points, then the smallest id stays.
    Null texts count as empty; all empty texts are one group; a null id loses
    ties and is kept only if the group has no other of that length.  Rows that
    repeat an id with an equal text share one verdict (``exact_distinct`` keeps
    one of them).  An empty table gives an empty result; other columns are not
    read.
    """
    rows = stage(df.select(F.col(id_col), text_digest(text_col).alias("text_sha256"),
                           F.length(text_or_empty(text_col)).alias("n")), "exact-rows")
    top = rows.agg(F.expr(f"approx_top_k(text_sha256, {int(k)}, {int(tracked)})").alias("t"))
    frequent = stage(top.select(F.explode("t").alias("t"))
                     .filter(F.col("t.count") > 1)
                     .select(F.col("t.item").alias("text_sha256")), "exact-frequent")
    won = stage(rows.join(F.broadcast(frequent), "text_sha256")
                .groupBy("text_sha256").agg(*_winner(id_col)), "exact-winners")
    hot = rows.join(F.broadcast(won), "text_sha256")
    rest = rows.join(F.broadcast(frequent), "text_sha256", "left_anti")
    cold = rest.join(rest.groupBy("text_sha256").agg(*_winner(id_col)), "text_sha256")
    return hot.unionByName(cold).select(
        id_col, "keep_id", F.col("group_size").cast("long"),
        F.col(id_col).eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def exact_distinct(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, one per group, with all their columns.

    The text is shuffled once, by (id, digest), which spreads a large group of
    copies; a row that repeats id and text is dropped in the same partition.
    """
    keep = (exact_dedup(df, id_col, text_col).filter("kept")
            .select(F.col(id_col).alias("_id"), F.col("text_sha256").alias("_sha")).distinct())
    packed = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"),
                       F.col(id_col).alias("_id"), text_digest(text_col).alias("_sha"))
    out = packed.join(keep, packed["_id"].eqNullSafe(keep["_id"]) & (packed["_sha"] == keep["_sha"]),
                      "left_semi")
    return out.dropDuplicates(["_id", "_sha"]).select("_row.*")
