"""Connected components of a link table, by alternating large-star and
small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, join_hot_split


def _star(run: Scratch, links: DataFrame, both: bool, total: int) -> DataFrame:
    """One step on links (u, v), u > v.  ``both``: every node sees all its
    neighbours and larger ones move to the smallest (large-star); else a node
    sees its smaller neighbours only and all of them move (small-star).  ``total``: links."""
    seen = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))) if both else links
    # partially aggregated per task, so a node with very many links is cheap here, and the
    # join beside it splits such a node
    least = run.stage(seen.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("_n")))
    moved = join_hot_split(seen, least, "u", "_n", 2 * total if both else total)
    if both:
        out = moved.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    found = run.stage(out.filter(F.col("u") != F.col("v")).distinct())
    run.drop(links, least)
    return found


def components(links: DataFrame, max_rounds: int = 64) -> DataFrame:
    """``links``: columns a, b (comparable ids, any direction, repeats allowed).
    Returns (node, root) with root the smallest node of its component, for every
    node that has a link.  Each step is a table in the shared folder (the one before is
    dropped), so no lineage builds up and nothing of the graph reaches the driver."""
    run = Scratch(links.sparkSession, "links")
    now = run.stage(links.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())

    def mark(df):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before = mark(now)
    for _ in range(max_rounds):
        # a step makes at most one link of each, so the count holds for both
        now = _star(run, _star(run, now, True, before[0]), False, before[0])
        after = mark(now)
        if after == before:  # a fixed point: every node points to its root
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = after
    raise RuntimeError("components: no fixed point")
