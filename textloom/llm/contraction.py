"""Subtree totals of a forest by parallel tree contraction.

Rounds alternate two steps over the nodes that are left.  *Compress*: a chain of
nodes with one child each is taken out at once; its nodes find the node below the
chain by pointer doubling, adding up what they pass, and that node becomes the child
of the chain's upper neighbour.  *Rake*: all leaves are taken out, their totals are
known, and their parents take them over.  After a compress every inner node has two
children or more, so a rake takes out over half of all nodes, and the rounds are
logarithmic however deep the trees are.

Then the chains are re-expanded, the last one first: the total of a node taken out
by compress is the total of the node below its chain plus what lies between.

Every step is an equi-join on unique node keys or a partially aggregated group-by, so
a node with very many children is no hot key; a very long chain is (all its nodes ask
for one total), and that join splits it.  Tables are staged in the shared folder and
dropped once they are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, join_hot_split


def _plus(a: str, b: Column, name: str) -> Column:
    return (F.col(a) + F.coalesce(b, F.lit(0))).cast("long").alias(name)


def _compress(run: Scratch, state: DataFrame, values: list[str]) -> tuple[DataFrame, DataFrame]:
    """(nodes without the chains' nodes, chain nodes (node, ptr: the node below the
    chain, a_*: what the chain adds from the node down to ``ptr``)).  e_* of a node is
    what was taken out between it and its present parent."""
    only = F.col("parent").isNotNull() & (F.coalesce("kids", F.lit(0)) == 1)
    acc, edges = [f"a_{v}" for v in values], [f"e_{v}" for v in values]
    links = state.filter(only).select("node", "parent", F.col("child.node").alias("ptr"), *[
        (F.col(v) + F.col(f"child.e_{v}")).alias(f"a_{v}") for v in values], *edges)
    inner = links.select(F.col("node").alias("ptr"), F.lit(True).alias("open"))
    below = links.select(F.col("ptr").alias("node"), F.lit(True).alias("_has_chain_above"))
    chain = run.stage(links.join(inner, "ptr", "left").join(below, "node", "left")
                      .select("node", "parent", "ptr", *acc, *edges, F.coalesce("open", F.lit(False)).alias("open"),
                              F.col("_has_chain_above").isNull().alias("head")))
    while not chain.filter("open").isEmpty():
        # pointers of open nodes are all different: each is so many steps down its own chain
        step = chain.select(F.col("node").alias("ptr"), F.col("ptr").alias("_to"), F.col("open").alias("_open"),
                            *[F.col(a).alias(f"_{a}") for a in acc])
        jumped = chain.filter("open").drop("open").join(step, "ptr").select(
            "node", "parent", F.col("_to").alias("ptr"), *[(F.col(a) + F.col(f"_{a}")).alias(a) for a in acc], *edges,
            F.col("_open").alias("open"), "head")
        longer = run.stage(chain.filter(~F.col("open")).unionByName(jumped))
        run.drop(chain)
        chain = longer
    # the chain's head hands its parent, what it has added up and what was already taken
    # out above it to the node below
    tops = chain.filter("head").select(F.col("ptr").alias("node"), F.col("parent").alias("_up"),
                                       *[(F.col(f"a_{v}") + F.col(f"e_{v}")).alias(f"_a_{v}") for v in values])
    rest = state.filter(~only).join(tops, "node", "left").select(
        "node", F.coalesce("_up", "parent").alias("parent"), "kids", *values,
        *[F.coalesce(f"_a_{v}", f"e_{v}").alias(f"e_{v}") for v in values])
    return rest, chain


def subtree_totals(tree: DataFrame, values: list[str]) -> tuple[DataFrame, Scratch]:
    """``tree``: node, parent (null: a root) and long columns ``values``; nodes are
    unique and not null, every parent is a node, no cycles.  Returns ((node, totals of
    ``values`` over the node's subtree, itself included), the staged tables it reads).
    An empty forest gives no rows."""
    run = Scratch(tree.sparkSession, "contraction")
    live = run.stage(tree.select("node", "parent", *[F.col(v).cast("long").alias(v) for v in values],
                                 *[F.lit(0).cast("long").alias(f"e_{v}") for v in values]))
    edges = [f"e_{v}" for v in values]
    raked: list[DataFrame] = []
    chains: list[tuple[DataFrame | None, int]] = []
    while True:
        kids = live.filter(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("node")).agg(
            F.count(F.lit(1)).alias("kids"), F.min(F.struct("node", *edges)).alias("child"))
        state = run.stage(live.join(kids, "node", "left"))
        run.drop(live)
        inner = F.col("parent").isNotNull()
        n = state.agg(F.count_if(inner).alias("inner"), F.count_if(inner & (F.col("kids") == 1)).alias("single")).first()
        if not n["inner"]:
            raked.append(state.select("node", *values))
            chains.append((None, 0))
            break
        if n["single"]:
            rest, chain = _compress(run, state, values)
            rest = run.stage(rest)
            run.drop(state)
        else:
            rest, chain = state, None
        leaf = F.col("parent").isNotNull() & F.col("kids").isNull()
        leaves = rest.filter(leaf)
        given = leaves.groupBy(F.col("parent").alias("node")).agg(
            *[F.sum(F.col(v) + F.col(f"e_{v}")).alias(f"_{v}") for v in values])
        live = run.stage(rest.filter(~leaf).join(given, "node", "left").select(
            "node", "parent", *[_plus(v, F.col(f"_{v}"), v) for v in values], *edges))
        raked.append(leaves.select("node", *values))
        chains.append((chain, n["single"]))
    known = None
    out: list[DataFrame] = []
    for done, (chain, size) in zip(reversed(raked), reversed(chains), strict=True):
        # what a chain of this round ends at was taken out in this round or later
        known = done if known is None else known.unionByName(done)
        out.append(done)
        if chain is None:
            continue
        asked = chain.groupBy("ptr").agg(F.count(F.lit(1)).alias("_w"))
        ends = run.stage(known.select(F.col("node").alias("ptr"), *values).join(asked, "ptr"))
        whole = run.stage(join_hot_split(chain, ends, "ptr", "_w", size).select(
            "node", *[(F.col(v) + F.col(f"a_{v}")).alias(v) for v in values]))
        run.drop(chain, ends)
        known = known.unionByName(whole)
        out.append(whole)
    result = out[0]
    for part in out[1:]:
        result = result.unionByName(part)
    return result, run
