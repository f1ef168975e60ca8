"""The prefix trie of conversations that share their first turns.

A node is a distinct sequence of first turns.  Its key is the depth and a polynomial
hash modulo 2^127 - 1 over SHA-256 digests of (role, text), so keys of all prefixes of
a conversation, and of its first turns put in front of another one's, follow from
running sums and no text travels beyond its digest.  Conversations are ordered by one
range sort of the turns, which also cuts a conversation with very many turns; what a
range lacks of the conversation it begins within is a count and a hash, of which there
is one per range.  Members are partially aggregated per node, and subtree totals come
from tree contraction.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, join_hot_split
from .contraction import subtree_totals

#: Fixed parameters of the hash: a Mersenne prime and a base below it (from SHA-256 of a constant).
PRIME = (1 << 127) - 1
BASE = int.from_bytes(hashlib.sha256(b"conversation prefixes").digest()[:16], "big") % PRIME
#: Bytes of joined ids per chunk of a node's ends.
CHUNK = 1 << 16


def _key(h: int) -> bytes:
    return h.to_bytes(16, "big")


def _number(b: bytes) -> int:
    return int.from_bytes(b, "big")


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns in order -> place in the conversation and the hash before and after, as
    far as this range knows the conversation."""
    conv, pos, h = None, 0, 0
    for b in batches:
        places, before, after = [], [], []
        for c, digest in zip(b.column("conv").to_pylist(), b.column("digest").to_pylist(), strict=True):
            if c != conv:
                conv, pos, h = c, 0, 0
            places.append(pos)
            before.append(_key(h))
            h = (h * BASE + _number(digest[:16])) % PRIME
            after.append(_key(h))
            pos += 1
        yield pa.RecordBatch.from_arrays(
            [b.column("conv"), b.column("range"), pa.array(places, pa.int64()), pa.array(before, pa.binary()),
             pa.array(after, pa.binary()), b.column("n_bytes")], ["conv", "range", "pos", "before", "after", "n_bytes"])


def _shifted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Put what earlier ranges hold of a conversation (``_n`` turns, hash ``_h``) in front."""
    for b in batches:
        places, before, after = [], [], []
        for p, x, y, n, h in zip(*[b.column(c).to_pylist() for c in ("pos", "before", "after", "_n", "_h")], strict=True):
            if n:
                power = _number(h) * pow(BASE, p, PRIME)
                x, y = _key((_number(x) + power) % PRIME), _key((_number(y) + power * BASE) % PRIME)
            places.append(p + (n or 0))
            before.append(x)
            after.append(y)
        yield pa.RecordBatch.from_arrays(
            [b.column("conv"), pa.array(places, pa.int64()), pa.array(before, pa.binary()), pa.array(after, pa.binary()),
             b.column("n_bytes")], ["conv", "pos", "before", "after", "n_bytes"])


def turn_prefixes(turns: DataFrame, run: Scratch) -> DataFrame:
    """``turns``: conv (not null), turn, digest, n_bytes.  Returns (conv, ``pos`` from 0
    by turn, nulls first, then digest; ``before``, ``after``: hash of the turns before it
    and up to it; n_bytes)."""
    order = ["conv", "turn", "digest"]
    types = [T.StructField("conv", turns.schema["conv"].dataType), T.StructField("range", T.IntegerType()),
             T.StructField("pos", T.LongType()), T.StructField("before", T.BinaryType()),
             T.StructField("after", T.BinaryType()), T.StructField("n_bytes", T.LongType())]
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    local = run.stage(turns.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                      .withColumn("range", F.spark_partition_id())
                      .mapInArrow(_prefixes, T.StructType(types)))
    # conversations that go on from one range to the next: fewer than ranges
    ends = local.groupBy("range").agg(F.min("conv").alias("lo"), F.max("conv").alias("hi")).orderBy("range").collect()
    cut = sorted({b["lo"] for a, b in zip(ends, ends[1:], strict=False) if a["hi"] == b["lo"]})
    spark = turns.sparkSession
    carried = []
    if cut:
        wanted = spark.createDataFrame([(c,) for c in cut], T.StructType(types[:1]))
        pieces = local.join(F.broadcast(wanted), "conv").groupBy("conv", "range").agg(
            F.max(F.struct("pos", "after")).alias("end")).collect()
        conv, n, h = None, 0, 0
        for r in sorted(pieces, key=lambda r: (r["conv"], r["range"])):
            if r["conv"] != conv:
                conv, n, h = r["conv"], 0, 0
            carried.append((r["conv"], r["range"], n, _key(h)))
            n, h = n + r["end"]["pos"] + 1, (h * pow(BASE, r["end"]["pos"] + 1, PRIME) + _number(r["end"]["after"])) % PRIME
    carry = spark.createDataFrame(carried, T.StructType([*types[:2], T.StructField("_n", T.LongType()),
                                                         T.StructField("_h", T.BinaryType())]))
    return local.join(F.broadcast(carry), ["conv", "range"], "left").mapInArrow(
        _shifted, T.StructType([f for f in types if f.name != "range"]))


def _grafted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Own turns behind another conversation's first ``_m``: node keys."""
    for b in batches:
        node, parent, depth = [], [], []
        for p, x, y, m, front, skip, kept in zip(*[b.column(c).to_pylist() for c in (
                "pos", "before", "after", "_m", "_front", "_skip", "_kept")], strict=True):
            if front != skip:
                power = (_number(front) - _number(skip)) * pow(BASE, p - kept, PRIME)
                x, y = _key((_number(x) + power) % PRIME), _key((_number(y) + power * BASE) % PRIME)
            d = m + p - kept + 1
            depth.append(d)
            node.append(node_key(d, y))
            parent.append(node_key(d - 1, x))
        yield pa.RecordBatch.from_arrays(
            [pa.array(node, pa.binary()), pa.array(parent, pa.binary()), pa.array(depth, pa.int64()), b.column("conv"),
             b.column("n_bytes"), b.column("ends")], ["node", "parent", "depth", "conv_id", "n_bytes", "ends"])


def node_key(depth: int, h: bytes) -> bytes:
    return depth.to_bytes(8, "big") + h


ROOT = node_key(0, _key(0))


def _native_key(depth: Column, h: Column) -> Column:
    return F.concat(F.unhex(F.lpad(F.hex(depth), 16, "0")), h)


def members(turns: DataFrame, run: Scratch, share: int, most: int) -> tuple[DataFrame, DataFrame]:
    """(rows (node, parent, depth, conv_id, n_bytes, ``ends``: the rebuilt conversation
    ends here), one row per conversation: conv_id, ``ends`` if it has no turn)."""
    # read twice, by the first turns and by all
    turns = run.stage(turn_prefixes(turns, run))
    size = turns.groupBy("conv").agg(F.max("pos").alias("_last"))
    first = turns.filter(F.col("pos") < most).groupBy("conv").agg(
        F.array_sort(F.collect_list(F.struct("pos", "before", "after", "n_bytes"))).alias("first"))
    front = first.select(F.col("conv").alias("_base"), F.col("first").alias("_shared"))
    c = F.col("conv")
    convs = (first.join(size, "conv")
             .withColumn("_h", (F.crc32(c.cast("string").cast("binary")) % most).cast("int"))
             .withColumn("_base", c - c % share)
             .join(front, "_base", "left")
             .withColumn("_shared", F.slice(F.coalesce("_shared", F.lit([]).cast(first.schema["first"].dataType)), 1, F.col("_h")))
             .withColumn("_m", F.size("_shared").cast("long")))
    empty = F.lit(_key(0))
    last_of = lambda a: F.when(F.size(a) > 0, F.element_at(a, -1)["after"]).otherwise(empty)
    convs = run.stage(convs.select(
        "conv", (F.col("_last") + 1).alias("_w"), "_m", F.col("_h").cast("long").alias("_kept"), "_shared",
        last_of(F.col("_shared")).alias("_front"), last_of(F.slice("first", 1, F.col("_h"))).alias("_skip")))
    total = convs.agg(F.sum("_w")).first()[0] or 0
    own = join_hot_split(turns, convs.drop("_shared"), "conv", "_w", total).filter(F.col("pos") >= F.col("_kept"))
    kind = "node binary, parent binary, depth long, conv_id long, n_bytes long, ends boolean"
    own = own.withColumn("ends", F.col("pos") == F.col("_w") - 1).mapInArrow(_grafted, kind)
    no_own = F.col("_w") <= F.col("_kept")
    shared = convs.select("conv", "_m", no_own.alias("_no_own"), F.explode("_shared").alias("t")).select(
        _native_key(F.col("t.pos") + 1, F.col("t.after")).alias("node"), _native_key(F.col("t.pos"), F.col("t.before")).alias("parent"),
        (F.col("t.pos") + 1).alias("depth"), F.col("conv").alias("conv_id"), F.col("t.n_bytes").alias("n_bytes"),
        (F.col("_no_own") & (F.col("t.pos") == F.col("_m") - 1)).alias("ends"))
    return own.unionByName(shared), convs.select(F.col("conv").alias("conv_id"), (no_own & (F.col("_m") == 0)).alias("ends"))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids in order of (node, conv_id) -> pieces of each node's list."""
    def emit():
        return pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([ids[0]], pa.int64()),
                                           pa.array([",".join(map(str, ids))], pa.string())], ["node", "first", "ids"])
    node, ids, held = None, [], 0
    for b in batches:
        for k, i in zip(b.column("node").to_pylist(), b.column("conv_id").to_pylist(), strict=True):
            if k != node or held >= CHUNK:
                if ids:
                    yield emit()
                node, ids, held = k, [], 0
            ids.append(i)
            held += 12
    if ids:
        yield emit()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order -> digest of each node's list, read as a stream."""
    def emit(done):
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], pa.binary()), pa.array([h for _, h in done])],
                                          ["node", "ends_sha256"])
    node, h = None, None
    for b in batches:
        done = []
        for k, piece in zip(b.column("node").to_pylist(), b.column("ids").to_pylist(), strict=True):
            if k != node:
                if h is not None:
                    done.append((node, h.hexdigest()))
                node, h = k, hashlib.sha256(piece.encode())
            else:
                h.update(b"," + piece.encode())
        if done:
            yield emit(done)
    if h is not None:
        yield emit([(node, h.hexdigest())])


def end_digests(ends: DataFrame) -> DataFrame:
    """(node, ``ends_sha256``): SHA-256 of the node's conv_ids, ascending, joined by
    commas.  A node with very many is cut by the range sort and hashed as a stream of
    long pieces, in constant memory."""
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = ends.repartitionByRange(parts, "node", "conv_id").sortWithinPartitions("node", "conv_id").mapInArrow(
        _chunks, "node binary, first long, ids string")
    return pieces.repartition("node").sortWithinPartitions("node", "first").mapInArrow(
        _digests, "node binary, ends_sha256 string")


def conversation_trie(df: DataFrame, share: int = 5, most: int = 9, conv_col: str = "conv_id", turn_col: str = "turn",
                      role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per node: ``node`` (key), ``parent`` (key; null: the root), ``conv_id``
    (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    Conversation c is rebuilt first: the first h turns of conversation c - c % share,
    then its own turns behind its first h; h = crc32(c as text) % most.  Turns go by
    ``turn`` (nulls first); equal turn numbers by a digest of role and text; repeated
    rows are turns each.  Null roles and texts are empty.  Rows with a null
    conversation id belong to no conversation and are left out.  A conversation
    without a turn left is a member of the root only.  An empty table has no
    members and gives no rows.  Other columns are not read.
    """
    run = Scratch(df.sparkSession, "trie")
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    turns = df.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.octet_length(text).cast("long").alias("n_bytes"))
    rows, convs = members(turns, run, share, most)
    rows = run.stage(rows.unionByName(convs.select(
        F.lit(ROOT).alias("node"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("depth"),
        "conv_id", F.lit(0).cast("long").alias("n_bytes"), "ends")))
    nodes = run.stage(rows.groupBy("node").agg(
        F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"), F.min("n_bytes").alias("n_bytes"), F.count_if("ends").alias("n_ends")))
    n = nodes.count()
    kids = nodes.filter(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("node")).agg(
        F.count(F.lit(1)).alias("n_children"))
    nodes = run.stage(nodes.join(kids, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long")))
    totals, staged = subtree_totals(nodes.select(
        "node", "parent", (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved_tokens")), ["n_leaves", "saved_tokens"])
    digests = end_digests(rows.filter("ends").select("node", "conv_id"))
    out = run.stage(nodes.join(totals, "node").join(digests, "node", "left").select(
        "node", "parent", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")))
    staged.drop_all_but()
    run.drop_all_but(out)
    # a parent's conv_id for all its children: a parent with very many is split off
    above = out.filter(F.col("n_children") > 0).select(
        F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("_w"))
    named = join_hot_split(out, above, "parent", "_w", n).drop("_w")
    top = out.filter(F.col("parent").isNull()).withColumn("parent_conv_id", F.lit(None).cast("long"))
    return named.unionByName(top)
