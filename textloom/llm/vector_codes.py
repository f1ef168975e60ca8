"""Product codes of vectors: integer k-means per part, with norm-of-sum bounds.

A vector is scaled to integers and cut into equal parts.  Each part position has a
codebook; rounds assign every part to its nearest entry (ties to the lower index)
and move the entries to the floored means of their parts.  All distances are
integers, so the result does not depend on how rows are partitioned.

Most of an assignment is saved by lower bounds.  For every part, and every group
of entries, a row keeps a lower bound on the distance to the group's entries (its
own entry left out) and the round in which it was measured.  All codebooks of all
rounds are kept, so a bound of round T is lowered by the largest *net* displacement
|c_t - c_T| of the group's entries, the norm of the sum of their moves; adding up the
moves of each round would lower it by more.  Where a lowered bound does not exceed
the exact distance to the own entry, that group is scanned again, exactly.

Each round is one pass over the staged rows (vector, assignment, bounds, stamps)
that writes the next ones, and one that adds up the parts per entry; only the
codebooks, of a size fixed by the parameters and the dimension, reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, join_hot_split, slices

#: Rows that a task handles at a time.
ROWS = 4096
#: Up to this, a sum of products is exact in a double, and in a long.
DOUBLE, LONG = 1 << 53, 1 << 62


@dataclass(frozen=True)
class Config:
    parts: int = 4
    entries: int = 256      #: per part position; at most 256
    rounds: int = 4         #: of assignment and update, before the last assignment
    scale: int = 1024       #: a component x becomes floor(scale * x)
    group: int = 16         #: entries that share a bound


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances (rows of x, rows of c) of integer matrices."""
    if not x.size or not c.size:
        return np.zeros((len(x), len(c)), dtype=np.int64)
    top = max(int(np.abs(x).max()), int(np.abs(c).max()))
    if 4 * top * top * x.shape[1] < DOUBLE:
        x, c = x.astype(np.float64), c.astype(np.float64)
    return ((x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)).astype(np.int64)


def own_squared(x: np.ndarray, entry: np.ndarray) -> np.ndarray:
    diff = x - entry
    return (diff * diff).sum(axis=1)


def lower_root(d2: np.ndarray) -> np.ndarray:
    """A float that is not above the root; infinite where there is no entry."""
    return np.where(d2 == np.iinfo(np.int64).max, np.inf, np.sqrt(d2.astype(np.float64)) * (1 - 1e-6)).astype(np.float32)


def displacement(now: np.ndarray, then: np.ndarray, group: int) -> np.ndarray:
    """Per group of entries an upper bound on the largest |now - then|."""
    moved = np.sqrt(((now - then).astype(np.float64) ** 2).sum(axis=1)) * (1 + 1e-9)
    return np.maximum.reduceat(moved, np.arange(0, len(moved), group))


def _scan(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row: least squared distance, its lowest index, and the least of the others."""
    d2 = squared(x, c)
    at = d2.argmin(axis=1)
    row = np.arange(len(x))
    least = d2[row, at]
    d2[row, at] = np.iinfo(np.int64).max
    return least, at, d2.min(axis=1)


def assign(x: np.ndarray, history: list[np.ndarray], group: int, own: np.ndarray, bound: np.ndarray,
           stamp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One part of some rows under the newest codebook of ``history``.

    ``own`` (entry of each row), ``bound`` and ``stamp`` (rows x groups; a negative
    stamp: never measured) are changed in place.  Returns (squared distance to the
    entry, distances measured per row)."""
    t, c = len(history) - 1, history[-1]
    row = np.arange(len(x))
    first = stamp[:, 0] < 0
    best, at = own_squared(x, c[own]), own.copy()
    at[first] = len(c)                                  # any entry at the same distance wins
    best[first] = np.iinfo(np.int64).max
    held = lower_root(best).astype(np.float64) * (1 + 3e-6)  # not below the distance to the own entry
    # net displacement of each group since each earlier round
    net = np.stack([displacement(c, then, group) for then in history])
    scans = (~first).astype(np.int64)
    groups = bound.shape[1]
    found: list[tuple] = []
    kept = best.copy()
    for g in range(groups):
        low = bound[:, g] - net[np.maximum(stamp[:, g], 0), g]
        r = np.flatnonzero((stamp[:, g] < 0) | ~(low > held))
        if not len(r):
            found.append((r,) * 4)
            continue
        lo = g * group
        least, index, second = _scan(x[r], c[lo:lo + group])
        index += lo
        better = (least < best[r]) | (least == best[r]) & (index < at[r])
        best[r[better]], at[r[better]] = least[better], index[better]
        found.append((r, least, index, second))
        scans[r] += len(c[lo:lo + group])
    for g, (r, least, index, second) in enumerate(found):
        seen = np.zeros(len(x), dtype=bool)
        seen[r] = True
        # not scanned, and the group's own entry has become one of the others
        left = row[~seen & (at != own) & (own // group == g)]
        low = bound[left, g] - net[np.maximum(stamp[left, g], 0), g]
        bound[left, g] = np.minimum(low * (1 - 1e-6), lower_root(kept[left]))
        stamp[left, g] = t
        if len(r):
            bound[r, g] = lower_root(np.where(index == at[r], second, least))
            stamp[r, g] = t
    own[:] = at
    return best, scans


def _rows_of(column: pa.Array, dtype: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=dtype).reshape(len(column), width).copy()


def _binary(values: np.ndarray) -> pa.Array:
    return pa.array([v.tobytes() for v in values], pa.binary())


def _quantise(scale: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, ROWS):
            q = []
            for v in b.column("_v").to_pylist():
                x = np.floor(np.array(v, dtype=np.float64) * scale)
                if 4 * float(np.abs(x).max()) ** 2 * len(x) >= LONG:
                    raise ValueError("a component is too large for squared distances in a long")
                q.append(x.astype("<i4").tobytes())
            n = pa.array([len(x) // 4 for x in q], pa.int32())
            yield pa.RecordBatch.from_arrays([b.column("_id"), b.column("_label"), pa.array(q, pa.binary()), n],
                                             ["_id", "_label", "_q", "_n"])
    return run


def _step(history, cfg: Config, dim: int, groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, width = history.value, dim // cfg.parts
        for b in slices(batches, ROWS):
            if not b.num_rows:
                continue
            x = _rows_of(b.column("_q"), "<i4", dim).astype(np.int64)
            own = _rows_of(b.column("_a"), "u1", cfg.parts).astype(np.int64)
            bound = _rows_of(b.column("_bound"), "<f4", cfg.parts * groups)
            stamp = _rows_of(b.column("_stamp"), "i1", cfg.parts * groups).astype(np.int64)
            error, scans = np.zeros(len(x), dtype=np.int64), b.column("_scans").to_numpy().copy()
            for p in range(cfg.parts):
                at = slice(p * groups, (p + 1) * groups)
                o, lo, st = own[:, p].copy(), bound[:, at].copy(), stamp[:, at].copy()
                d2, n = assign(x[:, p * width:(p + 1) * width], [h[p] for h in books], cfg.group, o, lo, st)
                own[:, p], bound[:, at], stamp[:, at] = o, lo, st
                error += d2
                scans += n
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), b.column("_label"), b.column("_q"), b.column("_n"), _binary(own.astype("u1")),
                 _binary(bound.astype("<f4")), _binary(stamp.astype("i1")), pa.array(error), pa.array(scans)],
                ["_id", "_label", "_q", "_n", "_a", "_bound", "_stamp", "_error", "_scans"])
    return run


def _sums(cfg: Config, dim: int, entries: int):
    """Partial sums of a task: (cell, value), a cell being (part, entry, position);
    position ``width`` counts the parts."""
    width = dim // cfg.parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((cfg.parts, entries, width + 1), dtype=np.int64)
        for b in slices(batches, ROWS):
            if not b.num_rows:
                continue
            x = _rows_of(b.column("_q"), "<i4", dim).astype(np.int64)
            own = _rows_of(b.column("_a"), "u1", cfg.parts).astype(np.int64)
            for p in range(cfg.parts):
                order = np.argsort(own[:, p], kind="stable")
                entry = own[order, p]
                head = np.flatnonzero(np.r_[True, entry[1:] != entry[:-1]])
                part = x[order, p * width:(p + 1) * width]
                total[p, entry[head], :width] += np.add.reduceat(part, head, axis=0)
                total[p, entry[head], width] += np.diff(np.r_[head, len(entry)])
        cell = np.flatnonzero(total.reshape(-1))
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(total.reshape(-1)[cell])], ["cell", "s"])
    return run


def finite(vector: Column) -> Column:
    """The vector is there, is not empty and has finite components only."""
    x = F.coalesce(vector.cast("array<double>"), F.array().cast("array<double>"))
    return (F.size(x) > 0) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))


def vector_codes(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 cfg: Config = Config()) -> tuple[DataFrame, list[np.ndarray]]:
    """(rows, codebooks): one row (id, ``label``, ``code`` binary: an index per part,
    ``error``: squared distances summed over the parts, ``label_error``: errors summed
    over equal labels, ``scans``: distances measured), and per part the final entries.

    Rows whose vector is null, empty or holds a null or non-finite component are
    dropped.  Codebooks start as the parts of the smallest ids (null ids last, equal
    ids by vector); with fewer rows than entries they are as short.  Unused entries
    stay.  Repeated rows are coded each.  Null labels are one label.  An empty table
    gives no rows and no codebooks.  ValueError if vectors differ in length, can't be
    cut into equal parts, or are too large for exact distances in a long.  Other
    columns are not read.
    """
    spark = df.sparkSession
    run = Scratch(spark, "codes")
    types = [T.StructField("_id", df.schema[id_col].dataType), T.StructField("_label", df.schema[label_col].dataType),
             T.StructField("_q", T.BinaryType()), T.StructField("_n", T.IntegerType())]
    rows = run.stage(df.filter(finite(F.col(vector_col)))
                     .select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label"),
                             F.col(vector_col).cast("array<double>").alias("_v"))
                     .mapInArrow(_quantise(cfg.scale, cfg.parts), T.StructType(types)))
    seen = rows.agg(F.min("_n").alias("lo"), F.max("_n").alias("hi"), F.count(F.lit(1)).alias("n")).first()
    dim = seen["lo"] or cfg.parts
    if seen["n"] and (seen["lo"] != seen["hi"] or dim % cfg.parts):
        raise ValueError(f"vectors of {seen['lo']} to {seen['hi']} components in {cfg.parts} equal parts")
    start = rows.orderBy(F.col("_id").asc_nulls_last(), "_q").limit(cfg.entries).select("_q").collect()
    books = np.array([np.frombuffer(r["_q"], "<i4") for r in start], dtype=np.int64).reshape(
        len(start), cfg.parts, dim // cfg.parts)
    history = [books.transpose(1, 0, 2).copy()]  # part, entry, component
    entries = max(1, len(start))
    groups = -(-entries // cfg.group)
    blank = {"_a": bytes(cfg.parts), "_bound": np.zeros(cfg.parts * groups, "<f4").tobytes(),
             "_stamp": np.full(cfg.parts * groups, -1, "i1").tobytes()}
    state = rows.select("*", *[F.lit(v).alias(k) for k, v in blank.items()], F.lit(0).cast("long").alias("_error"),
                        F.lit(0).cast("long").alias("_scans"))
    for t in range(cfg.rounds + 1):
        shared = spark.sparkContext.broadcast(history)
        moved = run.stage(state.mapInArrow(_step(shared, cfg, dim, groups), state.schema))
        run.drop(state if t else rows)
        state = moved
        if t < cfg.rounds:
            total = np.zeros(cfg.parts * entries * (dim // cfg.parts + 1), dtype=np.int64)
            for r in state.select("_q", "_a").mapInArrow(_sums(cfg, dim, entries), "cell long, s long").groupBy(
                    "cell").agg(F.sum("s").alias("s")).collect():
                total[r["cell"]] = r["s"]
            total = total.reshape(cfg.parts, entries, -1)
            history.append(history[-1].copy())
            if seen["n"]:
                n = total[:, :, -1:]
                history[-1] = np.where(n > 0, total[:, :, :-1] // np.maximum(n, 1), history[-1])
    # a struct as key: a null label equals a null label
    coded = state.select("_id", F.struct("_label").alias("_key"), F.col("_a").alias("code"), F.col("_error").alias("error"),
                         F.col("_scans").alias("scans"))
    per_label = run.stage(coded.groupBy("_key").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("_w")))
    out = join_hot_split(coded, per_label, "_key", "_w", seen["n"])
    return out.select(F.col("_id").alias(id_col), F.col("_key._label").alias("label"), "code", "error", "label_error",
                      "scans"), list(history[-1])
