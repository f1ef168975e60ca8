"""Helpers shared by the operators: staged tables, text normalisation and the
heavy-key split join."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: The white space class [\x20\x09-\x0D] of all operators here.
WS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts the
    lineage reliably (a lost executor loses nothing) and stores it compressed."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Staged tables of one run.  ``drop`` deletes those that nothing reads any
    more; what a run returns must not be dropped."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self.paths = spark, name, []

    def stage(self, df: DataFrame) -> DataFrame:
        path = scratch(self.spark, self.name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths.append((out, path))
        return out

    def drop(self, *tables: DataFrame) -> None:
        gone = [p for t, p in self.paths if any(t is x for x in tables)]
        self._delete(gone)
        self.paths = [(t, p) for t, p in self.paths if p not in gone]

    def drop_all_but(self, *tables: DataFrame) -> None:
        self.drop(*[t for t, _ in self.paths if not any(t is x for x in tables)])

    def _delete(self, paths: list[str]) -> None:
        sc = self.spark.sparkContext
        for p in paths:
            at = sc._jvm.org.apache.hadoop.fs.Path(p)
            at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


def text_or_empty(text_col: str) -> Column:
    return F.coalesce(F.col(text_col), F.lit(""))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def same_row(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    """Equi-join condition in which null equals null."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & a[k].eqNullSafe(b[k])
    return cond


def join_hot_split(rows: DataFrame, table: DataFrame, key: str | list[str], weight: str,
                   total: int, parts: int | None = None) -> DataFrame:
    """Inner join of ``rows`` with ``table`` (one row per key, ``weight`` = rows
    of that key) where a key may hold a large share of all rows.

    Keys with over ``total / parts`` rows are fewer than ``parts`` (by default four times
    the shuffle partitions, 1,000 at least), so their table rows are broadcast (bounded by
    construction) and their rows are not shuffled; all other keys, each at most a quarter
    of a partition's share, take an ordinary shuffle join.  Both inputs should be staged,
    because each is read twice.
    """
    if parts is None:
        parts = max(1000, 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    limit, key = total / parts, [key] if isinstance(key, str) else key
    hot = table.filter(F.col(weight) > limit)
    cold = table.filter(F.col(weight) <= limit)
    return (rows.join(F.broadcast(hot), key)
            .unionByName(rows.join(F.broadcast(hot.select(*key)), key, "left_anti").join(cold, key)))


def slices(batches: Iterator, rows: int = 256) -> Iterator:
    """Cut Arrow batches into small ones, so that what a task builds from one
    stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
