"""Tables staged in the shared checkpoint folder, and a join that splits hot keys."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir


class Staging:
    """Tables of one run, written as Parquet below ``spark.checkpoint.dir``: lineage is
    cut reliably, and ``drop`` deletes what nothing reads any more."""

    def __init__(self, spark, name: str):
        self.spark, self.name = spark, name
        self.paths: list[tuple[DataFrame, str]] = []

    def write(self, df: DataFrame) -> DataFrame:
        path = f"{checkpoint_dir(self.spark)}/{self.name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths.append((out, path))
        return out

    def drop(self, *tables: DataFrame) -> None:
        sc = self.spark.sparkContext
        for table, path in [x for x in self.paths if any(x[0] is t for t in tables)]:
            at = sc._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)
        self.paths = [x for x in self.paths if not any(x[0] is t for t in tables)]


def join_split(rows: DataFrame, table: DataFrame, keys: list[str], weight: str) -> DataFrame:
    """Inner join with a staged table of one row per key, ``weight`` of which says how many
    ``rows`` have that key.  Keys that hold more than half a shuffle partition's share of
    all those rows are fewer than twice the partitions; they are broadcast and their rows
    stay where they are, all others take an ordinary join."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = table.agg(F.sum(weight)).first()[0] or 0
    limit = total / (2 * parts)
    hot = F.broadcast(table.filter(F.col(weight) > limit))
    cold = table.filter(F.col(weight) <= limit)
    return (rows.join(hot, keys)
            .unionByName(rows.join(hot.select(*keys), keys, "left_anti").join(cold, keys)))
