"""Corpus sources: the source registry (a small dimension table) and the
column-pruned text scan that turns ordered files into an explicit
``(source, source_rank, pos, text)`` relation."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REGISTRY_SCHEMA = T.StructType([
    T.StructField("source", T.StringType(), False),
    T.StructField("source_rank", T.IntegerType(), False),
    T.StructField("weight", T.IntegerType(), False),
    T.StructField("para_dedup", T.BooleanType(), False),
])

def registry(spark: SparkSession, sources: Sequence[str], weights: dict | None = None,
             para_sources: Sequence[str] = ()) -> DataFrame:
    """Ordered source registry: rank = position in ``sources``; weight default 1."""
    weights = weights or {}
    para = set(para_sources)
    rows = [(s, i, int(weights.get(s, 1)), s in para) for i, s in enumerate(sources)]
    return spark.createDataFrame(rows, REGISTRY_SCHEMA)


def fixture_registry(spark: SparkSession, n: int = 20, para: int = 10, heavy: int = 5,
                     heavy_weight: int = 3) -> DataFrame:
    """Registry used on the driver's ``documents`` table: src0..src{n-1} ranked by
    number, paragraph dedup on src0..src{para-1}, weight 3 on src0..src{heavy-1}."""
    names = [f"src{i}" for i in range(n)]
    return registry(spark, names, {f"src{i}": heavy_weight for i in range(heavy)},
                    [f"src{i}" for i in range(para)])


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jpath)


def read_corpus(spark: SparkSession, paths: Sequence[str], text_col: str = "text",
                order_col: str | None = None, missing: str = "warn") -> DataFrame:
    """Union of Parquet sources in registry order, reading only the text column.

    ``source`` is the file/dir stem, ``source_rank`` its position in ``paths``,
    ``pos`` the row order inside the source: ``order_col`` when the data has one
    (a long), else the struct (file path, row index in the file) from Spark's
    hidden file metadata, which is stable across re-execution and ordered like the
    files.  One registry has either kind throughout.
    Missing paths are skipped (no report row), as the reference does.
    """
    parts = []
    for rank, p in enumerate(paths):
        if not path_exists(spark, p):
            if missing == "error":
                raise FileNotFoundError(p)
            continue
        stem = os.path.splitext(os.path.basename(p.rstrip("/")))[0]
        df = spark.read.parquet(p)
        if order_col:
            pos = F.col(order_col).cast("long")
        else:
            pos = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
        parts.append(df.select(F.lit(stem).alias("source"), F.lit(rank).alias("source_rank"),
                               pos.alias("pos"), F.coalesce(F.col(text_col), F.lit("")).alias("text")))
    if not parts:
        pos = "long" if order_col else "struct<file: string, row: bigint>"
        return spark.createDataFrame([], f"source string, source_rank int, pos {pos}, text string")
    out = parts[0]
    for d in parts[1:]:
        out = out.unionByName(d)
    return out


#: Session setting: number of partitions that ``spread`` deals a table into.
SPREAD = "spark.textloom.scanPartitions"


def spread(df: DataFrame) -> DataFrame:
    """Round-robin over ``spark.textloom.scanPartitions`` partitions if the session
    sets it, else the frame as it is.  Meant for tables stored as fewer files than
    there are task slots (a whole small table in one row group); elsewhere the
    scan splits files by ``spark.sql.files.maxPartitionBytes``."""
    n = df.sparkSession.conf.get(SPREAD, None)
    return df.repartition(int(n)) if n else df


def documents_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver's ``documents`` table as a corpus: order = doc_id.  Rows of sources that
    the registry lists; the registry is a short list, so the texts stay where they are."""
    reg = fixture_registry(spark).select("source", "source_rank")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = spread(docs).select("source", F.col("doc_id").cast("long").alias("pos"),
                       F.coalesce("text", F.lit("")).alias("text"))
    return docs.join(F.broadcast(reg), "source")
