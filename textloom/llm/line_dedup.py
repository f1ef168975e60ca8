"""Line dedup: explode normalised lines, hash, count distinct documents per hash,
drop lines over the threshold, reassemble by position.

Only 16-byte hashes of long enough lines are shuffled for counting.  The text is
shuffled once, by document, to drop its lines.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WS, ascii_lower, join_hot_split, slices, stage, text_or_empty


def line_key(line: Column) -> Column:
    """The line without white space at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(WS)))


def _rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        texts = b.column("_text").to_pylist()
        kept, n, gone = [], [], []
        for text, drops in zip(texts, b.column("_drop").to_pylist(), strict=True):
            lines = text.split("\n")
            drop = set(drops or ())
            n.append(len(lines))
            gone.append(len(drop))
            kept.append("\n".join(x for i, x in enumerate(lines) if i not in drop) if drop else text)
        yield pa.RecordBatch.from_arrays(
            [b.column("_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
             pa.array(kept, pa.string())], ["_id", "n_lines", "n_dropped", "kept_text"])


def line_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """One row per input row: id, ``n_lines``, ``n_dropped``, ``kept_text``.

    Keys of at least ``min_chars`` code points found in at least ``min_docs``
    distinct documents lose all their lines except in the largest id that holds
    them (there, every occurrence stays).  Null or empty text is one empty line.
    A null id counts as one document and is smaller than any other; repeated
    rows are one document, and each of them loses the same lines.  An empty
    table gives an empty result; other columns are not read.
    """
    src = df.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text"))
    src = src.withColumn("_rk", F.xxhash64("_text"))
    lines = (src.select("_id", "_rk", F.posexplode(F.split("_text", "\n", -1)).alias("_pos", "_line"))
             .withColumn("_key", line_key(F.col("_line")))
             .filter(F.length("_key") >= min_chars)
             .select("_id", "_rk", "_pos", F.unhex(F.md5("_key")).alias("_h")))
    lines = stage(lines, "lines")
    per_doc = lines.groupBy("_h", "_id").agg(F.count(F.lit(1)).alias("_n"))
    often = (per_doc.groupBy("_h")
             .agg(F.count(F.lit(1)).alias("_docs"), F.max("_id").alias("_last"), F.sum("_n").alias("_n"))
             .filter(F.col("_docs") >= min_docs).select("_h", "_last", "_n"))
    often = stage(often, "frequent-lines")
    drops = (join_hot_split(lines, often, "_h", "_n", lines.count())
             .filter(~F.col("_id").eqNullSafe(F.col("_last")))
             .groupBy("_id", "_rk").agg(F.collect_set("_pos").alias("_drop"))  # at most its lines
             .select(F.col("_id").alias("_did"), F.col("_rk").alias("_drk"), "_drop"))
    joined = src.join(drops, src["_id"].eqNullSafe(drops["_did"]) & (src["_rk"] == drops["_drk"]), "left")
    schema = T.StructType([T.StructField("_id", df.schema[id_col].dataType),
                           T.StructField("n_lines", T.LongType()),
                           T.StructField("n_dropped", T.LongType()),
                           T.StructField("kept_text", T.StringType())])
    return (joined.select("_id", "_text", "_drop").mapInArrow(_rebuild, schema)
            .withColumnRenamed("_id", id_col))

