"""A corpus pipeline over the ``documents`` table.

``STAGES`` lists (name, function) in order; each function takes
(spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
reread as the next one's ``docs``.  All but the last return the columns of
``documents``:

1. quality rules: documents that the rules reject go;
2. exact dedup: one document of each group of equal texts stays;
3. SimHash near-dedup: the document of the smallest id of each component stays (null
   ids last, equal ids by text hash);
4. suffix-array dedup: bytes of passages of ``PASSAGE`` bytes or more that occur twice
   are cut out of the texts (``n_chars`` follows; a document may end up empty).
   Passages of more than 50 words are to go, and 51 words of four letters with their
   spaces are 255 bytes;
5. packing: every remaining document in sequences of 1,024 tokens.

Null texts are rejected by the first stage.  Columns beyond ``doc_id`` and
``text`` are carried along untouched, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import exact_dedup, packing, quality, simhash, suffix_dedup
from textloom.llm.common import stage
from textloom.session import ship_package

#: SQL can't express the SimHash and suffix stages; tests hold ``run`` against
#: a brute-force version.
ORACLE_SQL = None

#: Bytes of a repeated passage that the suffix stage removes.
PASSAGE = 256


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return quality.quality_keep(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return exact_dedup.exact_distinct(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return simhash.simhash_distinct(docs, words_per_shingle=4, radius=4)


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    out = suffix_dedup.suffix_cut(docs, length=PASSAGE)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)
                          ).select(*docs.columns) if "n_chars" in docs.columns else out


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    import public_tokenizers
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json")).select(
        "doc_id", "start", "length", F.col("crc").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_stage),
    ("exact_dedup", exact_stage),
    ("simhash_near_dedup", simhash_stage),
    ("suffix_array_dedup", suffix_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table, each staged as Parquet in
    the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
