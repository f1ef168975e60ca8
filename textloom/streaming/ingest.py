"""R1 as Structured Streaming: files arriving in a folder are appended to a
Parquet table exactly once per key.

Keys never expire in the reference, so keeping them in streaming state would
grow without bound.  Instead every micro-batch is anti-joined against the
output table itself (``foreachBatch``); the stream's checkpoint makes the
batch boundaries durable, and the anti-join makes a replayed batch a no-op.

The table is laid out by a hash of the key, one directory per bucket, so a batch
reads only the buckets of its own keys (partition pruning; of those files only the key
column), whatever the keys look like.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.incremental import ingest_new
from ..sources.corpus import path_exists

#: Directories of a new table.  A stream keeps the number it began with.
BUCKETS = 256
BUCKET = "_bucket"


def key_bucket(key: str, buckets: int) -> Column:
    """Bucket of a key; null keys share one."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The ingested rows with their bucket.  Empty only if the table does not exist
    yet; a table that exists but cannot be read is an error, or everything would be
    appended again."""
    full = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
    if path_exists(spark, path):
        return spark.read.schema(full).parquet(path)
    return spark.createDataFrame([], full)


def existing_keys(batch: DataFrame, path: str, schema: T.StructType, key: str, buckets: int = BUCKETS) -> DataFrame:
    """Keys of the table's rows in the buckets that ``batch`` touches (at most
    ``buckets`` numbers reach the driver)."""
    touched = [r[0] for r in batch.select(key_bucket(key, buckets)).distinct().collect()]
    return read_table(batch.sparkSession, path, schema).filter(F.col(BUCKET).isin(touched)).select(key)


def ingest_batch(batch: DataFrame, epoch: int, path: str, schema: T.StructType, key: str,
                 buckets: int = BUCKETS) -> None:
    """Append the rows of a batch whose keys are new, one file per bucket touched."""
    new = ingest_new(batch, existing_keys(batch, path, schema, key, buckets), key)
    (new.withColumn("_epoch", F.lit(epoch).cast("long")).withColumn(BUCKET, key_bucket(key, buckets))
     .repartition(BUCKET).write.mode("append").partitionBy(BUCKET).parquet(path))


def start_ingest(spark: SparkSession, src_dir: str, table_path: str, checkpoint: str,
                 schema: T.StructType, key: str, fmt: str = "json",
                 trigger_once: bool = True, buckets: int = BUCKETS):
    """Start the stream; returns the StreamingQuery."""
    stream = spark.readStream.schema(schema).format(fmt).load(src_dir)

    def upsert(batch: DataFrame, epoch: int) -> None:
        ingest_batch(batch, epoch, table_path, schema, key, buckets)

    w = stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w.trigger(processingTime="10 seconds")
    return w.start()
