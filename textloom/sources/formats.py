"""File sources and sinks: lenient/strict JSON lines, CSV with BOM and
multi-line quoted fields, the nested wiki API response, Parquet/JSONL/CSV
writers and the report/log sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import format_size, ustrip, wiki_url

ARTICLE_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("title", T.StringType()),
    T.StructField("text", T.StringType()), T.StructField("url", T.StringType())])

WIKI_API_SCHEMA = T.StructType([T.StructField("query", T.StructType([
    T.StructField("pages", T.ArrayType(T.StructType([
        T.StructField("pageid", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("revisions", T.ArrayType(T.StructType([
            T.StructField("slots", T.StructType([
                T.StructField("main", T.StructType([T.StructField("content", T.StringType())]))]))])))]))),
    T.StructField("allpages", T.ArrayType(T.StructType([T.StructField("pageid", T.LongType())])))])),
    T.StructField("continue", T.StructType([T.StructField("apcontinue", T.StringType())]))])

POEM_META_SCHEMA = "title string, url string, author string"
POEM_CONTENT_SCHEMA = "title string, content string, source string, url string, author string"

# Fixed value: the words pandas reads as missing by default.
NA_WORDS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
            "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

CORRUPT = "_corrupt_record"


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType, lenient: bool = True,
               required: tuple = ()) -> DataFrame:
    """JSON lines.  Blank lines are ignored by the reader.  Lenient:
    malformed lines become ``_corrupt_record`` rows (kept for counting, see
    ``ingest_counts``), filter them with ``valid_rows``.  Strict: FAILFAST and
    a missing required key raises."""
    if lenient:
        s = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
        return (spark.read.schema(s).option("mode", "PERMISSIVE")
                .option("columnNameOfCorruptRecord", CORRUPT).json(path))
    df = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    for k in required:
        df = df.withColumn(k, F.coalesce(F.col(k), F.raise_error(F.lit(f"missing key: {k}")).cast(
            schema[k].dataType)))
    return df


def valid_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def ingest_counts(df: DataFrame) -> DataFrame:
    """Non-blank lines read vs kept (valid), in one pass.  Spark refuses a JSON
    scan of the corrupt-record column alone, so the count names a field too."""
    first = next(c for c in df.columns if c != CORRUPT)
    valid = F.when(F.col(CORRUPT).isNull(), F.struct(first))
    return df.agg(F.count(F.lit(1)).alias("total"), F.count(valid).alias("kept"))


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Header CSV, UTF-8 BOM removed, quoted multi-line fields, doubled
    quotes; pandas' default missing-value words become NULL."""
    df = (spark.read.schema(schema).option("header", True).option("multiLine", True)
          .option("escape", '"').option("encoding", "UTF-8").csv(path))
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            df = df.withColumn(f.name, F.when(F.col(f.name).isin(*NA_WORDS), None).otherwise(F.col(f.name)))
    return df


def flatten_wiki_pages(resp: DataFrame) -> DataFrame:
    """API response rows -> article rows (id, title, text, url).
    First revision's main slot; pages without revisions or content dropped."""
    pages = resp.select(F.explode("query.pages").alias("p"))
    content = F.element_at(F.col("p.revisions"), 1)["slots"]["main"]["content"]
    return (pages.select(F.col("p.pageid").alias("id"), F.col("p.title").alias("title"),
                         content.alias("text"))
            .filter(F.col("text").isNotNull() & (F.col("text") != ""))
            .withColumn("url", wiki_url("title")))


def content_pages(df: DataFrame, ns_col: str = "ns", redirect_col: str = "redirect") -> DataFrame:
    """main namespace, non-redirect pages of a dump table."""
    return df.filter((F.col(ns_col) == 0) & ~F.coalesce(F.col(redirect_col), F.lit(False)))


def write_corpus(df: DataFrame, path: str, partition_col: str = "source") -> None:
    """K1: snappy Parquet, one directory per source, old output replaced.  Rows are
    rebalanced by source first: adaptive execution merges small sources into one task and
    cuts large ones at ``spark.sql.adaptive.advisoryPartitionSizeInBytes``, so a source has
    as many files as its size asks for, not one per task."""
    (df.hint("rebalance", F.col(partition_col)).write.mode("overwrite").option("compression", "snappy")
     .partitionBy(partition_col).parquet(path))


def written_sizes(spark: SparkSession, path: str, partition_col: str = "source") -> DataFrame:
    """A1: one row per source of a written corpus: ``output_path``, ``output_files``,
    ``output_bytes`` and ``output_size`` in words, from the hidden file metadata (no
    column of the data is read)."""
    files = (spark.read.parquet(path)
             .select(F.col(partition_col).cast("string").alias("source"), F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_size").alias("size")).distinct())
    folder = F.concat(F.lit(f"{path.rstrip('/')}/{partition_col}="), F.coalesce("source", F.lit("__HIVE_DEFAULT_PARTITION__")))
    return files.groupBy("source").agg(F.count(F.lit(1)).alias("output_files"), F.sum("size").alias("output_bytes")).select(
        "source", folder.alias("output_path"), "output_files", "output_bytes", format_size("output_bytes").alias("output_size"))


def jsonl_to_parquet(spark: SparkSession, src: str, dst: str, schema: T.StructType = ARTICLE_SCHEMA) -> int:
    """K2: malformed lines skipped; no valid record -> error, nothing written."""
    df = valid_rows(read_jsonl(spark, src, schema, lenient=True))
    if not df.head(1):
        raise ValueError(f"no valid records in {src}")
    df.write.mode("overwrite").parquet(dst)
    return spark.read.parquet(dst).count()


def write_jsonl(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """K3: one object per line, UTF-8 unescaped, rows in ``order``."""
    out = df.orderBy(*order) if order else df
    (out.write.mode("overwrite").option("ignoreNullFields", False)
     .option("compression", "none").json(path))


def append_csv(df: DataFrame, path: str) -> None:
    """K4: create-or-append with a header (each part file has one)."""
    df.write.mode("append").option("header", True).option("escape", '"').csv(path)


def write_report(df: DataFrame, path: str) -> None:
    """K5: small report (one row per source) as JSON."""
    df.coalesce(1).write.mode("overwrite").json(path)


def write_log(rows: list[DataFrame], path: str) -> None:
    """K6: sparse metric rows -> CSV files with the union of columns, each with the
    header; a log of any length is written by all tasks."""
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r, allowMissingColumns=True)
    out.write.mode("overwrite").option("header", True).csv(path)


def normalise_author(col) -> F.Column:
    """empty/missing author -> 'Unknown'."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.nullif(ustrip(c), F.lit("")), F.lit("Unknown"))
