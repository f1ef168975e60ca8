"""Sinks and sources over the documents: each query writes the table with a sink
into the shared folder and reads it back with the matching source."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.mixture import union_sources
from ..session import checkpoint_dir
from ..sources import corpus as C
from ..sources import formats as S
from .catalog import register, table

ROW = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("source", T.StringType()),
                    T.StructField("text", T.StringType())])
_SAME = "SELECT doc_id, source, sha256(text) AS h FROM documents"


def _folder(spark) -> str:
    return f"{checkpoint_dir(spark)}/io-{uuid.uuid4().hex}"


def _rows(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "source", "text")


def _hashed(df):
    return df.select("doc_id", "source", F.sha2("text", 256).alias("h"))


@register("corpus_round_trip", "SELECT source, text, count(*) AS n FROM documents GROUP BY source, text")
def corpus_round_trip(spark, sf_dir):
    """A Parquet folder per source, read back as a corpus; one path is
    missing.  ``source`` is the folder's stem, ``source=<name>``."""
    out = _folder(spark)
    S.write_corpus(_rows(spark, sf_dir), out)
    names = [r[0] for r in spark.read.parquet(out).select("source").distinct().collect()]  # one per source
    df = C.read_corpus(spark, [f"{out}/source={n}" for n in [*sorted(names), "missing"]])
    one_each = df.groupBy("source", "source_rank", "pos").agg(F.min("text").alias("text"))  # pos is unique
    return one_each.groupBy(F.regexp_replace("source", "^source=", "").alias("source"), "text").agg(
        F.count(F.lit(1)).alias("n"))


@register("jsonl_lenient", "SELECT doc_id, source, sha256(text) AS h, count(*) OVER () AS kept, "
                           "count(*) OVER () + 2 AS total FROM documents")
def jsonl_lenient(spark, sf_dir):
    """JSON lines written, two malformed lines added, valid rows and
    counts read back."""
    out = _folder(spark)
    S.write_jsonl(_rows(spark, sf_dir), out)
    spark.createDataFrame([("{broken",), ("also broken}",)], "value string").write.mode("append").text(out)
    df = S.read_jsonl(spark, out, ROW)
    return _hashed(S.valid_rows(df)).crossJoin(S.ingest_counts(df).select("kept", "total"))  # one row


@register("jsonl_strict", _SAME)
def jsonl_strict(spark, sf_dir):
    """Strict read of well-formed lines with required keys."""
    out = _folder(spark)
    S.write_jsonl(_rows(spark, sf_dir), out, order=["doc_id"])
    return _hashed(S.read_jsonl(spark, out, ROW, lenient=False, required=("doc_id", "text")))


@register("jsonl_to_parquet", _SAME)
def jsonl_to_parquet(spark, sf_dir):
    """K2: JSON lines to Parquet."""
    src, dst = _folder(spark), _folder(spark)
    S.write_jsonl(_rows(spark, sf_dir), src)
    S.jsonl_to_parquet(spark, src, dst, ROW)
    return _hashed(spark.read.parquet(dst))


@register("csv_append", "SELECT doc_id, source, sha256(CASE WHEN text NOT IN ("
          + ", ".join(f"'{w}'" for w in S.NA_WORDS) + ") THEN text END) AS h FROM documents")
def csv_append(spark, sf_dir):
    """Two appends of a half each, read back with quoted line breaks and
    missing-value words."""
    out, d = _folder(spark), _rows(spark, sf_dir)
    S.append_csv(d.filter("doc_id % 2 = 0"), out)
    S.append_csv(d.filter("doc_id % 2 <> 0"), out)
    df = S.read_csv(spark, out, "doc_id long, source string, text string")
    return _hashed(union_sources([df.filter("doc_id % 3 = 0"), df.filter("doc_id % 3 <> 0")]))


@register("report_sink", "SELECT source, count(*) AS docs FROM documents GROUP BY source")
def report_sink(spark, sf_dir):
    """K5: a report with one row per source, as JSON."""
    out = _folder(spark)
    S.write_report(_rows(spark, sf_dir).groupBy("source").agg(F.count(F.lit(1)).alias("docs")), out)
    return spark.read.schema("source string, docs long").json(out)


@register("log_sink", """
SELECT event_id AS step, CASE WHEN event_type = 'view' THEN value END AS loss,
       CASE WHEN event_type <> 'view' THEN value END AS eval_loss FROM events""")
def log_sink(spark, sf_dir):
    """K6: sparse metric rows of two kinds in one CSV log."""
    out, e = _folder(spark), table(spark, sf_dir, "events").select(F.col("event_id").alias("step"), "event_type", "value")
    S.write_log([e.filter("event_type = 'view'").select("step", F.col("value").alias("loss")),
                 e.filter("event_type <> 'view'").select("step", F.col("value").alias("eval_loss"))], out)
    return spark.read.option("header", True).schema("step long, loss double, eval_loss double").csv(out)
