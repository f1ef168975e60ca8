"""Dedup queries on the driver's ``documents`` table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.text import doc_hash, nfc, ustrip
from ..operators import dedup as D
from ..session import checkpoint_dir
from ..sources.corpus import documents_corpus, fixture_registry
from ..sources.formats import write_corpus, written_sizes
from .catalog import (MIN_DOC, MIN_PARA, PARA_SEP, dedup_ctes, register, sql_hash,
                      sql_strip, table)


def _status(spark, sf_dir):
    return D.dedup_status(documents_corpus(spark, sf_dir), fixture_registry(spark),
                          para_sep=PARA_SEP, min_para_chars=MIN_PARA, min_doc_chars=MIN_DOC)


def _decisions(spark, sf_dir):
    """Statuses without texts: all that reports need."""
    return D.dedup_decisions(documents_corpus(spark, sf_dir), fixture_registry(spark),
                             para_sep=PARA_SEP, min_para_chars=MIN_PARA, min_doc_chars=MIN_DOC)


@register("nfc_doc_hash", f"""
SELECT doc_id, source, {sql_hash("coalesce(text, '')")} AS h FROM documents""")
def nfc_doc_hash(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", "source", doc_hash("text").alias("h"))


@register("nfc_injected", f"""
SELECT doc_id, {sql_hash("coalesce(text, '') || ' tie' || chr(770) || chr(769) || 'ng Vie' || chr(803) || chr(770) || 't ' || chr(8491) || lang")} AS h,
       length(nfc_normalize(coalesce(text, '') || ' tie' || chr(770) || chr(769) || 'ng Vie' || chr(803) || chr(770) || 't ' || chr(8491) || lang))::BIGINT AS n
FROM documents""")
def nfc_injected(spark, sf_dir):
    """P1 on text that is not in normal form: every document with decomposed Vietnamese
    words and a singleton behind it."""
    d = table(spark, sf_dir, "documents")
    t = F.concat(F.coalesce("text", F.lit("")), F.lit(" tie\u0302\u0301ng Vie\u0323\u0302t \u212b"), "lang")
    return d.select("doc_id", t.alias("t")).select(
        "doc_id", doc_hash("t").alias("h"), F.length(nfc("t")).cast("long").alias("n"))


@register("doc_dedup_keep_first", f"""
SELECT doc_id, source FROM (
  SELECT doc_id, source, row_number() OVER (
    PARTITION BY {sql_hash("coalesce(text, '')")} ORDER BY doc_id) AS rn
  FROM documents) WHERE rn = 1""")
def doc_dedup_keep_first(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return D.dedup_exact(d, doc_hash("text"), ["doc_id"]).select("doc_id", "source")


@register("min_length_filter", f"""
SELECT doc_id, source, length({sql_strip('text')})::BIGINT AS stripped_len FROM documents
WHERE coalesce(text, '') <> '' AND length({sql_strip('text')}) >= {MIN_DOC}""")
def min_length_filter(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    d = D.min_chars(D.drop_empty(d, "text"), "text", MIN_DOC)
    return d.select("doc_id", "source", F.length(ustrip("text")).cast("long").alias("stripped_len"))


@register("dedup_status", f"""
WITH {dedup_ctes()}
SELECT source, pos AS doc_id, status, para_changed,
       length(out_text)::BIGINT AS out_len, sha256(out_text) AS out_hash
FROM status""")
def dedup_status_q(spark, sf_dir):
    s = _status(spark, sf_dir)
    return s.select("source", F.col("pos").alias("doc_id"), "status", "para_changed",
                    F.length("text").cast("long").alias("out_len"),
                    F.sha2("text", 256).alias("out_hash"))


@register("paragraph_dedup", f"""
WITH {dedup_ctes()}
SELECT source, pos AS doc_id, para_changed, length(new_text)::BIGINT AS new_len,
       sha256(new_text) AS new_hash
FROM s4 WHERE first_raw AND para_dedup""")
def paragraph_dedup(spark, sf_dir):
    first = _decisions(spark, sf_dir).filter(~F.col("status").isin("empty", "raw_dup"))
    f = D.cleaned_texts(documents_corpus(spark, sf_dir), fixture_registry(spark), first, PARA_SEP).filter("para_dedup")
    return f.select("source", F.col("pos").alias("doc_id"), "para_changed",
                    F.length("new_text").cast("long").alias("new_len"),
                    F.sha2("new_text", 256).alias("new_hash"))


@register("dedup_report", f"""
WITH {dedup_ctes()},
agg AS (
  SELECT source, count(*) AS original_docs,
         count(*) FILTER (WHERE status IN ('raw_dup', 'final_dup')) AS removed_by_doc_dedup,
         count(*) FILTER (WHERE para_changed) AS removed_by_paragraph_dedup,
         count(*) FILTER (WHERE status IN ('empty', 'too_short')) AS removed_as_too_short,
         count(*) FILTER (WHERE status = 'kept') AS deduped_docs
  FROM status GROUP BY source)
SELECT r.source, coalesce(original_docs, 0)::BIGINT AS original_docs,
       coalesce(removed_by_doc_dedup, 0)::BIGINT AS removed_by_doc_dedup,
       coalesce(removed_by_paragraph_dedup, 0)::BIGINT AS removed_by_paragraph_dedup,
       coalesce(removed_as_too_short, 0)::BIGINT AS removed_as_too_short,
       coalesce(deduped_docs, 0)::BIGINT AS deduped_docs,
       (coalesce(original_docs, 0) - coalesce(deduped_docs, 0))::BIGINT AS removed_docs,
       CASE WHEN coalesce(original_docs, 0) > 0
            THEN round_even((original_docs - deduped_docs) / original_docs, 4) ELSE 0.0 END::DOUBLE
         AS duplicate_rate
FROM reg r LEFT JOIN agg USING (source)""")
def dedup_report_q(spark, sf_dir):
    rep = D.dedup_report(_decisions(spark, sf_dir), fixture_registry(spark))
    return rep.drop("source_rank")


@register("dedup_outputs", f"""
WITH {dedup_ctes()},
agg AS (
  SELECT source, count(*) AS original_docs, count(*) FILTER (WHERE status = 'kept') AS deduped_docs
  FROM status GROUP BY source)
SELECT r.source, coalesce(original_docs, 0)::BIGINT AS original_docs, coalesce(deduped_docs, 0)::BIGINT AS deduped_docs,
       CASE WHEN deduped_docs > 0 THEN 'source=' || r.source END AS folder, coalesce(deduped_docs, 0) > 0 AS has_bytes,
       coalesce(deduped_docs, 0)::BIGINT AS read_back
FROM reg r LEFT JOIN agg USING (source)""")
def dedup_outputs(spark, sf_dir):
    """K1, A1: the deduplicated corpus written per source, and the report with where and
    how large each output is; ``read_back``: rows that its folder holds."""
    decided = _decisions(spark, sf_dir)
    kept = decided.filter("status = 'kept'")
    texts = D.cleaned_texts(documents_corpus(spark, sf_dir), fixture_registry(spark), kept, PARA_SEP)
    out = f"{checkpoint_dir(spark)}/deduped-{uuid.uuid4().hex}"
    write_corpus(texts.select("source", F.col("new_text").alias("text")), out)
    report = D.with_outputs(D.dedup_report(decided, fixture_registry(spark)), written_sizes(spark, out))
    rows = spark.read.parquet(out).groupBy("source").agg(F.count(F.lit(1)).alias("read_back"))
    return report.join(rows, "source", "left").select(
        "source", "original_docs", "deduped_docs", F.regexp_extract("output_path", "([^/]*)\\z", 1).alias("folder"),
        (F.col("output_bytes") > 0).alias("has_bytes"), F.coalesce("read_back", F.lit(0)).cast("long").alias("read_back"))


@register("dedup_totals", f"""
WITH {dedup_ctes()}
SELECT count(*)::BIGINT AS total_original_docs,
       count(*) FILTER (WHERE status = 'kept')::BIGINT AS total_deduped_docs,
       (count(*) - count(*) FILTER (WHERE status = 'kept'))::BIGINT AS total_removed_docs,
       CASE WHEN count(*) > 0 THEN round_even((count(*) - count(*) FILTER (WHERE status = 'kept'))
            / count(*), 4) ELSE 0.0 END::DOUBLE AS duplicate_rate
FROM status""")
def dedup_totals_q(spark, sf_dir):
    return D.dedup_totals(_decisions(spark, sf_dir))


def _line_sql(name: str, o: str, k: str, r: str, rate: str) -> str:
    return (f"{name} || ' ' || format('{{:,}}', {o}) || ' -> ' || format('{{:,}}', {k}) || '  (-' || "
            f"format('{{:,}}', {r}) || ', ' || printf('%.1f', round_even({rate} * 100, 1)) || '%)'")


@register("dedup_summary", f"""
WITH {dedup_ctes()},
per AS (SELECT r.source, r.source_rank, count(s.source)::BIGINT AS o, count(*) FILTER (WHERE s.status = 'kept')::BIGINT AS k
        FROM reg r LEFT JOIN status s USING (source) GROUP BY r.source, r.source_rank),
tot AS (SELECT sum(o)::BIGINT AS o, sum(k)::BIGINT AS k FROM per)
SELECT source_rank::INTEGER AS _o, {_line_sql('source', 'o', 'k', '(o - k)',
    'CASE WHEN o > 0 THEN round_even((o - k) / o, 4) ELSE 0.0 END')} AS line FROM per
UNION ALL
SELECT {1 << 30}::INTEGER, {_line_sql("'TOTAL'", 'o', 'k', '(o - k)',
    'CASE WHEN o > 0 THEN round_even((o - k) / o, 4) ELSE 0.0 END')} FROM tot""")
def dedup_summary(spark, sf_dir):
    """A5 text lines over the report and totals."""
    st = _decisions(spark, sf_dir)
    return D.summary(D.dedup_report(st, fixture_registry(spark)), D.dedup_totals(st))
