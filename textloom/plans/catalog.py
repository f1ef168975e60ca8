"""Registered queries on the driver tables: each key has a Spark plan built from
the library's operators and (where SQL can say it) an independent DuckDB SQL
oracle.  Column names and types match between the two.

Fixture parameters (documents table): registry src0..src19 ranked by number;
paragraph dedup on src0..src9 with separator "\\n" (the fixture has no blank
lines); weight 3 on src0..src4; min lengths 20/50.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions.text import WS_CODEPOINTS
from ..session import ship_package
from ..sources.corpus import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


# ----------------------------------------------------------------- SQL helpers
WS_SQL = "(" + " || ".join(f"chr({c})" for c in WS_CODEPOINTS) + ")"


def sql_strip(x: str) -> str:
    return f"trim({x}, {WS_SQL})"


def sql_hash(x: str) -> str:
    return f"sha256(nfc_normalize({x}))"


REG_SQL = ("SELECT 'src' || i::VARCHAR AS source, i::INTEGER AS source_rank, "
           "(i < 10) AS para_dedup, (CASE WHEN i < 5 THEN 3 ELSE 1 END)::INTEGER AS weight "
           "FROM range(20) t(i)")

PARA_SEP = "\n"
MIN_PARA = 50
MIN_DOC = 20


def dedup_ctes() -> str:
    """Chained CTEs computing the three-stage dedup with window functions."""
    return f"""
reg AS ({REG_SQL}),
base AS (
  SELECT d.source, r.source_rank, r.para_dedup, d.doc_id AS pos, coalesce(d.text, '') AS text
  FROM documents d JOIN reg r USING (source)),
s1 AS (
  SELECT *, (text <> '' AND row_number() OVER (
      PARTITION BY CASE WHEN text <> '' THEN {sql_hash('text')} END
      ORDER BY source_rank, pos) = 1) AS first_raw
  FROM base),
occ AS (
  SELECT s1.source_rank, s1.pos, u.i - 1 AS i, {sql_strip('u.p')} AS p
  FROM s1, unnest(string_split(s1.text, chr(10))) WITH ORDINALITY AS u(p, i)
  WHERE s1.first_raw AND s1.para_dedup),
occ2 AS (
  SELECT *, CASE WHEN length(p) >= {MIN_PARA} THEN {sql_hash('p')} END AS ph FROM occ),
occ3 AS (
  SELECT *, (ph IS NULL OR row_number() OVER (PARTITION BY source_rank, ph ORDER BY pos, i) = 1) AS keep
  FROM occ2),
rebuilt AS (
  SELECT source_rank, pos,
         {sql_strip("coalesce(string_agg(p, chr(10) ORDER BY i) FILTER (WHERE p <> '' AND keep), '')")} AS new_text
  FROM occ3 GROUP BY source_rank, pos),
s2 AS (
  SELECT s1.*, {sql_strip('s1.text')} AS stripped,
         CASE WHEN s1.para_dedup THEN coalesce(rb.new_text, '') ELSE {sql_strip('s1.text')} END AS new_text
  FROM s1 LEFT JOIN rebuilt rb USING (source_rank, pos)),
s3 AS (
  SELECT *, (first_raw AND para_dedup AND new_text <> stripped) AS para_changed,
         length(new_text) < {MIN_DOC} AS too_short FROM s2),
s4 AS (
  SELECT *, (first_raw AND NOT too_short AND row_number() OVER (
      PARTITION BY CASE WHEN first_raw AND NOT too_short THEN {sql_hash('new_text')} END
      ORDER BY source_rank, pos) = 1) AS first_final
  FROM s3),
status AS (
  SELECT source, source_rank, pos, para_changed,
         CASE WHEN text = '' THEN 'empty' WHEN NOT first_raw THEN 'raw_dup'
              WHEN too_short THEN 'too_short' WHEN NOT first_final THEN 'final_dup'
              ELSE 'kept' END AS status,
         CASE WHEN first_raw AND NOT too_short AND first_final THEN new_text END AS out_text
  FROM s4)"""
