"""Queries of the conversation trie, language identification and vector codes."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from . import language_id, prefix_trie, vector_codes
from .registry import register

_OP11_SQL = """
WITH RECURSIVE
bits(n, c, i) AS (
  SELECT range::BIGINT, range::BIGINT, 0 FROM range(256) UNION ALL
  SELECT n, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i + 1 FROM bits WHERE i < 8),
crc AS (SELECT list(c ORDER BY n) AS l FROM bits WHERE i = 8),
turns AS MATERIALIZED (
  SELECT conv_id, d, n, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, d) - 1 AS p
  FROM (SELECT conv_id, turn, strlen(coalesce(text, '')) AS n,
               sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS d
        FROM conversations WHERE conv_id IS NOT NULL)),
conv AS MATERIALIZED (
  SELECT conv_id, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
           string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
           lambda a, b: xor(a >> 8, l[(xor(a, b) & 255) + 1])), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM turns), crc),
shared AS (SELECT c.conv_id, t.p AS i, d, n FROM conv c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 5 AND t.p < c.h),
m AS (SELECT conv_id, count(*) AS m FROM shared GROUP BY 1),
rebuilt AS MATERIALIZED (
  SELECT * FROM shared UNION ALL
  SELECT c.conv_id, coalesce(m.m, 0) + t.p - c.h, d, n
  FROM conv c JOIN turns t ON t.conv_id = c.conv_id AND t.p >= c.h LEFT JOIN m ON m.conv_id = c.conv_id),
member AS MATERIALIZED (
  SELECT conv_id, 0 AS depth, '' AS k, NULL::VARCHAR AS up, 0 AS n FROM conv UNION ALL
  SELECT conv_id, i + 1, k, coalesce(lag(k) OVER (PARTITION BY conv_id ORDER BY i), ''), n
  FROM (SELECT *, string_agg(d, '') OVER (PARTITION BY conv_id ORDER BY i) AS k FROM rebuilt)),
ending AS (SELECT conv_id, max(depth) AS depth FROM member GROUP BY 1),
node AS MATERIALIZED (
  SELECT m.k, m.depth, any_value(m.up) AS up, min(m.conv_id) AS conv_id, count(*) AS n_convs, any_value(m.n) AS n,
         coalesce(string_agg(m.conv_id::VARCHAR, ',' ORDER BY m.conv_id) FILTER (WHERE e.depth = m.depth), '') AS ends
  FROM member m JOIN ending e ON e.conv_id = m.conv_id GROUP BY m.k, m.depth),
kids AS (SELECT up AS k, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY 1),
above AS (
  SELECT a.k, sum(CASE WHEN kids.k IS NULL THEN 1 ELSE 0 END)::BIGINT AS n_leaves,
         sum((v.n_convs - 1) * v.n)::BIGINT AS saved_tokens
  FROM node v JOIN member a ON a.conv_id = v.conv_id AND a.depth <= v.depth LEFT JOIN kids ON kids.k = v.k
  GROUP BY a.k)
SELECT v.conv_id, v.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, v.n_convs,
       coalesce(kids.n_children, 0)::BIGINT AS n_children, above.n_leaves, above.saved_tokens,
       sha256(v.ends) AS ends_sha256
FROM node v JOIN above ON above.k = v.k LEFT JOIN kids ON kids.k = v.k
LEFT JOIN node p ON p.k = v.up AND p.depth = v.depth - 1"""


@register("op11_prefix_trie", _OP11_SQL)
def op11_prefix_trie(spark, sf_dir):
    """Every node of the prefix trie of all rebuilt conversations."""
    d = prefix_trie.conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"), share=5, most=9)
    return d.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


@register("op12_language_id")
def op12_language_id(spark, sf_dir):
    """Language of every whole text, learned from the rows that are not held out.  A
    text whose distance is rejected keeps its nearest language unless it has no
    letter (``rejected`` tells)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = language_id.fit(docs, learn=~held_out)
    d = language_id.identify(docs, model)
    return d.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col("nearest").alias("lang_pred"),
                    "score", "rejected")


def _op13_sql(rounds: int = 4) -> str:
    dist = "list_inner_product(x.v, x.v) - 2 * list_inner_product(x.v, c.v) + list_inner_product(c.v, c.v)"
    steps = []
    for t in range(rounds + 1):
        steps.append(f"""
a{t} AS MATERIALIZED (
  SELECT x.rid, x.p, min({{'d': {dist}, 'e': c.e}}) AS b FROM x JOIN c{t} c ON c.p = x.p GROUP BY x.rid, x.p)""")
        if t < rounds:
            steps.append(f"""
c{t + 1} AS MATERIALIZED (
  SELECT c.p, c.e, coalesce(m.v, c.v) AS v FROM c{t} c LEFT JOIN (
    SELECT p, e, list(floor(s / n) ORDER BY j) AS v FROM (
      SELECT p, e, j, sum(y) AS s, count(*) AS n FROM (
        SELECT x.p, a.b.e AS e, unnest(x.v) AS y, generate_subscripts(x.v, 1) AS j
        FROM x JOIN a{t} a ON a.rid = x.rid AND a.p = x.p) GROUP BY p, e, j) GROUP BY p, e) m
  ON m.p = c.p AND m.e = c.e)""")
    return f"""
WITH k AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) AS rid, vec_id, label,
         list_transform(embedding, lambda y: floor(1024 * y::DOUBLE)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0),
x AS MATERIALIZED (
  SELECT rid, p, list_slice(v, p * (len(v) // 4) + 1, (p + 1) * (len(v) // 4)) AS v FROM k, range(4) AS r(p)),
c0 AS MATERIALIZED (SELECT p, rid - 1 AS e, v FROM x WHERE rid <= 256),{','.join(steps)},
row_error AS (
  SELECT rid, string_agg(lpad(printf('%x', b.e), 2, '0'), '' ORDER BY p) AS code, sum(b.d)::BIGINT AS error
  FROM a{rounds} GROUP BY rid),
books AS (SELECT sha256(string_agg(s, ',' ORDER BY p, e)) AS codebooks_sha256 FROM (
  SELECT p, e, array_to_string(list_transform(v, lambda y: y::BIGINT), ',') AS s FROM c{rounds}))
SELECT k.vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM k JOIN row_error USING (rid), books"""


@register("op13_vector_codes", _op13_sql())
def op13_vector_codes(spark, sf_dir):
    """Product codes of every finite vector, errors, and the codebooks' digest."""
    d, books = vector_codes.vector_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    digest = hashlib.sha256(",".join(str(v) for book in books for entry in book for v in entry).encode()).hexdigest()
    return d.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error",
                    F.lit(digest).alias("codebooks_sha256"))
