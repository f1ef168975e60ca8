"""One query per operator over the whole ``documents`` table, with DuckDB SQL
where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup as exact
from . import line_dedup as lines
from . import (  # noqa: F401  (queries_more registers its queries)
    packing,
    quality,
    queries_more,
    rank_bpe,
    records,
    sharding,
    simhash,
    suffix_dedup,
    toxicity,
)
from .common import scratch, stage
from .registry import ORACLE, QUERIES, register  # noqa: F401

#: Limits of a sequence of instruction data.
INSTRUCTIONS = packing.Limits(tokens=4096, segments=8, loss=2048)

_WS_SQL = "[\\x20\\x09-\\x0D]"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@register("op2_sharding")
def op2_sharding(spark, sf_dir):
    """Minimax contiguous shards of the documents, groups of equal texts whole."""
    d = sharding.assign_shards(documents(spark, sf_dir), shards=8)
    return d.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard"))


def _line_fails_sql(x: str) -> str:
    phrases = " OR ".join(f"contains(lower({x}), '{p}')" for p in quality.BOILERPLATE)
    words = f"len(list_filter(regexp_split_to_array({x}, '{_WS_SQL}+'), lambda w: w <> ''))"
    return (f"(({words} >= {quality.MIN_LINE_WORDS} AND 100 * (length({x}) - length(regexp_replace({x}, "
            f"'{quality.PUNCTUATION}', '', 'g'))) > {quality.MAX_PUNCTUATION} * length({x}))"
            f" OR length({x}) - length(regexp_replace({x}, '[|>]', '', 'g')) >= {quality.MIN_SEPARATORS}"
            f" OR {phrases})")


_OP5_SQL = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '{_WS_SQL}+'), lambda x: x <> '') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_replace(x, '{_WS_SQL}', '', 'g') <> '') AS full_lines
      FROM t),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g
        FROM w, LATERAL unnest(range(1, len(w) - 3)) AS u(i) WHERE len(w) >= 5),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
cov AS (SELECT doc_id, sum(least(5, i - prev))::BIGINT AS n
        FROM (SELECT doc_id, i, coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -5) AS prev FROM dup)
        GROUP BY doc_id),
c AS (
  SELECT w.doc_id, len(w)::BIGINT AS n_words,
         length(regexp_replace(t, '{_WS_SQL}', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(full_lines) - len(list_distinct(full_lines)))::BIGINT AS n_dup_lines,
         coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
         coalesce(list_sum(list_transform(list_filter(string_split(t, chr(10)), lambda x: {_line_fails_sql('x')}),
                  lambda x: length(regexp_replace(x, '{_WS_SQL}', '', 'g')))), 0) AS removed
  FROM w LEFT JOIN cov USING (doc_id)),
b AS (SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND 100 * removed <= {quality.MAX_REMOVED} * word_chars) AS kept
FROM b"""


@register("op5_quality_rules", _OP5_SQL)
def op5_quality_rules(spark, sf_dir):
    """Line-first quality rules: counts and verdict of every document."""
    return quality.quality_rules(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


@register("op8_exact_dedup", f"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                  sha256(regexp_replace(coalesce(text, ''), '{_WS_SQL}', '', 'g')) AS text_sha256
           FROM documents),
k AS (SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
             count(*) OVER (PARTITION BY text_sha256) AS group_size FROM t)
SELECT doc_id, keep_id, group_size, (doc_id = keep_id) AS kept, text_sha256 FROM k""")
def op8_exact_dedup(spark, sf_dir):
    """Exact dedup of whole texts without white space, verdict of every document."""
    return exact.exact_dedup(documents(spark, sf_dir))


@register("op9_line_dedup", f"""
WITH l AS (
  SELECT doc_id, u.i AS i, u.line AS line,
         translate(trim(u.line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM documents, unnest(string_split(coalesce(text, ''), chr(10))) WITH ORDINALITY AS u(line, i)),
f AS (SELECT k, max(doc_id) AS last FROM l WHERE length(k) >= 20
      GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT l.*, (f.k IS NOT NULL AND l.doc_id <> f.last) AS dropped FROM l LEFT JOIN f ON l.k = f.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM m GROUP BY doc_id""")
def op9_line_dedup(spark, sf_dir):
    """Cross-document line dedup: line counts and digest of what stays."""
    d = lines.line_dedup(documents(spark, sf_dir), min_chars=20, min_docs=3)
    return d.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def _tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@register("op1_bpe")
def op1_bpe(spark, sf_dir):
    """Encode every whole text by the rank array and decode it again."""
    d = rank_bpe.encode_decode(documents(spark, sf_dir), _tokenizer())
    return d.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                    F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                    F.sha2("decoded", 256).alias("decoded_sha256"))


@register("op3_simhash")
def op3_simhash(spark, sf_dir):
    """SimHash fingerprints and components of fingerprints 4 or fewer bits apart."""
    return simhash.simhash_dedup(documents(spark, sf_dir), words_per_shingle=4, radius=4)


@register("op6_suffix_dedup")
def op6_suffix_dedup(spark, sf_dir):
    """Bytes of 400-byte strings that start twice are removed."""
    d = suffix_dedup.suffix_dedup(documents(spark, sf_dir), length=400)
    return d.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                    F.sha2("kept_bytes", 256).alias("kept_sha256"))


@register("op7_records")
def op7_records(spark, sf_dir):
    """Write token records in doc_id order, read the files back."""
    folder = scratch(spark, "records")
    records.write_records(documents(spark, sf_dir), folder, _tokenizer(), end_id=0)
    d = records.read_records(spark, folder)
    return d.select(F.col("_id").alias("doc_id"), "start", "n_tokens", F.crc32("ids_u32").alias("ids_crc32"))


@register("op10_packing")
def op10_packing(spark, sf_dir):
    """Vector bin packing of all documents into sequences of 1024 tokens."""
    d = packing.pack_documents(documents(spark, sf_dir), _tokenizer())
    return d.select("doc_id", "start", "length", F.col("crc").alias("ids_crc32"), "doc_tokens",
                    "sequence_id", "offset")


@register("pack_instructions")
def pack_instructions(spark, sf_dir):
    """The packing operator on instruction data: whole conversations under limits on
    tokens, segments and loss-bearing tokens (those of the assistant), a conversation
    over a limit alone."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    d = stage(packing.conversation_demands(turns, _tokenizer()), "demands")  # read three times
    placed = packing.pack_examples(d, "conv_id", "tokens", "loss", INSTRUCTIONS)
    return placed.join(d, "conv_id").select("conv_id", "tokens", "loss", "sequence_id", "offset")


@register("op4_toxicity")
def op4_toxicity(spark, sf_dir):
    """Toxicity score of every whole text; labels of held-out ids are not used."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.toxicity(documents(spark, sf_dir), labels, threshold=0.3)
