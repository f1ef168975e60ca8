"""Tokeniser queries: pre-token counts, merge learning, round trip, token
counts and the weighted token audit of the deduplicated corpus."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audit as A
from ..operators import bpe as B
from ..operators import dedup as D
from ..sources.corpus import documents_corpus, fixture_registry
from .catalog import MIN_DOC, MIN_PARA, PARA_SEP, dedup_ctes, register, table

N_MERGES = 50_000      # vocabulary 50,257: the special token, 256 bytes, merges


def _few_merges(spark):
    """" t", "he", " the", "en": merges whose effect SQL can count."""
    sym = {c: B.BYTE_IDS[ord(c)] for c in " then"}
    rows = [(0, sym[" "], sym["t"], 257), (1, sym["h"], sym["e"], 258), (2, 257, 258, 259),
            (3, sym["e"], sym["n"], 260)]
    return spark.createDataFrame(rows, "rank int, left int, right int, id int")


def published_merges(spark):
    """The 50,000 merges of the published byte-level vocabulary."""
    import public_tokenizers
    return B.read_merges(spark, public_tokenizers.path("byte_bpe_50k.json"))


def _count_sql(x: str, part: str) -> str:
    return f"(length({x}) - length(replace({x}, '{part}', ''))) // {len(part)}"


#: One token per UTF-8 byte, less one per merge that applies ("he" goes before "en").
_DOC_TOKENS_SQL = ("(strlen(t) - " + _count_sql("t", " t") + " - " + _count_sql("t", "he") + " - "
                   + _count_sql("t", " the") + " - " + _count_sql("replace(t, 'he', '#')", "en") + ")")


# RE2 has no look-ahead: a mark before the last character of each white-space run
# that a word follows makes the split pattern expressible without one
_PRETOKENS_SQL = """
SELECT word, count(*) AS n FROM (
  SELECT unnest(regexp_extract_all(
    regexp_replace(nfc_normalize(coalesce(text, '')), '(\\s)(\\S)', chr(1) || '\\1\\2', 'g'),
    '''s|''t|''re|''ve|''m|''ll|''d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}\\x01]+|\\s+')) AS word
  FROM documents) GROUP BY word"""


@register("pretoken_counts", _PRETOKENS_SQL)
def pretoken_counts(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return B.pretoken_counts(d, "text")


def _byte_id_sql(pair: str) -> str:
    digit = "instr('0123456789ABCDEF', {}) - 1".format
    return f"({B.BYTE_IDS}::INTEGER[])[1 + 16 * ({digit(f'left({pair}, 1)')}) + {digit(f'right({pair}, 1)')}]"


@register("pair_counts", f"""
WITH w AS ({_PRETOKENS_SQL}),
b AS (SELECT n, hex(encode(word)) AS x FROM w WHERE strlen(word) > 1),
p AS (SELECT n, substr(x, 2 * u.i + 1, 2) AS l, substr(x, 2 * u.i + 3, 2) AS r
      FROM b, LATERAL unnest(range(0, length(x) // 2 - 1)) AS u(i))
SELECT {_byte_id_sql('l')} AS "left", {_byte_id_sql('r')} AS "right", sum(n)::BIGINT AS cnt FROM p GROUP BY ALL""")
def pair_counts(spark, sf_dir):
    """Adjacent byte pairs of all pre-tokens: what the first merge is chosen from."""
    return B.pair_counts(B.byte_words(B.pretoken_counts(table(spark, sf_dir, "documents"), "text")))


@register("bpe_merges")
def bpe_merges(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return B.learn_merges(B.pretoken_counts(d, "text"), N_MERGES)


@register("bpe_roundtrip", "SELECT count(*)::BIGINT AS docs, 0::BIGINT AS errors FROM documents")
def bpe_roundtrip(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    merges = B.learn_merges(B.pretoken_counts(d, "text"), N_MERGES)
    return B.roundtrip_errors(d, merges, ["doc_id"])


def _kept(spark, sf_dir):
    st = D.dedup_status(documents_corpus(spark, sf_dir), fixture_registry(spark),
                        para_sep=PARA_SEP, min_para_chars=MIN_PARA, min_doc_chars=MIN_DOC)
    return D.deduped_output(st)


_TOKENS_SQL = f"""
WITH {dedup_ctes()},
tc AS (SELECT source, sum({_DOC_TOKENS_SQL})::BIGINT AS tokens
       FROM (SELECT source, nfc_normalize(out_text) AS t FROM status WHERE status = 'kept') GROUP BY source)"""


@register("token_counts", _TOKENS_SQL + "\nSELECT source, tokens FROM tc")
def token_counts(spark, sf_dir):
    """Tokens of the deduplicated documents per source under four merges: the form that SQL
    can follow; ``token_counts_bpe`` has the whole vocabulary."""
    return B.token_counts(_kept(spark, sf_dir), _few_merges(spark), ["source"])


# The keys with SQL keep the merges that SQL can count; the *_bpe keys use the whole vocabulary
@register("token_counts_bpe")
def token_counts_bpe(spark, sf_dir):
    """Tokens of the published vocabulary per source, deduplicated documents."""
    return B.token_counts(_kept(spark, sf_dir), published_merges(spark), ["source"])


_AUDIT_SQL = _TOKENS_SQL + f"""
, per AS (SELECT tc.source, tc.tokens, coalesce(r.weight, 1)::BIGINT AS weight,
                 (tc.tokens * coalesce(r.weight, 1))::BIGINT AS weighted_tokens
          FROM tc LEFT JOIN reg r USING (source)),
tot AS (SELECT sum(tokens)::BIGINT AS unique_tokens, sum(weighted_tokens)::BIGINT AS eff FROM per)
, audit AS (
SELECT source, tokens, weight, weighted_tokens, unique_tokens, eff AS effective_tokens_with_weights,
       {A.TOKEN_BUDGET}::BIGINT AS token_budget,
       CASE WHEN unique_tokens > 0 THEN round_even({A.TOKEN_BUDGET}::DOUBLE / unique_tokens, 2) END
         AS repeat_factor,
       eff >= {A.TOKEN_BUDGET} AS enough_for_budget, (eff - {A.TOKEN_BUDGET})::BIGINT AS budget_gap_or_surplus
FROM per, tot)"""


@register("token_audit", _AUDIT_SQL + " SELECT * FROM audit")
def token_audit(spark, sf_dir):
    """The audit of ``token_counts``: the form that SQL can follow; ``token_audit_bpe`` has the
    whole vocabulary."""
    counts = B.token_counts(_kept(spark, sf_dir), _few_merges(spark), ["source"])
    return A.token_audit(counts, fixture_registry(spark))


@register("token_audit_bpe")
def token_audit_bpe(spark, sf_dir):
    """The audit of ``token_counts_bpe`` against the budget."""
    return A.token_audit(token_counts_bpe(spark, sf_dir), fixture_registry(spark))


_N = "format('{{:,}}', {})".format


@register("audit_summary", _AUDIT_SQL + f"""
SELECT ({(1 << 30) + 4} + source_rank)::INTEGER AS _o,
       source || ' ' || {_N('tokens')} || '  x' || weight::VARCHAR || '  = ' || {_N('weighted_tokens')} AS line
FROM audit JOIN (SELECT source, source_rank FROM reg) r USING (source)
UNION ALL (SELECT u._o, u.line FROM (SELECT unnest([
    {{'_o': {(1 << 30) + 1}::INTEGER, 'line': 'Unique tokens after dedup: ' || {_N('unique_tokens')}}},
    {{'_o': {(1 << 30) + 2}::INTEGER, 'line': 'Training token budget: ' || {_N('token_budget')}}},
    {{'_o': {(1 << 30) + 3}::INTEGER, 'line': 'Repeat factor (unweighted): ' || printf('%.2fx', coalesce(repeat_factor, 0))}},
    {{'_o': {(1 << 30) + 1 + (1 << 20)}::INTEGER, 'line': 'Effective tokens: ' || {_N('effective_tokens_with_weights')}}},
    {{'_o': {(1 << 30) + 2 + (1 << 20)}::INTEGER, 'line': CASE WHEN enough_for_budget
      THEN 'Surplus: ' || {_N('budget_gap_or_surplus')} || ' tokens above budget'
      ELSE 'Gap: ' || {_N('-budget_gap_or_surplus')} || ' tokens below budget' END}}]) AS u
  FROM (SELECT * FROM audit LIMIT 1)))""")
def audit_summary(spark, sf_dir):
    """A5, token-audit lines of ``token_audit`` (the form that SQL can follow)."""
    return _summary(spark, token_audit(spark, sf_dir))


@register("audit_summary_bpe")
def audit_summary_bpe(spark, sf_dir):
    """A5, token-audit lines of ``token_audit_bpe``."""
    return _summary(spark, token_audit_bpe(spark, sf_dir))


def _summary(spark, audit):
    reg = fixture_registry(spark)
    return D.audit_summary(audit.join(reg.select("source", "source_rank"), "source"), F.col("source_rank"))
