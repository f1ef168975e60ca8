"""Mixture, ordering, packing, masking, log and chat queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import format_size, nfc, strip_prefix, wrap_sample
from ..operators import audit as A
from ..operators import bpe as B
from ..operators import chat as C
from ..operators import mixture as M
from ..operators import order as O
from ..operators import pack as P
from ..sources.corpus import fixture_registry
from .catalog import REG_SQL, register, sql_strip, table
from .q_bpe import published_merges

SEED = 42
EVAL_RATIO = 0.01
BLOCK, BATCH_DOCS, SHARDS = 1024, 1000, 30          # reference defaults
EOS_ID = 0
POEM_PREFIX = "thơ:\n"
MAX_LEN = 64


def _cp_sql(x: str) -> str:
    """DuckDB: code points of NFC(x) as INTEGER[] (empty -> [])."""
    return (f"(CASE WHEN coalesce({x}, '') = '' THEN []::INTEGER[] ELSE "
            f"list_transform(string_split(nfc_normalize({x}), ''), lambda c: unicode(c)::INTEGER) END)")


@register("weighted_mixture", f"""
WITH reg AS ({REG_SQL})
SELECT d.doc_id, d.source, r.weight, c.copy::INTEGER AS copy
FROM documents d LEFT JOIN reg r USING (source),
     LATERAL (SELECT unnest(generate_series(0, greatest(coalesce(r.weight, 1), 1) - 1)) AS copy) c""")
def weighted_mixture(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "source")
    d = M.replicate(M.with_weight(d, fixture_registry(spark)))
    return d.select("doc_id", "source", "weight", F.col("copy").cast("int"))


_SPLIT_SQL = f"""
WITH reg AS ({REG_SQL}),
mix AS (
  SELECT d.doc_id, d.source, c.copy::INTEGER AS copy
  FROM documents d LEFT JOIN reg r USING (source),
       LATERAL (SELECT unnest(generate_series(0, greatest(coalesce(r.weight, 1), 1) - 1)) AS copy) c),
keyed AS (
  SELECT *, sha256('{SEED}:' || source || ':' || doc_id::VARCHAR || ':' || copy::VARCHAR) AS shuffle_key
  FROM mix),
idx AS (SELECT *, (row_number() OVER (ORDER BY shuffle_key) - 1)::BIGINT AS g,
               count(*) OVER () AS n FROM keyed)
SELECT doc_id, source, copy, g,
       CASE WHEN g < ceil({EVAL_RATIO} * n) THEN 'eval' ELSE 'train' END AS split
FROM idx"""


@register("seeded_shuffle_split", _SPLIT_SQL)
def seeded_shuffle_split(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "source")
    d = M.replicate(M.with_weight(d, fixture_registry(spark)))
    s = M.split_exact(d, EVAL_RATIO, SEED, ["source", "doc_id", "copy"])
    return s.select("doc_id", "source", F.col("copy").cast("int"), "g", "split")


@register("head_rows", """
SELECT doc_id, source FROM documents ORDER BY doc_id LIMIT 500""")
def head_rows(spark, sf_dir):
    # the first-N feature
    d = table(spark, sf_dir, "documents").select("doc_id", "source")
    return O.head_rows(d, 500, ["doc_id"])


@register("global_index", """
SELECT doc_id, (row_number() OVER (ORDER BY n_chars DESC, doc_id) - 1)::BIGINT AS g FROM documents""")
def global_index(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    d = d.withColumn("_long_first", -F.col("n_chars"))
    return O.with_global_index(d, ["_long_first", "doc_id"], "g").select("doc_id", "g")


def _pack_sql():
    return f"""
WITH d AS (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) AS g,
                  list_append({_cp_sql('text')}, {EOS_ID}) AS ids FROM documents),
n AS (SELECT count(*) AS n, count(*) // {SHARDS} AS dv, count(*) % {SHARDS} AS md FROM d),
sb AS (
  SELECT d.*, CASE WHEN g < (dv + 1) * md THEN g // (dv + 1) ELSE md + (g - (dv + 1) * md) // dv END AS shard,
         dv, md FROM d, n),
sb2 AS (
  SELECT *, (g - CASE WHEN shard < md THEN shard * (dv + 1) ELSE (dv + 1) * md + (shard - md) * dv END)
            // {BATCH_DOCS} AS batch FROM sb),
t AS (SELECT shard, batch, g, u.c, u.k FROM sb2, unnest(ids) WITH ORDINALITY AS u(c, k)),
p AS (SELECT *, row_number() OVER (PARTITION BY shard, batch ORDER BY g, k) - 1 AS p,
             count(*) OVER (PARTITION BY shard, batch) AS tot FROM t),
kept AS (SELECT *, p // {BLOCK} AS block_idx, p % {BLOCK} AS q FROM p
         WHERE p < CASE WHEN tot >= {BLOCK} THEN tot // {BLOCK} * {BLOCK} ELSE tot END)
SELECT shard::BIGINT AS shard, batch::BIGINT AS batch, block_idx::BIGINT AS block_idx,
       count(*)::BIGINT AS n_tokens, sum(c)::BIGINT AS tok_sum,
       sum(c::BIGINT * (q + 1))::BIGINT AS tok_wsum,
       arg_min(c, q)::BIGINT AS first_tok, arg_max(c, q)::BIGINT AS last_tok
FROM kept GROUP BY shard, batch, block_idx"""


@register("pack_blocks", _pack_sql())
def pack_blocks(spark, sf_dir):
    """Blocks of code points: the form that SQL can follow; ``pack_blocks_bpe`` has the
    tokenizer's ids."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    # ids are made behind the index, so only the packing's own exchange moves arrays
    d = O.with_global_index(d, ["doc_id"], "g", total="n")
    return _packed(d.withColumn("ids", P.append_eos(P.code_point_ids("text"), EOS_ID)).drop("text"))


# The keys with SQL keep code points as ids; the *_bpe keys use the published vocabulary
@register("pack_blocks_bpe")
def pack_blocks_bpe(spark, sf_dir):
    """``pack_blocks`` over the tokenizer's ids."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    # the index first: its own jobs would encode the corpus again
    d = O.with_global_index(d, ["doc_id"], "g", total="n")
    return _packed(P.tokenize(d, published_merges(spark), ["g", "n"], EOS_ID))


def _packed(d):
    b = P.pack(d, "ids", "g", "n", BLOCK, BATCH_DOCS, SHARDS)
    ids = F.col("input_ids")
    return b.select(
        "shard", "batch", "block_idx",
        F.size(ids).cast("long").alias("n_tokens"),
        F.aggregate(ids, F.lit(0).cast("long"), lambda a, x: a + x).alias("tok_sum"),
        F.aggregate(F.transform(ids, lambda x, i: x.cast("long") * (i + 1)), F.lit(0).cast("long"),
                    lambda a, x: a + x).alias("tok_wsum"),
        F.element_at(ids, 1).cast("long").alias("first_tok"),
        F.element_at(ids, -1).cast("long").alias("last_tok"))


def _mask_sql():
    prefix = "[" + ", ".join(str(ord(c)) for c in POEM_PREFIX) + "]::INTEGER[]"
    ids = f"list_concat({prefix}, {_cp_sql('text')}, [{EOS_ID}]::INTEGER[])"
    return f"""
WITH s AS (SELECT conv_id, turn, {ids}[1:{MAX_LEN}] AS t FROM conversations),
p AS (SELECT conv_id, turn, len(t) AS n,
             list_concat(t, list_transform(range({MAX_LEN} - len(t)), lambda x: {EOS_ID})) AS ids FROM s)
SELECT conv_id, turn,
       array_to_string(ids, ',') AS input_ids,
       array_to_string(list_transform(ids, lambda x, i: CASE WHEN i <= n THEN 1 ELSE 0 END), ',') AS attention_mask,
       array_to_string(list_transform(ids, lambda x, i: CASE WHEN i <= {len(POEM_PREFIX)} OR i > n
                                                          THEN -100 ELSE x END), ',') AS labels
FROM p"""


@register("mask_labels", _mask_sql())
def mask_labels(spark, sf_dir):
    """Samples of code points: the form that SQL can follow; ``mask_labels_bpe`` has the
    tokenizer's ids."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    prefix_ids = F.array(*[F.lit(ord(ch)) for ch in POEM_PREFIX])
    ids = F.concat(prefix_ids, P.append_eos(P.code_point_ids("text"), EOS_ID))
    return _masked(c.withColumn("_ids", ids), len(POEM_PREFIX))


def _wrapped(c, merges, key):
    """(samples with ``ids`` of prefix, text and EOS as one string; ids of the prefix)."""
    ids = B.encode(c.withColumn("_s", wrap_sample("text", POEM_PREFIX, B.SPECIAL)), merges, key, "_s")
    prefix = c.sparkSession.createDataFrame([(POEM_PREFIX,)], "text string")
    return ids, len(B.encode(prefix, merges, []).first()["ids"])


@register("mask_labels_bpe")
def mask_labels_bpe(spark, sf_dir):
    """``mask_labels`` over the tokenizer's ids."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    ids, prefix_len = _wrapped(c, published_merges(spark), ["conv_id", "turn"])
    return _masked(ids.withColumnRenamed("ids", "_ids"), prefix_len)


def _masked(c, prefix_len):
    inp, att, lab = P.pad_and_mask(F.col("_ids"), MAX_LEN, prefix_len, EOS_ID)
    return c.select("conv_id", "turn", F.array_join(inp, ",").alias("input_ids"),
                    F.array_join(att, ",").alias("attention_mask"),
                    F.array_join(lab, ",").alias("labels"))


@register("stage2_token_stats", f"""
WITH k AS (
  SELECT conv_id, turn, sha256('{SEED}:' || conv_id::VARCHAR || ':' || turn::VARCHAR) AS shuffle_key,
         {len(POEM_PREFIX)} + length(nfc_normalize(coalesce(text, ''))) + 1 AS n_tok FROM conversations),
i AS (SELECT *, row_number() OVER (ORDER BY shuffle_key) - 1 AS g, count(*) OVER () AS n FROM k),
s AS (SELECT *, CASE WHEN g < ceil(0.1 * n) THEN 'eval' ELSE 'train' END AS split FROM i)
SELECT split, count(*)::BIGINT AS samples, sum(least(n_tok, {MAX_LEN}))::BIGINT AS tokens,
       (sum(least(n_tok, {MAX_LEN})) * CASE WHEN split = 'train' THEN {A.STAGE2_EPOCHS} ELSE 1 END)::BIGINT
         AS tokens_all_epochs
FROM s GROUP BY split""")
def stage2_token_stats(spark, sf_dir):
    """Code points per split: the form that SQL can follow; ``stage2_token_stats_bpe`` counts
    the tokenizer's ids."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    c = c.withColumn("n_tok", F.lit(len(POEM_PREFIX)) + F.length(nfc("text")) + F.lit(1))
    s = M.split_exact(c, 0.1, SEED, ["conv_id", "turn"])
    return A.sample_token_stats(s, "n_tok")


@register("stage2_token_stats_bpe")
def stage2_token_stats_bpe(spark, sf_dir):
    """``stage2_token_stats`` over the tokenizer's ids."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    s = M.split_exact(c, 0.1, SEED, ["conv_id", "turn"]).select("split", "text")
    ids, _ = _wrapped(s, published_merges(spark), ["split"])
    return A.sample_token_stats(ids.withColumn("n_tok", F.size("ids")), "n_tok")


def _log(spark, sf_dir):
    """events as a training log: event_id = step, value = loss for 'view',
    eval loss for 'click', user_id = run."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").alias("run"), F.col("event_id").alias("step"),
                    F.when(F.col("event_type") == "view", F.col("value")).alias("loss"),
                    F.when(F.col("event_type") == "click", F.col("value")).alias("eval_loss"))


_LOG_SQL = """SELECT user_id AS run, event_id AS step,
  CASE WHEN event_type = 'view' THEN value END AS loss,
  CASE WHEN event_type = 'click' THEN value END AS eval_loss FROM events"""


@register("perplexity_log", f"""
SELECT run, step, loss, eval_loss,
       CASE WHEN isinf(exp(loss)) THEN 'inf' ELSE printf('%.11e', exp(loss)) END AS train_perplexity,
       CASE WHEN isinf(exp(eval_loss)) THEN 'inf' ELSE printf('%.11e', exp(eval_loss)) END AS eval_perplexity
FROM ({_LOG_SQL})""")
def perplexity_log(spark, sf_dir):
    # reported with 12 significant digits: JVM and C exp() may differ in the last ulp
    p = A.with_perplexity(_log(spark, sf_dir))

    def sci(c):
        return (F.when(F.col(c).isNull(), F.lit(None))
                .when(F.col(c) == float("inf"), F.lit("inf")).otherwise(F.format_string("%.11e", c)))

    return (p.withColumn("train_perplexity", sci("train_perplexity"))
            .withColumn("eval_perplexity", sci("eval_perplexity")))


@register("best_checkpoint", f"""
WITH l AS ({_LOG_SQL}),
ev AS (SELECT * FROM l WHERE eval_loss IS NOT NULL),
b AS (SELECT run, arg_min(step, (eval_loss, step)) AS best_step, min(eval_loss) AS best_eval_loss
      FROM ev GROUP BY run),
la AS (SELECT run, max(step) AS last_step FROM l GROUP BY run),
k AS (SELECT run, list_sort(list(step)) AS kept_steps FROM (
        SELECT run, step, row_number() OVER (PARTITION BY run ORDER BY step DESC) AS r FROM ev)
      WHERE r <= 3 GROUP BY run)
SELECT b.run, best_step, best_eval_loss, last_step, array_to_string(kept_steps, ',') AS kept_steps
FROM b JOIN la USING (run) JOIN k USING (run)""")
def best_checkpoint(spark, sf_dir):
    c = A.checkpoints(_log(spark, sf_dir), run="run", keep=3)
    return c.withColumn("kept_steps", F.array_join("kept_steps", ","))


@register("step_budget", f"""
SELECT source, sum(length(nfc_normalize(coalesce(text, ''))) + 1)::BIGINT AS tokens,
       (sum(length(nfc_normalize(coalesce(text, ''))) + 1) // {8 * 16 * 2 * 1024})::BIGINT AS max_steps,
       {8 * 16 * 2 * 1024}::BIGINT AS tokens_per_step
FROM documents GROUP BY source""")
def step_budget(spark, sf_dir):
    """Steps by code points: the form that SQL can follow; ``step_budget_bpe`` counts the
    tokenizer's ids."""
    d = table(spark, sf_dir, "documents")
    return _steps(d.groupBy("source").agg(F.sum(F.length(nfc("text")) + 1).cast("long").alias("tokens")))


@register("step_budget_bpe")
def step_budget_bpe(spark, sf_dir):
    """``step_budget`` over the tokenizer's ids and one EOS per document."""
    d = table(spark, sf_dir, "documents").select("source", "text")
    d = P.tokenize(d, published_merges(spark), ["source"], EOS_ID)
    return _steps(d.groupBy("source").agg(F.sum(F.size("ids")).cast("long").alias("tokens")))


def _steps(t):
    steps, per = A.step_budget("tokens")
    return t.select("source", "tokens", steps.alias("max_steps"), per.alias("tokens_per_step"))


def _size_sql(x):
    b = f"({x})::DOUBLE"
    return (f"CASE WHEN {b} < 1024 THEN printf('%.2f B', {b}) "
            f"WHEN {b} < 1024^2 THEN printf('%.2f KB', {b} / 1024) "
            f"WHEN {b} < 1024^3 THEN printf('%.2f MB', {b} / 1024^2) "
            f"WHEN {b} < 1024^4 THEN printf('%.2f GB', {b} / 1024^3) "
            f"ELSE printf('%.2f TB', {b} / 1024^4) END")


@register("format_size", f"""
SELECT source, sum(octet_length(encode(text)))::BIGINT AS bytes,
       {_size_sql('sum(octet_length(encode(text)))')} AS size,
       {_size_sql('sum(octet_length(encode(text))) * 1048576')} AS size_scaled
FROM documents GROUP BY source""")
def format_size_q(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    t = d.groupBy("source").agg(F.sum(F.octet_length("text")).cast("long").alias("bytes"))
    return t.select("source", "bytes", format_size("bytes").alias("size"),
                    format_size(F.col("bytes") * F.lit(1048576)).alias("size_scaled"))


_PROMPT_SQL = f"""
WITH mt AS (SELECT conv_id, max(turn) AS mt FROM conversations WHERE role = 'user' GROUP BY conv_id),
l AS (
  SELECT c.conv_id, c.turn, c.text, mt.mt,
         CASE WHEN c.turn = mt.mt THEN 'User: ' || {sql_strip("coalesce(c.text, '')")}
              WHEN c.role = 'user' THEN 'User: ' || {sql_strip("coalesce(c.text, '')")}
              ELSE 'Assistant: ' || {sql_strip("coalesce(c.text, '')")} END AS line
  FROM conversations c JOIN mt USING (conv_id) WHERE c.turn <= mt.mt)
SELECT conv_id, max(CASE WHEN turn = mt THEN text END) AS message,
       (count(*) - 1)::BIGINT AS history_turns,
       string_agg(line, chr(10) ORDER BY turn) || chr(10) || 'Assistant:' AS prompt
FROM l GROUP BY conv_id"""


@register("prompt_assembly", _PROMPT_SQL)
def prompt_assembly(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    p = C.build_prompts(c)
    return p.withColumn("history_turns", F.col("history_turns").cast("long"))


@register("mock_reply", f"""
WITH p AS ({_PROMPT_SQL})
SELECT conv_id, '{C.MOCK_PREFIX}' || message AS reply, 'mock' AS backend,
       {sql_strip("substr(prompt || ' xin chào', length(prompt) + 1)")} AS model_reply
FROM p""")
def mock_reply(spark, sf_dir):
    p = C.build_prompts(table(spark, sf_dir, "conversations"))
    mock = C.generate(p)
    model = C.generate(p, C.echo_model).select("conv_id", F.col("reply").alias("model_reply"))
    return mock.select("conv_id", "reply", "backend").join(model, "conv_id")


@register("turn_validation", f"""
SELECT conv_id, turn,
       (coalesce(role IN ('user', 'assistant', 'system'), false) AND text IS NOT NULL
        AND length(text) BETWEEN 1 AND {C.MAX_CONTENT}) AS is_valid,
       array_to_string(list_filter([
         CASE WHEN NOT coalesce(role IN ('user', 'assistant', 'system'), false) THEN 'bad_role' END,
         CASE WHEN text IS NULL OR length(text) < 1 THEN 'empty_content' END,
         CASE WHEN length(text) > {C.MAX_CONTENT} THEN 'content_too_long' END], lambda x: x IS NOT NULL), ',')
         AS reasons
FROM conversations""")
def turn_validation(spark, sf_dir):
    c = C.validate_turns(table(spark, sf_dir, "conversations"))
    return c.select("conv_id", "turn", "is_valid", F.array_join("reasons", ",").alias("reasons"))


_REQUEST_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, CASE WHEN (conv_id + turn) % 13 = 5 THEN 'tool' ELSE role END AS role,
         CASE WHEN (conv_id + 3 * turn) % 17 = 2 THEN '' WHEN (conv_id + 5 * turn) % 19 = 3 THEN repeat(text, 40)
              ELSE text END AS content
  FROM conversations),
last AS (SELECT conv_id, max(turn) AS mt FROM conversations WHERE role = 'user' GROUP BY conv_id),
r AS (
  SELECT l.conv_id, any_value(m.content) AS message, l.conv_id % 600 AS mnt, (l.conv_id % 24) / 10.0::DOUBLE AS tmp,
         coalesce(list({{'i': t.turn, 'role': t.role, 'content': t.content}} ORDER BY t.turn)
                  FILTER (WHERE t.turn IS NOT NULL), []) AS history
  FROM last l JOIN t m ON m.conv_id = l.conv_id AND m.turn = l.mt LEFT JOIN t ON t.conv_id = l.conv_id AND t.turn < l.mt
  GROUP BY l.conv_id),
b AS (
  SELECT *, list_filter(list_transform(history, lambda x, k: {{'i': k - 1, 'reason':
    CASE WHEN NOT coalesce(x.role IN ('user', 'assistant', 'system'), false) THEN 'bad_role'
         WHEN x.content IS NULL OR length(x.content) < 1 THEN 'empty_content'
         WHEN length(x.content) > {C.MAX_CONTENT} THEN 'content_too_long' END}}), lambda x: x.reason IS NOT NULL) AS bad
  FROM r),
v AS (
  SELECT *, list_filter([
    CASE WHEN message IS NULL OR length(message) < 1 THEN 'empty_message' END,
    CASE WHEN length(message) > {C.MAX_CONTENT} THEN 'message_too_long' END,
    CASE WHEN len(bad) > 0 THEN 'bad_history' END,
    CASE WHEN coalesce(nullif(mnt, 7), 128) NOT BETWEEN 1 AND 512 THEN 'bad_max_new_tokens' END,
    CASE WHEN coalesce(nullif(tmp, 1.1), 0.8) NOT BETWEEN 0.1 AND 2.0 THEN 'bad_temperature' END],
    lambda x: x IS NOT NULL) AS reasons FROM b)
SELECT conv_id, len(history)::BIGINT AS turns, len(reasons) = 0 AS is_valid, array_to_string(reasons, ',') AS reasons,
       array_to_string(list_transform(bad, lambda x: x.i::VARCHAR || ':' || x.reason), ',') AS bad_turns FROM v"""


@register("request_validation", _REQUEST_SQL)
def request_validation(spark, sf_dir):
    """F8 over whole requests: a request per conversation (its last user turn, and the
    turns before it as history), with faults put into roles, contents and numbers."""
    t = table(spark, sf_dir, "conversations")
    c, n = F.col("conv_id"), F.col("turn")
    t = t.select("conv_id", "turn", F.col("role").alias("_role"),
                 F.when((c + n) % 13 == 5, F.lit("tool")).otherwise(F.col("role")).alias("role"),
                 F.when((c + 3 * n) % 17 == 2, F.lit("")).when((c + 5 * n) % 19 == 3, F.repeat("text", F.lit(40)))
                 .otherwise(F.col("text")).alias("content"))
    last = t.filter("_role = 'user'").groupBy("conv_id").agg(F.max("turn").alias("_mt"))
    past = F.array_sort(F.collect_list(F.when(n < F.col("_mt"), F.struct("turn", "role", "content"))))
    r = t.join(last, "conv_id").filter(n <= F.col("_mt")).groupBy("conv_id").agg(
        F.max(F.when(n == F.col("_mt"), F.col("content"))).alias("message"), past.alias("_past"))
    r = r.select("conv_id", "message", F.transform("_past", lambda x: F.struct(x["role"], x["content"])).alias("history"),
                 F.nullif(c % 600, F.lit(7)).cast("int").alias("max_new_tokens"),
                 F.nullif((c % 24) / F.lit(10.0), F.lit(1.1)).alias("temperature"))
    v = C.validate_requests(r)
    return v.select("conv_id", F.size("history").cast("long").alias("turns"), "is_valid",
                    F.array_join("reasons", ",").alias("reasons"),
                    F.array_join(F.transform("bad_turns", lambda x: F.concat(x["i"].cast("string"), F.lit(":"), x["reason"])),
                                 ",").alias("bad_turns"))


@register("strip_generated_prefix", f"""
SELECT conv_id, turn,
       CASE WHEN starts_with(text, 'Ét') THEN {sql_strip("substr(text, 3)")} ELSE text END AS stripped
FROM conversations""")
def strip_generated_prefix(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", strip_prefix("text", "Ét").alias("stripped"))


def _train_blocks_sql():
    return f"""
WITH sp AS ({_SPLIT_SQL}),
k AS (SELECT count(*) AS k FROM sp WHERE split = 'eval'),
s AS (SELECT sp.doc_id, sp.split, CASE WHEN split = 'eval' THEN g ELSE g - k.k END AS g FROM sp, k),
d AS (SELECT s.split, s.g, list_append({_cp_sql('documents.text')}, {EOS_ID}) AS ids
      FROM s JOIN documents USING (doc_id)),
n AS (SELECT split, count(*) // {SHARDS} AS dv, count(*) % {SHARDS} AS md FROM d GROUP BY split),
sb AS (
  SELECT d.*, n.dv, n.md,
         CASE WHEN g < (dv + 1) * md THEN g // (dv + 1) ELSE md + (g - (dv + 1) * md) // dv END AS shard
  FROM d JOIN n USING (split)),
sb2 AS (
  SELECT *, (g - CASE WHEN shard < md THEN shard * (dv + 1) ELSE (dv + 1) * md + (shard - md) * dv END)
            // {BATCH_DOCS} AS batch FROM sb),
t AS (SELECT split, shard, batch, g, u.c, u.k FROM sb2, unnest(ids) WITH ORDINALITY AS u(c, k)),
p AS (SELECT *, row_number() OVER (PARTITION BY split, shard, batch ORDER BY g, k) - 1 AS p,
             count(*) OVER (PARTITION BY split, shard, batch) AS tot FROM t),
kept AS (SELECT split, shard, batch, p // {BLOCK} AS block_idx FROM p
         WHERE p < CASE WHEN tot >= {BLOCK} THEN tot // {BLOCK} * {BLOCK} ELSE tot END),
b AS (SELECT split, shard, batch, block_idx, count(*) AS n_tokens FROM kept
      GROUP BY split, shard, batch, block_idx)
SELECT split, count(*)::BIGINT AS blocks, (count(*) * {BLOCK})::BIGINT AS tokens,
       sum(n_tokens)::BIGINT AS real_tokens
FROM b GROUP BY split"""


@register("train_blocks", _train_blocks_sql())
def train_blocks(spark, sf_dir):
    """Stage-1 training-set build: weighted mixture -> seeded exact split ->
    tokenise (code points + EOS) -> pack each split into 1024-token blocks ->
    blocks per split (A8).  The form that SQL can follow; ``train_blocks_bpe`` has the
    tokenizer's ids."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    s = _mixture(spark, d).join(d.select("doc_id", "text"), "doc_id")
    return _split_blocks(s.withColumn("ids", P.append_eos(P.code_point_ids("text"), EOS_ID)))


@register("train_blocks_bpe")
def train_blocks_bpe(spark, sf_dir):
    """``train_blocks`` over the tokenizer's ids; a document is encoded once for all its copies."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return _split_blocks(_mixture(spark, d).join(P.tokenize(d, published_merges(spark), ["doc_id"], EOS_ID), "doc_id"))


def _mixture(spark, d):
    return M.training_mixture(d.select("doc_id", "source"), fixture_registry(spark), SEED, EVAL_RATIO,
                              ["source", "doc_id"], size_col="n_split")


def _split_blocks(s):
    s = s.select("split", "n_split_pos", "n_split", "ids")
    # one plan, no driver-side counts: each row carries its split's size
    blocks = P.pack(s, "ids", "n_split_pos", "n_split", BLOCK, BATCH_DOCS, SHARDS, group_cols=("split",))
    # both totals from one pass over the blocks
    return P.block_stats(blocks, BLOCK, real="real_tokens")
