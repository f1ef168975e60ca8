"""Conversation batch jobs: request validation, prompt assembly, mock reply,
batch generation with a pluggable model (``mapInPandas``), reply extraction."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import extract_reply, nfc, ustrip

# Fixed values (request limits and the offline reply of the chat service).
ROLES = ("user", "assistant", "system")
MAX_CONTENT = 4000
MAX_NEW_TOKENS = (1, 512, 128)       # min, max, default
TEMPERATURE = (0.1, 2.0, 0.8)        # min, max, default
MOCK_PREFIX = "(mock) Bạn vừa nói: "


def validate_turns(df: DataFrame, role: str = "role", text: str = "text") -> DataFrame:
    """F8 for conversation turns: adds ``is_valid`` and ``reasons`` (array)."""
    n = F.length(F.col(text))
    reasons = F.array_compact(F.array(
        F.when(~F.coalesce(F.col(role).isin(*ROLES), F.lit(False)), F.lit("bad_role")),
        F.when(F.col(text).isNull() | (n < 1), F.lit("empty_content")),
        F.when(n > MAX_CONTENT, F.lit("content_too_long"))))
    return df.withColumn("reasons", reasons).withColumn("is_valid", F.size("reasons") == 0)


def _content_reason(role, text):
    """Why a turn is refused, or null: a turn has the first reason that holds."""
    n = F.length(text)
    return (F.when(~F.coalesce(role.isin(*ROLES), F.lit(False)), F.lit("bad_role"))
            .when(text.isNull() | (n < 1), F.lit("empty_content"))
            .when(n > MAX_CONTENT, F.lit("content_too_long")))


def validate_requests(df: DataFrame) -> DataFrame:
    """F8 for request rows ``(message, history array<struct<role, content>>,
    max_new_tokens, temperature)``: defaults filled by ``coalesce`` (a null or missing
    history is empty), ``is_valid``, ``reasons`` and ``bad_turns`` array<struct<i, reason>>: every
    turn of the history, however deep, that is refused."""
    mnt = F.coalesce(F.col("max_new_tokens"), F.lit(MAX_NEW_TOKENS[2]))
    tmp = F.coalesce(F.col("temperature"), F.lit(TEMPERATURE[2]))
    n = F.length("message")
    turns = F.array().cast("array<struct<role: string, content: string>>")
    past = F.coalesce(F.col("history"), F.array().cast(df.schema["history"].dataType)) if "history" in df.columns else turns
    judged = F.transform(past, lambda t, i: F.struct(
        i.cast("int").alias("i"), _content_reason(t["role"], t["content"]).alias("reason")))
    reasons = F.array_compact(F.array(
        F.when(F.col("message").isNull() | (n < 1), F.lit("empty_message")),
        F.when(n > MAX_CONTENT, F.lit("message_too_long")),
        F.when(F.size("bad_turns") > 0, F.lit("bad_history")),
        F.when((mnt < MAX_NEW_TOKENS[0]) | (mnt > MAX_NEW_TOKENS[1]), F.lit("bad_max_new_tokens")),
        F.when((tmp < TEMPERATURE[0]) | (tmp > TEMPERATURE[1]), F.lit("bad_temperature"))))
    return (df.withColumn("bad_turns", F.filter(judged, lambda t: t["reason"].isNotNull()))
            .withColumn("max_new_tokens", mnt).withColumn("temperature", tmp)
            .withColumn("reasons", reasons).withColumn("is_valid", F.size("reasons") == 0))


def build_prompts(turns: DataFrame, conv: str = "conv_id", turn: str = "turn",
                  role: str = "role", text: str = "text") -> DataFrame:
    """One prompt per conversation.  ``message`` = the last user turn,
    ``history`` = the turns before it (later turns ignored).  Lines:
    ``User: ...`` for user turns, ``Assistant: ...`` for any other role,
    contents stripped; then ``User: <message>`` and a bare ``Assistant:``.
    Conversations without a user turn yield no prompt.

    Each line is formatted row-wise first; the per-conversation step only
    orders and concatenates the already formatted lines."""
    t = turns.select(conv, turn, role, text)
    last_user = (t.filter(F.col(role) == "user").groupBy(conv)
                 .agg(F.max(turn).alias("_mt")))
    speaker = F.when(F.col(role) == "user", F.lit("User: ")).otherwise(F.lit("Assistant: "))
    lines = (t.join(last_user, conv)
             .filter(F.col(turn) <= F.col("_mt"))
             .withColumn("_line", F.when(F.col(turn) == F.col("_mt"),
                                         F.concat(F.lit("User: "), ustrip(F.coalesce(text, F.lit("")))))
                         .otherwise(F.concat(speaker, ustrip(F.coalesce(text, F.lit("")))))))
    agg = lines.groupBy(conv).agg(
        F.array_sort(F.collect_list(F.struct(F.col(turn).alias("t"), F.col("_line").alias("l")))).alias("_ls"),
        F.max(F.when(F.col(turn) == F.col("_mt"), F.col(text))).alias("message"),
        F.count(F.lit(1)).alias("n_lines"))
    prompt = F.concat(F.array_join(F.transform("_ls", lambda x: x["l"]), "\n"), F.lit("\nAssistant:"))
    return agg.select(conv, "message", (F.col("n_lines") - 1).alias("history_turns"), prompt.alias("prompt"))


def mock_reply(message) -> tuple:
    """The offline reply and backend name."""
    m = F.col(message) if isinstance(message, str) else message
    return F.concat(F.lit(MOCK_PREFIX), m), F.lit("mock")


def generate(df: DataFrame, model_fn: Callable[[list[str]], list[list[str]]] | None = None,
             prompt: str = "prompt", message: str = "message", k: int = 1) -> DataFrame:
    """Batch generation.  ``model_fn`` maps a list of prompts to ``k``
    generated texts each; it is created/used per partition inside
    ``mapInPandas`` (Arrow batches).  Without a model, the mock reply (C2).
    The reply is P17 (prompt cut by length, stripped, fallback full text)."""
    if model_fn is None:
        reply, backend = mock_reply(message)
        return df.withColumn("reply", reply).withColumn("backend", backend)

    schema = T.StructType(list(df.schema.fields) + [T.StructField("seq", T.IntegerType()),
                                                    T.StructField("generated", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import unicodedata
        for b in batches:
            prompts = [unicodedata.normalize("NFC", p or "") for p in b[prompt]]
            idx, seqs, outs = [], [], []
            for r, gens in enumerate(model_fn(prompts)):
                for j, g in enumerate(gens[:k]):
                    idx.append(r)
                    seqs.append(j)
                    outs.append(g)
            o = b.iloc[idx].reset_index(drop=True)
            o["seq"] = seqs
            o["generated"] = outs
            yield o

    out = df.mapInPandas(run, schema)
    return (out.withColumn("reply", extract_reply(F.col("generated"), nfc(F.col(prompt))))
            .withColumn("backend", F.lit("model")))


def echo_model(prompts: list[str]) -> list[list[str]]:
    """Deterministic test model: echoes the prompt and appends a fixed reply."""
    return [[p + " xin chào"] for p in prompts]
