"""Token audits and training-log reports: weighted token audit against a
budget, step budget, metric-log perplexity, best/last checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import perplexity

# Stage-1 training configuration.
TOKEN_BUDGET = 2_480_000_000
BLOCK = 1024
BATCH_PER_DEVICE = 8
GRAD_ACCUM = 16
N_GPUS = 2
STAGE2_MAX_LEN = 64
STAGE2_EPOCHS = 20


def token_audit(counts: DataFrame, registry: DataFrame, budget: int = TOKEN_BUDGET) -> DataFrame:
    """A4: ``counts(source, tokens)`` -> per source tokens, weight (default 1),
    weighted tokens, plus the run-wide columns (unique, effective, budget,
    repeat factor = round(budget/unique, 2) or null, enough, gap)."""
    w = registry.select("source", F.col("weight").alias("_w"))
    per = (counts.join(w, "source", "left")
           .withColumn("weight", F.coalesce("_w", F.lit(1)).cast("long")).drop("_w")
           .withColumn("weighted_tokens", F.col("tokens") * F.col("weight")))
    # ``per`` has one row per source (bounded by the registry), so the run-wide
    # totals are a window over it: the counts are computed once, not per branch.
    allw = Window.partitionBy()
    out = (per.withColumn("unique_tokens", F.sum("tokens").over(allw).cast("long"))
           .withColumn("effective_tokens_with_weights", F.sum("weighted_tokens").over(allw).cast("long")))
    return (out.withColumn("token_budget", F.lit(budget).cast("long"))
            .withColumn("repeat_factor", F.when(F.col("unique_tokens") > 0,
                                                F.bround(F.lit(float(budget)) / F.col("unique_tokens"), 2)))
            .withColumn("enough_for_budget", F.col("effective_tokens_with_weights") >= F.lit(budget))
            .withColumn("budget_gap_or_surplus", F.col("effective_tokens_with_weights") - F.lit(budget)))


def step_budget(budget_tokens, batch: int = BATCH_PER_DEVICE, accum: int = GRAD_ACCUM,
                gpus: int = N_GPUS, block: int = BLOCK):
    """Max optimizer steps = budget // (batch * accum * gpus * block)."""
    per_step = batch * accum * gpus * block
    c = F.col(budget_tokens) if isinstance(budget_tokens, str) else budget_tokens
    return F.floor(c / F.lit(per_step)).cast("long"), F.lit(per_step).cast("long")


def with_perplexity(log: DataFrame, loss: str = "loss", eval_loss: str = "eval_loss") -> DataFrame:
    """``train_perplexity`` where ``loss`` is present, ``eval_perplexity``
    where ``eval_loss`` is present (null otherwise)."""
    return (log.withColumn("train_perplexity", perplexity(loss))
            .withColumn("eval_perplexity", perplexity(eval_loss)))


def checkpoints(log: DataFrame, run: str | None = None, step: str = "step",
                eval_loss: str = "eval_loss", keep: int = 3) -> DataFrame:
    """A10: per run, the best checkpoint (lowest eval loss; earliest step on a
    tie), the last step, and the steps of the newest ``keep`` evaluations.

    The newest steps are ``row_number() <= keep`` per run, which Spark limits
    before the shuffle, so a run holding most of the log sends a few rows per task."""
    keys = [run] if run else ["_run"]
    if not run:
        log = log.withColumn("_run", F.lit(0))
    ev = log.filter(F.col(eval_loss).isNotNull())
    best = ev.groupBy(*keys).agg(F.min(F.struct(eval_loss, step)).alias("_b"))
    last = log.groupBy(*keys).agg(F.max(step).alias("last_step"))
    w = Window.partitionBy(*keys).orderBy(F.col(step).desc())
    newest = (ev.groupBy(*keys, step).agg(F.lit(1)).select(*keys, step)
              .withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= keep)
              .groupBy(*keys).agg(F.array_sort(F.collect_list(step)).alias("kept_steps")))
    out = (best.select(*keys, F.col(f"_b.{step}").alias("best_step"),
                       F.col(f"_b.{eval_loss}").alias("best_eval_loss"))
           .join(last, keys).join(newest, keys))
    return out if run else out.drop("_run")


def sample_token_stats(df: DataFrame, len_col: str, split_col: str = "split",
                       max_len: int = STAGE2_MAX_LEN, epochs: int = STAGE2_EPOCHS) -> DataFrame:
    """Per split, samples and sum of min(tokens, max_len); train tokens
    over all epochs."""
    agg = df.groupBy(split_col).agg(
        F.count(F.lit(1)).alias("samples"),
        F.sum(F.least(F.col(len_col), F.lit(max_len))).cast("long").alias("tokens"))
    return agg.withColumn("tokens_all_epochs",
                          F.when(F.col(split_col) == "train", F.col("tokens") * epochs)
                          .otherwise(F.col("tokens")).cast("long"))
