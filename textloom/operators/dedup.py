"""Exact document and paragraph deduplication, keep-first, with audit.

Order matters in the reference (a sequential scan with grow-only "seen" sets),
but every decision is "is this the first occurrence of its key?", so each
stage is a keyed ``min(struct(order))`` aggregation with partial (map-side)
aggregation: a hash that holds a third of all rows is pre-combined on every mapper.

The three stages are decided on one narrow table, written once to the shared folder:
positions, the hash of the raw text, and per paragraph its hash and length.  It is made
in one scan with one NFC pass; no decision needs the text.  The key of a cleaned text is
a hash over the hashes of its pieces between separators, so a text that loses paragraphs
gets its key from the pieces that stay.  Decisions meet the text once, by
``(source_rank, pos)``; reports never do.

Stage semantics (status per document, in order):
``empty -> raw_dup -> (para_changed flag) -> too_short -> final_dup -> kept``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import WS_CHARS, doc_hash, nfc, ustrip
from .staging import Staging, join_split

KEY = ["source_rank", "pos"]


def _split_regex(sep: str) -> str:
    return re.escape(sep) if sep not in ("\n", "\n\n") else sep.replace("\n", "\\n")


def first_by_order(df: DataFrame, key: str | list[str], order: list[str], flag: str) -> DataFrame:
    """Winners of keep-first: one row per key with the smallest ``order`` tuple,
    projected as ``order + [flag=True]`` (keyed by the order columns)."""
    keys = [key] if isinstance(key, str) else list(key)
    w = df.groupBy(*keys).agg(F.min(F.struct(*order)).alias("_w"))
    return w.select(*[F.col(f"_w.{c}").alias(c) for c in order], F.lit(True).alias(flag))


def dedup_exact(df: DataFrame, key: Column | str, order: list[str]) -> DataFrame:
    """Keep the first row (by ``order``) of every key.  ``order`` must be
    unique per row.  Key-only shuffle for the decision, one join back."""
    k = F.col(key) if isinstance(key, str) else key
    keyed = df.withColumn("_k", k)
    winners = first_by_order(keyed.select("_k", *order), "_k", order, "_first")
    return (df.join(winners, order, "left_semi"))


def _digest(text: Column) -> Column:
    """The first 128 bits of SHA-256 as hex: enough to tell all paragraphs of a corpus apart."""
    return F.left(F.sha2(text, 256), F.lit(32))


def _text_key(digests: Column) -> Column:
    """Key of a text from the hex digests of its pieces."""
    return F.unhex(_digest(F.array_join(digests, "")))


def fingerprint_table(base: DataFrame, sep: str) -> DataFrame:
    """One narrow row per row (source_rank, pos, para_dedup, text): ``empty``, ``raw``
    (hash of the text), and for the text with no paragraph dropped ``key``, ``len`` and
    ``changed`` (differs from the stripped text); ``pieces`` array<struct<i, len, h>>:
    the stripped, non-empty paragraphs of sources with paragraph dedup.

    ``sep`` is ASCII white space, which NFC neither makes nor joins to a neighbour: the
    pieces of the normalised text are the normalised pieces of the text."""
    if not sep or any(c not in WS_CHARS or ord(c) > 127 for c in sep):
        raise ValueError("the paragraph separator must be ASCII white space")
    cut = _split_regex(sep)
    rows = base.select(*KEY, "para_dedup", "text", nfc("text").alias("_n"))
    zipped = F.zip_with(F.split("text", cut, -1), F.split("_n", cut, -1), lambda t, n: F.struct(
        F.length(ustrip(t)).alias("len"), _digest(ustrip(n)).alias("x")))
    pieces = F.filter(F.transform(zipped, lambda p, i: F.struct(i.cast("int").alias("i"), p["len"].alias("len"), p["x"].alias("x"))),
                      lambda p: p["len"] > 0)
    rows = rows.withColumn("_p", F.when(F.col("para_dedup"), pieces))
    whole = F.transform(F.split(ustrip("_n"), cut, -1), _digest)
    joined = F.array_join(F.filter(F.transform(F.split("text", cut, -1), ustrip), lambda t: t != ""), sep)
    stripped = ustrip("text")
    return rows.select(
        *KEY, "para_dedup", (F.col("text") == "").alias("empty"), F.unhex(F.sha2("_n", 256)).alias("raw"),
        _text_key(F.when(F.col("para_dedup"), F.transform("_p", lambda p: p["x"])).otherwise(whole)).alias("key"),
        F.when(F.col("para_dedup"), _joined_length(F.col("_p"), sep)).otherwise(F.length(stripped)).alias("len"),
        (F.col("para_dedup") & (joined != stripped)).alias("changed"),
        F.transform("_p", lambda p: F.struct(p["i"].alias("i"), p["len"].alias("len"), F.unhex(p["x"]).alias("h"))).alias("pieces"))


def _joined_length(pieces: Column, sep: str) -> Column:
    total = F.aggregate(pieces, F.lit(0), lambda n, p: n + p["len"])
    return total + F.greatest(F.size(pieces) - 1, F.lit(0)) * len(sep)


def paragraph_drop_index(occ: DataFrame, run: Staging) -> DataFrame:
    """``occ``: (source_rank, pos, i, ph).  For each document the indices of its
    paragraphs that are not the first occurrence in their source, by ``(pos, paragraph
    index)``: ``(source_rank, pos, drop_idx array<int>)``.  Documents dropped later count
    too (the reference's order).  Only paragraphs that repeat are joined back, and those
    that very many documents hold are split off."""
    first = run.write(occ.groupBy("source_rank", "ph")
                      .agg(F.min(F.struct("pos", "i")).alias("_w"), F.count(F.lit(1)).alias("_n"))
                      .filter(F.col("_n") > 1))
    later = join_split(occ, first, ["source_rank", "ph"], "_n").filter(F.struct("pos", "i") != F.col("_w"))
    return later.groupBy(*KEY).agg(F.collect_list("i").alias("drop_idx"))


def rebuild_paragraphs(text: Column, drop_idx: Column, sep: str) -> Column:
    """Reassemble: split on ``sep``, strip each piece, leave out empty pieces and
    the listed ones, join with ``sep``, strip."""
    pieces = F.split(text, _split_regex(sep), -1)
    drop = F.coalesce(drop_idx, F.array().cast("array<int>"))
    left = F.filter(F.transform(pieces, lambda p, i: F.when(~F.array_contains(drop, i), ustrip(p))),
                    lambda p: p.isNotNull() & (p != F.lit("")))
    return ustrip(F.array_join(left, sep))


def _base(corpus: DataFrame, registry: DataFrame) -> DataFrame:
    """The corpus with its sources' ranks and flags; a source that the registry lacks is
    an error, not a row less."""
    reg = registry.select("source", "source_rank", "para_dedup")
    rows = corpus.drop("source_rank", "para_dedup").join(F.broadcast(reg), "source", "left")
    missing = F.raise_error(F.concat(F.lit("source not in the registry: "), F.coalesce("source", F.lit("null"))))
    return rows.select("source", F.coalesce("source_rank", missing.cast("int")).alias("source_rank"), "pos", "para_dedup",
                       F.coalesce("text", F.lit("")).alias("text"))


def dedup_decisions(corpus: DataFrame, registry: DataFrame, para_sep: str = "\n\n",
                    min_para_chars: int = 50, min_doc_chars: int = 20) -> DataFrame:
    """X4 decisions, one narrow row per document: ``(source, source_rank, pos, status,
    para_changed, drop_idx)``; ``drop_idx``: indices of the paragraphs to leave out, null
    if none.  Written to the shared folder, so that outputs and reports share it.

    ``corpus``: ``(source, pos, text)``, pos unique in its source.  ``registry``:
    ``(source, source_rank, para_dedup, ...)``; every source of the corpus must be in it.
    """
    run = Staging(corpus.sparkSession, "dedup")
    d = run.write(fingerprint_table(_base(corpus, registry), para_sep))

    # Stage 1: global exact dedup on the raw text (empty rows never enter).
    w1 = first_by_order(d.filter(~F.col("empty")).select("raw", *KEY), "raw", KEY, "first_raw")

    # Stage 2: per-source paragraph dedup over stage-1 survivors.
    para = (d.filter(F.col("para_dedup") & (F.size("pieces") > 0)).select(*KEY, "pieces")
            .join(w1.select(*KEY), KEY, "left_semi"))
    occ = (para.select(*KEY, F.explode("pieces").alias("p")).filter(F.col("p.len") >= min_para_chars)
           .select(*KEY, F.col("p.i").alias("i"), F.col("p.h").alias("ph")))
    left = F.filter("pieces", lambda p: ~F.array_contains("drop_idx", p["i"]))
    cut = (para.join(paragraph_drop_index(occ, run), KEY).withColumn("_left", left)
           .select(*KEY, "drop_idx", _text_key(F.transform("_left", lambda p: F.lower(F.hex(p["h"])))).alias("_key"),
                   _joined_length(F.col("_left"), para_sep).alias("_len")))

    # Stage 3: global exact dedup on the cleaned text of what is left.
    s2 = run.write(d.select(*KEY, "para_dedup", "empty", "key", "len", "changed").join(w1, KEY, "left").join(cut, KEY, "left")
                   .select(*KEY, "empty", F.coalesce("first_raw", F.lit(False)).alias("first_raw"), "drop_idx",
                           F.coalesce("_key", "key").alias("key"), (F.coalesce("_len", "len") < min_doc_chars).alias("too_short"),
                           (F.col("first_raw").isNotNull() & (F.col("drop_idx").isNotNull() | F.col("changed"))).alias("para_changed")))
    w3 = first_by_order(s2.filter(F.col("first_raw") & ~F.col("too_short")).select("key", *KEY), "key", KEY, "first_final")
    status = (F.when(F.col("empty"), "empty")
              .when(~F.col("first_raw"), "raw_dup")
              .when(F.col("too_short"), "too_short")
              .when(F.col("first_final").isNull(), "final_dup")
              .otherwise("kept"))
    names = registry.select("source", "source_rank")
    out = run.write(s2.join(w3, KEY, "left").select(*KEY, status.alias("status"), "para_changed", "drop_idx")
                    .join(F.broadcast(names), "source_rank"))
    run.drop(*[t for t, _ in run.paths if t is not out])
    return out


def cleaned_texts(corpus: DataFrame, registry: DataFrame, decisions: DataFrame, para_sep: str = "\n\n") -> DataFrame:
    """The decisions with ``para_dedup`` and ``new_text``: the cleaned text of every
    document that ``decisions`` holds.  The one join, and the one shuffle, of the text."""
    new = F.when(F.col("para_dedup"), rebuild_paragraphs(F.col("text"), F.col("drop_idx"), para_sep)).otherwise(ustrip("text"))
    return (_base(corpus, registry).drop("source").join(decisions, KEY)
            .select("source", *KEY, "para_dedup", "status", "para_changed", new.alias("new_text")))


def dedup_status(corpus: DataFrame, registry: DataFrame, para_sep: str = "\n\n",
                 min_para_chars: int = 50, min_doc_chars: int = 20) -> DataFrame:
    """X4 status relation ``(source, source_rank, pos, status, para_changed, text)``;
    ``text`` is the final text (stripped, not NFC-normalised), null unless kept."""
    decided = dedup_decisions(corpus, registry, para_sep, min_para_chars, min_doc_chars)
    new = F.when(F.col("para_dedup"), rebuild_paragraphs(F.col("text"), F.col("drop_idx"), para_sep)).otherwise(ustrip("text"))
    return (_base(corpus, registry).drop("source").join(decided, KEY)
            .select("source", *KEY, "status", "para_changed", F.when(F.col("status") == "kept", new).alias("text")))


def deduped_output(status: DataFrame) -> DataFrame:
    """Rows to write: kept documents with their final text."""
    return status.filter(F.col("status") == "kept").select("source", "source_rank", "pos", "text")


def dedup_report(status: DataFrame, registry: DataFrame) -> DataFrame:
    """A1: one row per registered (present) source; zero-row sources included.

    ``removed_by_paragraph_dedup`` counts documents whose text the paragraph
    stage *changed* (the reference's meaning), not documents removed."""
    agg = status.groupBy("source").agg(
        F.count(F.lit(1)).alias("original_docs"),
        F.count_if(F.col("status").isin("raw_dup", "final_dup")).alias("removed_by_doc_dedup"),
        F.count_if(F.col("para_changed")).alias("removed_by_paragraph_dedup"),
        F.count_if(F.col("status").isin("empty", "too_short")).alias("removed_as_too_short"),
        F.count_if(F.col("status") == "kept").alias("deduped_docs"))
    rep = registry.select("source", "source_rank").join(agg, "source", "left").na.fill(
        0, ["original_docs", "removed_by_doc_dedup", "removed_by_paragraph_dedup",
            "removed_as_too_short", "deduped_docs"])
    rep = rep.withColumn("removed_docs", F.col("original_docs") - F.col("deduped_docs"))
    rate = F.when(F.col("original_docs") > 0,
                  F.bround(F.col("removed_docs") / F.col("original_docs"), 4)).otherwise(F.lit(0.0))
    return rep.withColumn("duplicate_rate", rate.cast("double"))


def with_outputs(report: DataFrame, sizes: DataFrame) -> DataFrame:
    """A1: the report with ``output_path``, ``output_files``, ``output_bytes`` and
    ``output_size`` of each source (``sources.formats.written_sizes``); a source of which
    nothing was kept has no path, no file and 0 bytes."""
    return (report.join(sizes, "source", "left").na.fill(0, ["output_files", "output_bytes"])
            .na.fill("0.00 B", ["output_size"]))


def dedup_totals(status: DataFrame) -> DataFrame:
    """A2: totals over all sources (one row)."""
    t = status.agg(F.count(F.lit(1)).alias("total_original_docs"),
                   F.count_if(F.col("status") == "kept").alias("total_deduped_docs"))
    t = t.withColumn("total_removed_docs", F.col("total_original_docs") - F.col("total_deduped_docs"))
    rate = F.when(F.col("total_original_docs") > 0,
                  F.bround(F.col("total_removed_docs") / F.col("total_original_docs"), 4)).otherwise(0.0)
    return t.withColumn("duplicate_rate", rate.cast("double"))


def dedup_report_rollup(status: DataFrame) -> DataFrame:
    """A1+A2 in one pass: ``rollup(source)``; the total row has source NULL."""
    r = status.rollup("source").agg(
        F.count(F.lit(1)).alias("original_docs"),
        F.count_if(F.col("status") == "kept").alias("deduped_docs"))
    return r.withColumn("removed_docs", F.col("original_docs") - F.col("deduped_docs"))


def min_chars(df: DataFrame, col: str = "text", n: int = 20) -> DataFrame:
    """keep rows whose stripped text has at least ``n`` code points."""
    return df.filter(F.length(ustrip(col)) >= n)


def drop_empty(df: DataFrame, col: str = "text") -> DataFrame:
    """drop null/'' text (whitespace-only is not empty here)."""
    return df.filter(F.coalesce(F.col(col), F.lit("")) != "")


def summary(report: DataFrame, totals: DataFrame) -> DataFrame:
    """A5: human-readable summary lines (thousands separators, percent with one
    decimal): one line per source, then the total line."""
    def line(name, orig, kept, removed, rate):
        return F.format_string("%s %s -> %s  (-%s, %s%%)", name,
                               F.format_number(orig, 0), F.format_number(kept, 0),
                               F.format_number(removed, 0), F.format_number(F.bround(rate * 100, 1), 1))
    per = report.select(F.col("source_rank").alias("_o"),
                        line(F.col("source"), F.col("original_docs"), F.col("deduped_docs"),
                             F.col("removed_docs"), F.col("duplicate_rate")).alias("line"))
    tot = totals.select(F.lit(1 << 30).alias("_o"),
                        line(F.lit("TOTAL"), F.col("total_original_docs"), F.col("total_deduped_docs"),
                             F.col("total_removed_docs"), F.col("duplicate_rate")).alias("line"))
    return per.unionByName(tot)


def audit_summary(audit: DataFrame, order: Column, first: int = (1 << 30) + 1) -> DataFrame:
    """A5, second part: the lines of a token audit (``operators.audit.token_audit``,
    one row per source): run-wide counts, one line per source in ``order``, then
    the surplus or gap.  ``_o`` continues that of ``summary`` from ``first``.  The audit is
    read once: one of its rows, which all have the run-wide columns, gives their lines too."""
    def n(c):
        return F.format_number(c, 0)

    gap = F.col("budget_gap_or_surplus")
    factor = F.coalesce(F.col("repeat_factor"), F.lit(0.0))
    run = [F.concat(F.lit("Unique tokens after dedup: "), n("unique_tokens")),
           F.concat(F.lit("Training token budget: "), n("token_budget")),
           F.concat(F.lit("Repeat factor (unweighted): "), F.format_string("%.2fx", factor))]
    end = [F.concat(F.lit("Effective tokens: "), n("effective_tokens_with_weights")),
           F.when(F.col("enough_for_budget"), F.concat(F.lit("Surplus: "), n(gap), F.lit(" tokens above budget")))
           .otherwise(F.concat(F.lit("Gap: "), n(-gap), F.lit(" tokens below budget")))]

    def lines(columns, begin):
        return [F.struct((F.lit(begin + i)).cast("int").alias("_o"), c.alias("line")) for i, c in enumerate(columns)]

    per = F.struct((F.lit(first + len(run)) + order).cast("int").alias("_o"), F.format_string(
        "%s %s  x%d  = %s", "source", n("tokens"), "weight", n("weighted_tokens")).alias("line"))
    one = F.row_number().over(Window.orderBy("source")) == 1  # a row per source: few
    at = F.when(F.col("_one"), F.array(*lines(run, first), per, *lines(end, first + (1 << 20)))).otherwise(F.array(per))
    return audit.withColumn("_one", one).select(F.explode(at).alias("x")).select("x._o", "x.line")
