"""Poem corpus jobs: page -> segments -> cleaned content -> 4x5 stanzas ->
order-preserving distinct -> stage-2 dedup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import poem as PF
from ..functions.text import doc_hash, nfc, ustrip


def segments(pages: DataFrame, html: str = "html", default_title: str = "title") -> DataFrame:
    """G3 as rows: one row per poem segment (``seg`` = position)."""
    return (pages.select("*", F.posexplode(PF.segment_poems(html, default_title)).alias("seg", "_s"))
            .select(*[c for c in pages.columns if c != html], "seg",
                    F.col("_s.title").alias("poem_title"), F.col("_s.content").alias("content")))


def attach_author(segs: DataFrame, metadata: DataFrame, key: str = "url") -> DataFrame:
    """Each segment inherits its page's author (default 'Unknown')."""
    m = metadata.select(key, F.col("author").alias("_author"))
    return (segs.join(m, key, "left")
            .withColumn("author", F.coalesce(F.nullif(ustrip("_author"), F.lit("")), F.lit("Unknown")))
            .drop("_author"))


def clean_poems(df: DataFrame) -> DataFrame:
    """P7/P8/P10 + F4: clean content, source and title; drop blank content."""
    out = (df.withColumn("content", F.when(F.col("content").isNotNull(),
                                           PF.clean_poem_html("content")).otherwise(F.lit("")))
           .withColumn("source", PF.clean_source("source"))
           .withColumn("title", PF.clean_title("title")))
    return out.filter(ustrip("content") != "")


def extract_stanzas(df: DataFrame, content: str = "content", n_lines: int = PF.LINES_PER_STANZA,
                    n_words: int = PF.WORDS_PER_LINE) -> DataFrame:
    """G2 + F9: one row per valid stanza, ``stanza_idx`` = its position in the
    content.  Stanzas are split on a newline, optional whitespace, newline;
    lines cleaned (P11), blanks dropped; exactly n_lines lines of n_words words.
    Cleaning and NFC run on the whole content before it is split (neither line breaks
    nor the mark between stanzas compose, so this equals NFC per line)."""
    docs = df.withColumn("_pre", PF.clean_stanzas(content)).withColumn("_t", nfc("_pre")).drop("_pre")
    st = docs.select(*df.columns, F.posexplode(F.split("_t", PF.STANZA_MARK, -1)).alias("stanza_idx", "stanza"))
    return st.filter(PF.is_clean_stanza("stanza", n_lines, n_words))


def distinct_first(df: DataFrame, col: str, order: list[str]) -> DataFrame:
    """Order-preserving distinct (byte equality): the first occurrence by
    ``order`` of every value; partial aggregation keeps hot values cheap."""
    w = df.groupBy(col).agg(F.min(F.struct(*order)).alias("_w"))
    return w.select(col, *[F.col(f"_w.{c}").alias(c) for c in order])


def dedup_samples(df: DataFrame, order: list[str], text: str = "text", min_chars: int = 20) -> DataFrame:
    """Strip -> drop shorter than ``min_chars`` -> hash of the stripped text
    -> keep first by ``order``; output text is NFC-normalised."""
    s = df.withColumn("_t", ustrip(F.coalesce(F.col(text), F.lit("")))) \
          .filter(F.length("_t") >= min_chars).withColumn("_h", doc_hash("_t"))
    w = s.groupBy("_h").agg(F.min(F.struct(*order)).alias("_w")) \
         .select(*[F.col(f"_w.{c}").alias(c) for c in order])
    return s.join(w, order, "left_semi").withColumn(text, nfc("_t")).drop("_t", "_h")
