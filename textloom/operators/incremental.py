"""Resumable / incremental work as joins: skip finished keys, cap the total,
first-seen merge of ordered crawls, crawl frontier fan-out, exactly-once ingest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import poem as PF
from .order import head_rows


def pending(todo: DataFrame, done: DataFrame, key: str = "url") -> DataFrame:
    """Rows of ``todo`` whose key is not among the done keys.  Null done keys
    are ignored; todo rows with a null key are retained (left anti join keeps
    them).  The done side is de-duplicated with partial aggregation first."""
    d = done.select(key).dropna().distinct()
    return todo.join(d, key, "left_anti")


def pending_capped(todo: DataFrame, done: DataFrame, key: str, cap: int,
                   order: list[str]) -> DataFrame:
    """Skip seen keys, then stop at ``cap`` items in total (the already
    finished ones included), taking pending rows in ``order``."""
    existing = done.select(key).dropna().distinct().count()
    left = max(cap - existing, 0)
    return head_rows(pending(todo, done, key), left, order)


def first_seen(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key, the one with the smallest ``order`` (e.g. (phase,
    seq): list-crawl rows beat author-crawl rows)."""
    cols = [c for c in df.columns]
    w = df.groupBy(key).agg(F.min(F.struct(*order, *[c for c in cols if c not in order and c != key]))
                            .alias("_w"))
    return w.select(key, *[F.col(f"_w.{c}").alias(c) for c in cols if c != key])


def known_authors(df: DataFrame, col: str = "author") -> DataFrame:
    """Distinct authors except 'Unknown' (sort when writing)."""
    return df.select(col).filter(F.col(col).isNotNull() & (F.col(col) != "Unknown")).distinct()


def _pages(total, max_pages: int):
    last = F.least(F.coalesce(total, F.lit(1)), F.lit(max_pages)).cast("long")
    return F.explode(F.when(last >= 1, F.sequence(F.lit(1).cast("long"), last))).alias("page")


def frontier(config_totals: DataFrame, author_totals: DataFrame, max_pages: int = PF.MAX_PAGES) -> DataFrame:
    """(kind, seed, page, url) of the list pages to crawl.

    (a) every sort configuration x pages 1..min(its own total, max), where
    ``config_totals`` holds (cfg, total) of first pages seen (without one: a
    single page); (b) every distinct author but 'Unknown' x pages 1..min(its
    total, max), from ``author_totals`` (author, total).  Order by (kind, seed,
    page) when writing."""
    spark = config_totals.sparkSession
    cfg = spark.createDataFrame([(i, s, o) for i, (s, o) in enumerate(PF.SORT_CONFIGS)],
                                "cfg int, sort string, sort_order string")
    seen = config_totals.groupBy(F.col("cfg").cast("int").alias("cfg")).agg(F.max("total").alias("total"))
    by_cfg = cfg.join(seen, "cfg", "left").select(
        F.lit("sort").alias("kind"), F.col("cfg").cast("string").alias("seed"), _pages(F.col("total"), max_pages),
        F.concat(F.lit(PF.SEARCH_URL),
                 F.when(F.col("sort") != "", F.concat(F.lit("&Sort="), "sort")).otherwise(""),
                 F.when(F.col("sort_order") != "", F.concat(F.lit("&SortOrder="), "sort_order")).otherwise("")
                 ).alias("url"))
    # python quote(safe='/') from form encoding: space, '*', '~', '/'
    enc = F.url_encode("author")
    for x, y in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%2F", "/")):
        enc = F.replace(enc, F.lit(x), F.lit(y))
    authors = (author_totals.filter((F.col("author") != "") & (F.col("author") != "Unknown"))
               .groupBy("author").agg(F.max("total").alias("total")))
    by_author = authors.select(F.lit("author").alias("kind"), F.col("author").alias("seed"),
                               _pages(F.col("total"), max_pages), F.concat(F.lit(PF.AUTHOR_URL), enc).alias("url"))
    return by_cfg.unionByName(by_author).withColumn(
        "url", F.concat("url", F.lit("&Page="), F.col("page").cast("string")))


def ingest_new(batch: DataFrame, table: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    """R1 (batch form): rows of the new batch whose key is not yet in the
    table, one row per key: the least by ``order``, by default all other columns
    in turn.  Null is a key like any other here: it is ingested once."""
    others = [c for c in batch.columns if c != key]
    done = table.select(F.col(key).alias("_done")).distinct()
    new = batch.join(done, batch[key].eqNullSafe(done["_done"]), "left_anti")
    return first_seen(new, key, order or others).select(*batch.columns)
