"""Language of texts by the nearest of several centroids per language.

A text becomes a vector of hashed character n-grams, weighted by TF-IDF and scaled
to length one.  Document frequencies come from all texts to learn from.  The vectors
of a bounded sample of each language are clustered by cosine (spherical k-means), so
that a language of several styles or spellings has several centroids.  A text takes
the language of the centroid of greatest cosine; it is rejected where it lies further
from that centroid than nearly all texts the centroid was learned from.

Learning is two passes over the texts (frequencies; vectors of the sample), the
clustering of a language is one task over its sample, and what reaches the driver is
the model: frequencies and centroids, of a size fixed by ``Config`` and the number of
languages.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, slices, text_or_empty

#: The language of texts without a letter, and of rejected ones.
UNKNOWN = "und"
#: Characters of a long text that are handled at a time.
PIECE = 1 << 18


@dataclass(frozen=True)
class Config:
    dims: int = 1 << 14      #: hashed n-grams; a power of two
    longest: int = 3         #: n-grams of 1 to so many characters
    clusters: int = 4        #: centroids per language, at most
    sample: int = 400        #: rows per language that are clustered, at most
    steps: int = 12          #: of k-means
    quantile: float = 0.995  #: share of a centroid's own texts within its radius
    slack: float = 0.05      #: added to the radius


@dataclass
class Model:
    cfg: Config
    idf: np.ndarray          #: per n-gram bucket
    languages: list[str]     #: per centroid
    centroids: np.ndarray    #: rows of length one
    radius: np.ndarray       #: cosine distance beyond which a centroid rejects


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """Per code point: 2 letter, 1 mark (kept inside words), 0 anything else."""
    return np.array([2 if (c := chr(i)).isalpha() else 1 if unicodedata.category(c)[0] == "M" else 0
                     for i in range(0x110000)], dtype=np.uint8)


def ngram_counts(text: str, cfg: Config) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, counts) of the text's n-grams: lower case, NFC, every run of other
    characters one space.  Empty if the text has no letter."""
    total = np.zeros(cfg.dims, dtype=np.int64)
    kinds, letters, tail = _kinds(), False, np.zeros(1, dtype=np.uint32)
    shift = np.uint32(33 - cfg.dims.bit_length())
    low = unicodedata.normalize("NFC", text).lower()
    for at in range(0, len(low) or 1, PIECE):
        code = np.frombuffer(low[at:at + PIECE].encode("utf-32-le", "surrogatepass"), dtype="<u4")
        kind = kinds[code]
        letters = letters or bool((kind == 2).any())
        code = np.concatenate([tail, np.where(kind > 0, code, 0).astype(np.uint32),
                               np.zeros(int(at + PIECE >= len(low)), dtype=np.uint32)])
        code = code[np.r_[True, (code[1:] != 0) | (code[:-1] != 0)]]  # runs of spaces become one
        h = np.zeros(len(code), dtype=np.uint32)
        for n in range(1, cfg.longest + 1):
            h = h[:len(code) - n + 1] * np.uint32(0x01000193) + code[n - 1:] * np.uint32(0x9E3779B1)
            first = max(0, len(tail) - n + 1)                # the first n-gram that ends behind the tail
            mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B + 2 * n)
            mixed = (mixed ^ (mixed >> np.uint32(13))) >> shift
            mixed = mixed[first:] if n > 1 else mixed[first:][code[first:] != 0]  # a space alone says nothing
            total += np.bincount(mixed, minlength=cfg.dims)
        tail = code[-cfg.longest:]
    found = np.flatnonzero(total) if letters else np.zeros(0, dtype=np.int64)
    return found, total[found]


def tf_idf(text: str, idf: np.ndarray, cfg: Config) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, weights), of length one."""
    at, n = ngram_counts(text, cfg)
    w = ((1 + np.log(n)) * idf[at]).astype(np.float32)
    return at, w / np.float32(np.linalg.norm(w)) if len(w) else w


def spherical_kmeans(x: np.ndarray, k: int, steps: int) -> np.ndarray:
    """Centroids of rows of length one, by cosine; deterministic.  The first lies next to
    the mean, each further one is the row furthest from those before."""
    seeds = [int(np.argmax(x @ x.mean(axis=0)))]
    near = x @ x[seeds[0]]
    while len(seeds) < min(k, len(x)) and near.min() < 1 - 1e-6:
        seeds.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[seeds[-1]])
    c = x[seeds].copy()
    for _ in range(steps):
        own = np.argmax(x @ c.T, axis=1)
        for j in range(len(c)):
            mean = x[own == j].sum(axis=0)
            if (size := np.linalg.norm(mean)) > 0:  # an unused centroid stays
                c[j] = mean / size
    return c


def _frequencies(cfg: Config):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(cfg.dims + 1, dtype=np.int64)  # last: texts
        for b in slices(batches):
            for text in b.column("t").to_pylist():
                at, _ = ngram_counts(text, cfg)
                df[at] += 1
                df[-1] += len(at) > 0
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], ["bucket", "n"])
    return run


def _vectors(cfg: Config, idf):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            rows = [tf_idf(t, idf.value, cfg) for t in b.column("t").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("lang"), b.column("h"), pa.array([at.astype("<u4").tobytes() for at, _ in rows], pa.binary()),
                 pa.array([w.astype("<f4").tobytes() for _, w in rows], pa.binary())], ["lang", "h", "at", "w"])
    return run


def _cluster(cfg: Config):
    def run(t: pa.Table) -> pa.Table:
        x = np.zeros((t.num_rows, cfg.dims), dtype=np.float32)
        for row, at, w in zip(x, t.column("at").to_pylist(), t.column("w").to_pylist(), strict=True):
            row[np.frombuffer(at, "<u4")] = np.frombuffer(w, "<f4")
        x = x[(x != 0).any(axis=1)]
        x = x[np.lexsort(x.T[:8])] if len(x) else x  # the order of the rows must not matter
        out = []
        if len(x):
            c = spherical_kmeans(x, cfg.clusters, cfg.steps)
            cos = x @ c.T
            own = np.argmax(cos, axis=1)
            for j in range(len(c)):
                far = 1 - cos[own == j, j]
                r = float(np.quantile(far, cfg.quantile)) + cfg.slack if len(far) else cfg.slack
                out.append({"lang": t.column("lang")[0].as_py(), "centroid": c[j].astype("<f4").tobytes(), "radius": r})
        return pa.Table.from_pylist(out, pa.schema([("lang", pa.string()), ("centroid", pa.binary()), ("radius", pa.float64())]))
    return run


def fit(df: DataFrame, learn: Column, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
        cfg: Config = Config()) -> Model:
    """Learn from the rows where ``learn`` holds and language and text are not null.

    Frequencies count all of them.  At most ``cfg.sample`` rows per language are
    clustered, those of the smallest hashes of id and text; the id picks rows and is no
    feature.  Texts without a letter teach nothing.  With no row to learn from the model
    has no centroid."""
    spark = df.sparkSession
    run = Scratch(spark, "language")
    known = df.filter(learn & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    rows = known.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("t"),
                        F.xxhash64(F.col(id_col), F.col(text_col)).alias("h"))
    counts = rows.select("t").mapInArrow(_frequencies(cfg), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    df_n = np.zeros(cfg.dims + 1)
    for r in counts.collect():
        df_n[r["bucket"]] = r["n"]
    idf = (np.log((1 + df_n[-1]) / (1 + df_n[:-1])) + 1).astype(np.float32)
    # a hash threshold with twice the rows wanted keeps the ranking small; one row per language
    space = 1 << 30
    share = run.stage(known.groupBy(F.col(lang_col).cast("string").alias("lang")).agg(F.count(F.lit(1)).alias("n")))
    limit = F.when(F.col("n") <= 4 * cfg.sample, F.lit(space)).otherwise((2.0 * cfg.sample * space / F.col("n")).cast("long"))
    likely = (rows.join(F.broadcast(share.select("lang", limit.alias("limit"))), "lang")
              .withColumn("h", F.pmod("h", F.lit(space))).filter(F.col("h") < F.col("limit")))
    vectors = (likely.select("lang", "t", "h")
               .mapInArrow(_vectors(cfg, spark.sparkContext.broadcast(idf)), "lang string, h long, at binary, w binary")
               .withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("h", "at", "w")))
               .filter(F.col("k") <= cfg.sample))
    found = vectors.select("lang", "at", "w").groupBy("lang").applyInArrow(
        _cluster(cfg), "lang string, centroid binary, radius double").collect()
    found = sorted(found, key=lambda r: (r["lang"], r["centroid"]))
    run.drop(share)
    centroids = np.array([np.frombuffer(r["centroid"], "<f4") for r in found], dtype=np.float32).reshape(len(found), cfg.dims)
    return Model(cfg, idf, [r["lang"] for r in found], centroids, np.array([r["radius"] for r in found]))


def nearest(text: str, model: Model) -> tuple[str, float, bool]:
    """(language of the nearest centroid, its cosine, rejected)."""
    at, w = tf_idf(text, model.idf, model.cfg)
    if not len(at) or not len(model.centroids):
        return UNKNOWN, 0.0, True
    cos = model.centroids[:, at] @ w
    j = int(np.argmax(cos))
    score = float(min(1.0, max(0.0, cos[j])))
    return model.languages[j], score, bool(1 - score > model.radius[j])


def identify(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ``lang``: language, ``und`` if rejected; ``nearest``: language of the nearest
    centroid whether rejected or not; ``score``: its cosine, 0 to 1; ``rejected``), one
    row per row.

    A null text, or one without a letter, has no vector: its distance is 1, its language
    and ``nearest`` are ``und``, its score is 0.  So it is with a model without
    centroids.  Equal distances go to the first language in order.  Texts are read
    whole.  Repeated rows give a row each.  Other columns are not read.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    id_t = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in slices(batches):
            rows = [nearest(t, m) for t in b.column("t").to_pylist()]
            lang = [UNKNOWN if r else x for x, _, r in rows]
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), pa.array(lang, pa.string()), pa.array([x for x, _, _ in rows], pa.string()),
                 pa.array([s for _, s, _ in rows], pa.float64()), pa.array([r for _, _, r in rows], pa.bool_())],
                ["_id", "lang", "nearest", "score", "rejected"])

    return (df.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("t"))
            .mapInArrow(run, f"_id {id_t}, lang string, nearest string, score double, rejected boolean")
            .withColumnRenamed("_id", id_col))
