"""Language identification: features against a plain version, held-out accuracy, odd rows."""

import math

import numpy as np
from pyspark.sql import functions as F

from textloom.llm import language_id as L


def test_pieces_do_not_change_counts(monkeypatch):
    cfg = L.Config(dims=1 << 10)
    text = "  Été 1990: l'École,\n\n und   Straße -- x" * 9
    whole = L.ngram_counts(text, cfg)
    for piece in (1, 2, 3, 7):
        monkeypatch.setattr(L, "PIECE", piece)
        got = L.ngram_counts(text, cfg)
        assert all((a == b).all() for a, b in zip(whole, got, strict=True))


def test_counts_are_those_of_the_words():
    cfg = L.Config(dims=1 << 14, longest=2)
    at, n = L.ngram_counts("Ab, ab!", cfg)
    # " ab ab ": a b a b, " a" "ab" "b " " a" "ab" "b "
    assert sorted(n.tolist()) == [2, 2, 2, 2, 2] and len(at) == 5
    assert [len(x) for x in L.ngram_counts("123 -- !", cfg)] == [0, 0]
    assert len(L.ngram_counts("́̂", cfg)[0]) == 0  # marks are no letters


def test_weights_are_tf_idf():
    cfg = L.Config(dims=1 << 14, longest=1)
    idf = np.arange(1, cfg.dims + 1, dtype=np.float32)
    at, w = L.tf_idf("aab", idf, cfg)
    n = dict(zip(*[x.tolist() for x in L.ngram_counts("aab", cfg)], strict=True))
    raw = [(1 + math.log(n[i])) * (i + 1) for i in at.tolist()]
    assert np.allclose(w, np.array(raw) / math.sqrt(sum(x * x for x in raw)), rtol=1e-5)


def test_kmeans_finds_both_spellings():
    rng = np.random.default_rng(0)
    x = np.abs(np.r_[rng.normal([5, 0, 0, 0], 0.1, (30, 4)), rng.normal([0, 0, 5, 0], 0.1, (30, 4))]).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    c = L.spherical_kmeans(x, 2, 5)
    own = np.argmax(x @ c.T, axis=1)
    assert len(set(own[:30])) == len(set(own[30:])) == 1 and own[0] != own[30]
    assert len(L.spherical_kmeans(np.ones((3, 1), dtype=np.float32), 4, 3)) == 1  # equal rows: one centroid


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = L.fit(docs, learn=~held)
    got = {r.doc_id: r for r in L.identify(docs, model).collect()}
    rows = docs.filter(held).collect()
    assert sum(got[r.doc_id].nearest == r.lang for r in rows) >= 0.98 * len(rows)
    assert sum(got[r.doc_id].rejected for r in rows) <= 0.1 * len(rows)
    assert all(0 <= r.score <= 1 for r in got.values())
    # neither the place of a row nor lang, source or id is an input
    moved = docs.select((-F.col("doc_id") - 1).alias("doc_id"), "text", F.lit("xx").alias("lang")).repartition(7)
    again = {-r.doc_id - 1: (r.nearest, r.score) for r in L.identify(moved, model).collect()}
    assert again == {i: (r.nearest, r.score) for i, r in got.items()}


def test_odd_rows(spark):
    rows = [(1, "der und die das ist nicht", "de"), (2, "the and of that is not", "en"), (3, None, "en"), (4, "", "de"),
            (5, "123 !?", None), (None, "the that", "en"), (7, "die das " * 200_000, "de"), (8, "日本語", None),
            (2, "the and of that is not", "en"), (9, "und nicht", None)]
    df = spark.createDataFrame([(*r, 1, "s") for r in rows], "doc_id long, text string, lang string, nearest int, t string")
    model = L.fit(df, learn=F.lit(True), cfg=L.Config(clusters=2, sample=5))
    assert set(model.languages) == {"de", "en"}
    got = sorted(L.identify(df, model).collect(), key=lambda r: (r.doc_id is None, r.doc_id))
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert all((by[i].nearest, by[i].lang, by[i].score, by[i].rejected) == ("und", "und", 0.0, True) for i in (3, 4, 5))
    assert (by[7].nearest, by[9].nearest, by[None].nearest) == ("de", "de", "en")
    assert by[8].nearest in {"de", "en"} and by[8].lang == "und" and by[8].rejected  # far from all
    none = L.fit(df.limit(0), learn=F.lit(True))
    assert {r.nearest for r in L.identify(df, none).collect()} == {"und"}
    assert L.identify(df.limit(0), model).collect() == []
