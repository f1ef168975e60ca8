import os
import tempfile

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from textloom.operators import bpe as B
from textloom.operators import dedup as D
from textloom.sources import formats as S
from textloom.sources.corpus import read_corpus


def test_read_corpus_order_and_missing(spark):
    d = tempfile.mkdtemp(prefix="textloom-src-")
    pq.write_table(pa.table({"text": ["b1", None, "b3"], "other": [1, 2, 3]}), f"{d}/news.parquet")
    os.makedirs(f"{d}/wiki")
    pq.write_table(pa.table({"text": ["w1"]}), f"{d}/wiki/part-0.parquet")
    pq.write_table(pa.table({"text": ["w2", "w3"]}), f"{d}/wiki/part-1.parquet")
    c = read_corpus(spark, [f"{d}/news.parquet", f"{d}/missing.parquet", f"{d}/wiki"])
    rows = sorted((r.source_rank, r.pos, r.source, r.text) for r in c.collect())
    assert [(r[0], r[2], r[3]) for r in rows] == [
        (0, "news", "b1"), (0, "news", ""), (0, "news", "b3"),
        (2, "wiki", "w1"), (2, "wiki", "w2"), (2, "wiki", "w3")]
    wiki_pos = [r[1] for r in rows if r[2] == "wiki"]
    assert wiki_pos == sorted(wiki_pos) and len(set(wiki_pos)) == 3
    assert "other" not in c.columns


def test_write_corpus_and_jsonl(spark):
    d = tempfile.mkdtemp(prefix="textloom-sink-")
    df = spark.createDataFrame([("s0", 1, "thơ"), ("s1", 2, "b")], "source string, pos long, text string")
    S.write_corpus(df, f"{d}/out")
    back = spark.read.parquet(f"{d}/out")
    assert sorted((r.source, r.text) for r in back.collect()) == [("s0", "thơ"), ("s1", "b")]
    S.write_jsonl(df.select("pos", "text"), f"{d}/j", order=["pos"])
    lines = [ln for f in sorted(os.listdir(f"{d}/j")) if f.endswith(".json")
             for ln in open(f"{d}/j/{f}", encoding="utf-8")]
    assert '"thơ"' in "".join(lines)


def test_decode_invalid_bytes(spark):
    voc = B.vocab(spark, spark.createDataFrame([], "rank int, left int, right int, id int"))
    ids = [B.BYTE_IDS[b] for b in "é".encode()][:1] + [B.BYTE_IDS[ord("a")], 0]
    df = spark.createDataFrame([(1, ids)], "k long, ids array<int>")
    got = B.decode(df, voc, "ids", ["k"]).collect()[0].decoded
    assert got == "�a" + B.SPECIAL
    got2 = B.decode(df, voc, "ids", ["k"], skip_special=True).collect()[0].decoded
    assert got2 == "�a"


def test_dedup_exact_and_distinct(spark):
    df = spark.createDataFrame([(3, "x"), (1, "x"), (2, "y")], "pos long, t string")
    assert sorted(r.pos for r in D.dedup_exact(df, F.col("t"), ["pos"]).collect()) == [1, 2]


def test_nfc_quick_check(spark):
    """Exact where it lets a character pass; precomposed text stays in the JVM."""
    import itertools
    import unicodedata

    from textloom.functions.text import may_need_nfc, nfc, nfc_safe_ranges
    safe = [c for a, b in nfc_safe_ranges() for c in (a, a + 1, (a + b) // 2, b - 1, b)]
    marks = [0x301, 0x323, 0x1161, 0x11A8, 0x9BE, 0x65, 0x61, 0x20]
    for c, m in itertools.product(safe, marks):
        # a passing character changes neither alone nor behind another one
        pair = chr(m) + chr(c)
        assert unicodedata.normalize("NFC", pair) == unicodedata.normalize("NFC", chr(m)) + chr(c)
    texts = ["ascii", "Trăm năm trong cõi người ta — “chữ tài”, chữ mệnh… 😀", "Größe, façade, Œuvre, Ελλάδα Россия 漢字 한글",
             "e\u0301", "tie\u0302\u0301ng Vie\u0323\u0302t", "\u1112\u1161\u11ab", "a\u0323\u0307", "a\u0307\u0323", "\u212b", "\u2000x", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select(
        "i", "t", may_need_nfc("t").alias("python"), nfc("t").alias("n")).collect()
    for r in rows:
        assert r.n == unicodedata.normalize("NFC", r.t or "")
        assert r.python is None if r.t is None else r.python or r.n == r.t
    assert [r.i for r in rows if r.python is False] == [0, 1, 2]
