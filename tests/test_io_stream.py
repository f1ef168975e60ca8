import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.operators import incremental as I
from textloom.sources import formats as S
from textloom.streaming.ingest import start_ingest


def tmpdir():
    return tempfile.mkdtemp(prefix="textloom-test-")


def test_jsonl_lenient_and_counts(spark):
    d = tmpdir()
    p = os.path.join(d, "a.jsonl")
    with open(p, "w", encoding="utf-8") as f:
        f.write('{"id": 1, "title": "Việt", "text": "a", "url": "u"}\n\n')
        f.write('{broken\n')
        f.write('{"id": 2, "title": "b", "text": null, "url": "v"}\n')
    df = S.read_jsonl(spark, p, S.ARTICLE_SCHEMA)
    c = S.ingest_counts(df).collect()[0]
    assert (c.total, c.kept) == (3, 2)
    rows = S.valid_rows(df).orderBy("id").collect()
    assert rows[0].title == "Việt" and rows[1].text is None


def test_csv_bom_multiline_na(spark):
    d = tmpdir()
    p = os.path.join(d, "m.csv")
    with open(p, "w", encoding="utf-8-sig") as f:
        f.write('title,content,source,url,author\n')
        f.write('"T1","line1\nline2 ""q""",NA,http://x,\n')
    r = S.read_csv(spark, p, S.POEM_CONTENT_SCHEMA).collect()[0]
    assert r.title == "T1" and r.content == 'line1\nline2 "q"' and r.source is None and r.author is None


def test_pending_nulls(spark):
    todo = spark.createDataFrame([("a",), ("b",), (None,)], "url string")
    done = spark.createDataFrame([("a",), (None,), ("a",)], "url string")
    got = sorted((r.url or "") for r in I.pending(todo, done).collect())
    assert got == ["", "b"]


def test_streaming_ingest_exactly_once(spark):
    src, out, ck = tmpdir(), tmpdir() + "/table", tmpdir()
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType())])
    with open(os.path.join(src, "b1.json"), "w") as f:
        for i in (1, 2, 2, 3):
            f.write(json.dumps({"id": i, "text": f"t{i}"}) + "\n")
    q = start_ingest(spark, src, out, ck, schema, "id")
    q.awaitTermination()
    with open(os.path.join(src, "b2.json"), "w") as f:
        for i in (3, 4):
            f.write(json.dumps({"id": i, "text": f"t{i}"}) + "\n")
    q = start_ingest(spark, src, out, ck, schema, "id")
    q.awaitTermination()
    ids = sorted(r.id for r in spark.read.parquet(out).collect())
    assert ids == [1, 2, 3, 4]


def test_ingest_keeps_the_first_by_order(spark):
    batch = spark.createDataFrame([("a", 3, "z"), ("a", 1, "y"), ("b", 2, "x")], "url string, seq int, text string")
    table = spark.createDataFrame([("b",)], "url string")
    got = [tuple(r) for r in I.ingest_new(batch.repartition(3), table, "url", ["seq"]).collect()]
    assert got == [("a", 1, "y")]


def test_unreadable_table_is_an_error(spark):
    from textloom.streaming.ingest import read_table
    schema = T.StructType([T.StructField("id", T.LongType())])
    out = tmpdir()
    assert read_table(spark, out + "/none", schema).collect() == []
    with open(os.path.join(out, "part-0.parquet"), "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        read_table(spark, out, schema).collect()


def _stream(spark, src, out, ck, rows, name, schema):
    with open(os.path.join(src, name), "w") as f:
        for url, text in rows:
            f.write(json.dumps({"url": url, "text": text}) + "\n")
    start_ingest(spark, src, out, ck, schema, "url", buckets=16).awaitTermination()


def test_a_batch_reads_the_buckets_of_its_keys_only(spark):
    """Files of all other buckets are damaged between two batches: nobody reads them."""
    from textloom.streaming import ingest as G
    schema = T.StructType([T.StructField("url", T.StringType()), T.StructField("text", T.StringType())])
    src, out, ck = tmpdir(), tmpdir() + "/table", tmpdir()
    first = [(f"https://host{i % 7}.example/page/{i}", f"t{i}") for i in range(200)] + [(None, "no key")]
    _stream(spark, src, out, ck, first, "b1.json", schema)
    assert spark.read.parquet(out).count() == 201
    second = [first[3], ("https://host1.example/new", "new"), (None, "again")]
    batch = spark.createDataFrame(second, schema)
    touched = {r[0] for r in batch.select(G.key_bucket("url", 16)).collect()}
    assert 1 <= len(touched) <= 3
    before = {}
    for folder in os.listdir(out):
        if folder.startswith("_bucket=") and int(folder.split("=")[1]) not in touched:
            for name in os.listdir(f"{out}/{folder}"):
                if name.endswith(".parquet"):
                    before[f"{out}/{folder}/{name}"] = open(f"{out}/{folder}/{name}", "rb").read()
                    open(f"{out}/{folder}/{name}", "w").write("damaged")
                    crc = f"{out}/{folder}/.{name}.crc"
                    if os.path.exists(crc):
                        open(crc, "w").write("")
    assert len(before) >= 10
    plan = G.existing_keys(batch, out, schema, "url", 16)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_bucket" in plan and "ReadSchema: struct<url:string>" in plan
    _stream(spark, src, out, ck, second, "b2.json", schema)
    G.ingest_batch(batch, 1, out, schema, "url", 16)  # the batch again, as after a crash
    for path, data in before.items():
        open(path, "wb").write(data)
    for folder in os.listdir(out):
        for name in os.listdir(f"{out}/{folder}") if folder.startswith("_bucket=") else ():
            if name.endswith(".crc") and os.path.getsize(f"{out}/{folder}/{name}") == 0:
                os.remove(f"{out}/{folder}/{name}")
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 202 and len({r.url for r in rows}) == 202
    assert [r.text for r in rows if r.url is None] == ["no key"]
    assert all(G.read_table(spark, out, schema).select(F.col("_bucket") == G.key_bucket("url", 16)).distinct().collect()[0])


def test_corpus_files_follow_sizes_and_are_reported(spark):
    """Rebalanced by source: few files though there are many tasks; paths and sizes as on disk."""
    from textloom.operators import dedup as D
    from textloom.sources.corpus import registry
    out = tmpdir() + "/corpus"
    rows = [(f"s{i % 3 if i < 30 else 0}", f"text {i}") for i in range(3000)]
    S.write_corpus(spark.createDataFrame(rows, "source string, text string").repartition(40), out)
    assert sum(n.endswith(".parquet") for _, _, names in os.walk(out) for n in names) <= 6
    sizes = {r.source: r for r in S.written_sizes(spark, out).collect()}
    assert set(sizes) == {"s0", "s1", "s2"}
    for name, r in sizes.items():
        folder = f"{out}/source={name}"
        files = [n for n in os.listdir(folder) if n.endswith(".parquet")]
        assert r.output_path == folder and r.output_files == len(files)
        assert r.output_bytes == sum(os.path.getsize(f"{folder}/{n}") for n in files)
        assert r.output_size == f"{r.output_bytes / (1024 if r.output_bytes >= 1024 else 1):.2f} " + ("KB" if r.output_bytes >= 1024 else "B")
    status = spark.createDataFrame([("s0", 0, 0, "kept", False), ("s9", 1, 0, "empty", False)],
                                   "source string, source_rank int, pos long, status string, para_changed boolean")
    rep = {r.source: r for r in D.with_outputs(D.dedup_report(status, registry(spark, ["s0", "s9"])),
                                               S.written_sizes(spark, out)).collect()}
    assert rep["s0"].output_path.endswith("source=s0") and rep["s0"].output_bytes == sizes["s0"].output_bytes
    assert (rep["s9"].output_path, rep["s9"].output_files, rep["s9"].output_size) == (None, 0, "0.00 B")
