import math
import random

import pytest
from pyspark.sql import functions as F

from model import pack_model
from textloom.operators import chat as C
from textloom.operators import mixture as M
from textloom.operators import order as O
from textloom.operators import pack as P


def spark_pack(spark, docs, block, batch_docs, shards):
    rows = [(i, d) for i, d in enumerate(docs)]
    df = spark.createDataFrame(rows, "g long, ids array<int>")
    b = P.pack(df, "ids", "g", len(docs), block, batch_docs, shards)
    out = b.orderBy("shard", "batch", "block_idx").collect()
    assert all(r.input_ids == r.labels for r in out)
    return [list(r.input_ids) for r in out]


@pytest.mark.parametrize("case", [
    ([[1] * 7], 8, 10, 1),                  # batch total B-1 -> one short block
    ([[1] * 8], 8, 10, 1),                  # exactly B
    ([[1] * 9], 8, 10, 1),                  # B+1 -> remainder dropped
    ([[1, 2, 3, 4] * 4], 8, 10, 1),         # 2B
    ([[], []], 8, 10, 1),                   # zero tokens -> no block
    ([list(range(30))], 8, 10, 1),          # document longer than B
])
def test_pack_boundaries(spark, case):
    docs, block, bd, sh = case
    assert spark_pack(spark, docs, block, bd, sh) == pack_model(docs, block, bd, sh)


def test_pack_random(spark):
    rnd = random.Random(7)
    docs = [[rnd.randint(1, 99) for _ in range(rnd.randint(0, 25))] for _ in range(53)]
    for block, bd, sh in [(8, 3, 4), (16, 5, 3), (5, 100, 1), (8, 2, 7)]:
        assert spark_pack(spark, docs, block, bd, sh) == pack_model(docs, block, bd, sh)


def test_pad_and_mask(spark):
    df = spark.createDataFrame([([5, 6, 7, 0],), (list(range(1, 70)),), ([9, 0, 8, 0, 0],)], "ids array<int>")
    inp, att, lab = P.pad_and_mask(F.col("ids"), 6, 2, 0)
    r = df.select(inp.alias("i"), att.alias("a"), lab.alias("l")).collect()
    assert r[0].i == [5, 6, 7, 0, 0, 0] and r[0].a == [1, 1, 1, 1, 0, 0]
    assert r[0].l == [-100, -100, 7, 0, -100, -100]
    assert r[1].i == [1, 2, 3, 4, 5, 6] and r[1].a == [1] * 6 and r[1].l == [-100, -100, 3, 4, 5, 6]
    assert r[2].l == [-100, -100, 8, 0, 0, -100]   # EOS inside text stays a label


@pytest.mark.parametrize("n,ratio", [(1, 0.1), (10, 0.1), (11, 0.1), (100, 0.01), (101, 0.01)])
def test_split_sizes(spark, n, ratio):
    df = spark.range(n).withColumnRenamed("id", "k")
    s = M.split_exact(df, ratio, 42, ["k"])
    ev = s.filter(F.col("split") == "eval").count()
    assert ev == math.ceil(ratio * n)
    g = sorted(r.g for r in s.collect())
    assert g == list(range(n))


def _big(spark, n=300_000):
    d = spark.range(n, numPartitions=5)
    return d.select(F.sha2(F.col("id").cast("string"), 256).alias("k"), F.pmod("id", F.lit(7)).alias("few"), "id",
                    F.concat_ws("-", F.lit("payload"), F.sha2(F.col("id").cast("string"), 224)).alias("payload"))


@pytest.mark.parametrize("parts", [2, 8, 200, 2000])
def test_global_index_of_wide_rows(spark, parts):
    d = _big(spark)
    want = [r.k for r in d.select("k").orderBy("k").collect()]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        for _ in range(2 if parts < 2000 else 1):
            got = O.with_global_index(d, ["k"], "g", total="n").select("k", "g", "n", "payload").collect()
            got.sort(key=lambda r: r.g)
            assert [r.g for r in got] == list(range(len(want))) and [r.k for r in got] == want
            assert {r.n for r in got} == {len(want)}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_buckets_follow_the_shuffle_partitions(spark):
    """As many buckets as partitions, about even, and each the count of bounds at or below."""
    d = _big(spark, 40_000).select("k")
    for buckets in (1, 2, 9, 300):
        bounds = O._bounds(d, ["k"], buckets, 40_000)
        got = d.select("k", O._bucket(O._order_key(["k"]), bounds).alias("b")).collect()
        at = [x.k0 for x in spark.range(1).select(F.array(*bounds)).first()[0]] if bounds else []
        assert len(at) == buckets - 1 and at == sorted(at)
        assert all(r.b == sum(x <= r.k for x in at) for r in got[:500])
        sizes = [0] * buckets
        for r in got:
            sizes[r.b] += 1
        assert min(sizes) > 0 and max(sizes) < 4 * 40_000 / buckets


def test_global_index_by_several_columns_with_nulls(spark):
    rows = [(None if i % 5 == 0 else i % 3, f"r{i * 37 % 500:03d}") for i in range(500)]
    d = spark.createDataFrame(rows, "a int, b string").repartition(7)
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    got = O.with_global_index(d, ["a", "b"], "g").collect()
    assert [(r.a, r.b) for r in sorted(got, key=lambda r: r.g)] == want
    assert O.with_global_index(d.limit(0), ["a", "b"], "g").collect() == []


@pytest.mark.parametrize("n", [0, 37, 150_000, 400_000])
def test_head_rows_at_every_size(spark, n):
    d = _big(spark)
    want = [r.k for r in d.select("k").orderBy("k").limit(n).collect()]
    assert sorted(r.k for r in O.head_rows(d, n, ["k"]).select("k", "payload").collect()) == want


def test_replicate(spark):
    df = spark.createDataFrame([("a", 3), ("b", 1), ("c", 0), ("d", None)], "s string, weight int")
    got = sorted((r.s, r.copy) for r in M.replicate(df).collect())
    assert got == [("a", 0), ("a", 1), ("a", 2), ("b", 0), ("c", 0), ("d", 0)]


def test_prompts(spark):
    rows = [(1, 0, "system", " be nice "), (1, 1, "user", " hi "), (1, 2, "assistant", "yo"),
            (1, 3, "user", " last "), (1, 4, "assistant", "ignored"),
            (2, 0, "assistant", "no user turn")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in C.build_prompts(df).collect()}
    assert set(got) == {1}
    assert got[1].prompt == "Assistant: be nice\nUser: hi\nAssistant: yo\nUser: last\nAssistant:"
    assert got[1].message == " last " and got[1].history_turns == 3
    g = C.generate(C.build_prompts(df), C.echo_model).collect()[0]
    assert g.reply == "xin chào" and g.backend == "model"


def test_validate_requests(spark):
    df = spark.createDataFrame([("hi", None, None), ("", 600, 0.05), ("x" * 4001, 1, 2.0)],
                               "message string, max_new_tokens int, temperature double")
    r = C.validate_requests(df).collect()
    assert r[0].is_valid and r[0].max_new_tokens == 128 and r[0].temperature == 0.8
    assert r[1].reasons == ["empty_message", "bad_max_new_tokens", "bad_temperature"]
    assert r[2].reasons == ["message_too_long"]


def test_training_mixture_split_first(spark):
    from textloom.sources.corpus import registry
    df = spark.createDataFrame([(f"s{i % 2}", i) for i in range(40)], "source string, pos long")
    reg = registry(spark, ["s0", "s1"], {"s0": 3})
    a = M.training_mixture(df, reg, 42, 0.1, ["source", "pos"])
    assert a.count() == 20 * 3 + 20 and a.filter(F.col("split") == "eval").count() == 8
    b = M.training_mixture(df, reg, 42, 0.1, ["source", "pos"], split_first=True)
    ev = {(r.source, r.pos) for r in b.filter(F.col("split") == "eval").collect()}
    tr = {(r.source, r.pos) for r in b.filter(F.col("split") == "train").collect()}
    assert len(ev) == 4 and not (ev & tr) and b.count() == 80


def test_documented_links(spark):
    from textloom.functions import wiki as W
    df = spark.createDataFrame([("[https://x.org label] [http://y.org]",)], "t string")
    assert df.select(W.resolve_external("t")).collect()[0][0] == "//x.org label //y.org"
    assert df.select(W.resolve_external("t", "documented")).collect()[0][0] == "label "


def test_requests_with_bad_turns_deep_in_the_history(spark):
    from textloom.operators.chat import validate_requests
    good = [("user", "hi"), ("assistant", "x" * 4000), ("system", "s")]
    rows = [("ok", good, None, None), ("ok", None, 512, 2.0), ("", [], 1, 0.1),
            ("m" * 4001, good * 20 + [("tool", "t"), ("user", ""), ("user", None), (None, "n"), ("user", "y" * 4001)], 0, 2.1),
            (None, [("User", "")], 513, 0.05)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                               "i int, message string, history array<struct<role: string, content: string>>, "
                               "max_new_tokens int, temperature double")
    got = {r.i: r for r in validate_requests(df).collect()}
    assert [got[i].is_valid for i in range(5)] == [True, True, False, False, False]
    assert (got[0].max_new_tokens, got[0].temperature) == (128, 0.8)
    assert got[2].reasons == ["empty_message"]
    assert [(t.i, t.reason) for t in got[3].bad_turns] == [
        (60, "bad_role"), (61, "empty_content"), (62, "empty_content"), (63, "bad_role"), (64, "content_too_long")]
    assert got[3].reasons == ["message_too_long", "bad_history", "bad_max_new_tokens", "bad_temperature"]
    assert got[4].reasons == ["empty_message", "bad_history", "bad_max_new_tokens", "bad_temperature"]


def test_packing_moves_arrays_once(spark):
    """The index is made before the ids: one exchange of the plan holds arrays."""
    from textloom.operators import pack as P
    d = spark.createDataFrame([(i, "text %d" % i) for i in range(50)], "doc_id long, text string")
    d = O.with_global_index(d, ["doc_id"], "g", total="n")
    d = d.withColumn("ids", P.append_eos(P.code_point_ids("text"), 0)).drop("text")
    plan = P.pack(d, "ids", "g", "n", 16, 10, 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2  # the texts by bucket, the arrays by batch
