import random

import pytest

from model import dedup_model
from textloom.operators import dedup as D
from textloom.sources.corpus import registry


def run_spark(spark, sources, para, sep="\n\n"):
    rows = [(name, i, t) for name, texts in sources for i, t in enumerate(texts)]
    corpus = spark.createDataFrame(rows, "source string, pos long, text string")
    reg = registry(spark, [n for n, _ in sources], para_sources=para)
    st = D.dedup_status(corpus, reg, para_sep=sep)
    return {(r.source, r.pos): (r.status, r.para_changed, r.text) for r in st.collect()}


PARA_A = "Alpha paragraph that is certainly longer than fifty characters, yes."
PARA_B = "Beta paragraph that is certainly longer than fifty characters too, ok."


def inline_sources():
    nfd = "Café " * 6
    nfc = "Café " * 6
    return [
        ("s0", [None, "", "   ", " ", "\x1c", "short one", "x" * 19, "y" * 20,
                PARA_A + "\n\n" + PARA_B, PARA_A + "\n\n" + "tail text long enough",
                nfd, nfc, "Same text in two sources here", "  padded duplicate text  ",
                "padded duplicate text", PARA_B + "\n\n\n" + "short"]),
        ("s1", ["Same text in two sources here", PARA_A, "short dup", "short dup",
                PARA_A + "\n\n" + "z" * 30]),
        ("s2", []),
        ("s3", [PARA_A + "\n\n" + PARA_A + "\n\nend part long enough", "Emoji 😀 text that is long"]),
    ]


def test_inline_cases(spark):
    src = inline_sources()
    got = run_spark(spark, src, ["s0", "s3"])
    want = dedup_model(src, {"s0", "s3"})
    assert got == want


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_corpora(spark, seed):
    rnd = random.Random(seed)
    paras = ["p%d " % k + "w" * rnd.choice([10, 48, 49, 50, 60]) for k in range(12)]
    paras += ["  ", "", "Café " * 12, "Café " * 12]
    sources = []
    for s in range(4):
        texts = []
        for _ in range(rnd.randint(0, 40)):
            k = rnd.randint(0, 4)
            seps = [rnd.choice(["\n\n", "\n\n\n", "\n"]) for _ in range(k)]
            t = rnd.choice(paras)
            for sp in seps:
                t += sp + rnd.choice(paras)
            if rnd.random() < 0.1:
                t = " " + t + " "
            if rnd.random() < 0.05:
                t = None
            texts.append(t)
        sources.append((f"s{s}", texts))
    para = ["s0", "s2"]
    assert run_spark(spark, sources, para) == dedup_model(sources, set(para))


def test_report_zero_row_source(spark):
    src = inline_sources()
    rows = [(name, i, t) for name, texts in src for i, t in enumerate(texts)]
    corpus = spark.createDataFrame(rows, "source string, pos long, text string")
    reg = registry(spark, [n for n, _ in src], para_sources=["s0", "s3"])
    st = D.dedup_status(corpus, reg)
    rep = {r.source: r for r in D.dedup_report(st, reg).collect()}
    assert rep["s2"].original_docs == 0 and rep["s2"].duplicate_rate == 0.0
    model = dedup_model(src, {"s0", "s3"})
    for name, texts in src:
        kept = sum(1 for (n, _), v in model.items() if n == name and v[0] == "kept")
        assert rep[name].deduped_docs == kept
        assert rep[name].original_docs == len(texts)
    tot = D.dedup_totals(st).collect()[0]
    assert tot.total_original_docs == sum(len(t) for _, t in src)


def test_invariance_partitions(spark):
    src = inline_sources()
    a = run_spark(spark, src, ["s0"])
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        b = run_spark(spark, src, ["s0"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert a == b


def test_text_functions(spark):
    from textloom.functions.text import nfc, ustrip, doc_hash, format_size, wiki_url
    df = spark.createDataFrame([("Café",), (None,), ("　 ab \x1c",)], "t string")
    r = df.select(nfc("t").alias("n"), ustrip("t").alias("s"), doc_hash("t").alias("h")).collect()
    assert r[0].n == "Café" and r[1].n == "" and r[2].s == "ab"
    sz = spark.createDataFrame([(0,), (1023,), (1024,), (1536,), (1 << 50,)], "b long")
    got = [x[0] for x in sz.select(format_size("b")).collect()]
    assert got == ["0.00 B", "1023.00 B", "1.00 KB", "1.50 KB", "1024.00 TB"]
    t = spark.createDataFrame([("Việt Nam/a:b~c*d+e%f",)], "t string")
    u = t.select(wiki_url("t")).collect()[0][0]
    from urllib.parse import quote
    assert u == "https://vi.wikipedia.org/wiki/" + quote("Việt_Nam/a:b~c*d+e%f", safe="/:")


def test_summary_lines(spark):
    rep = spark.createDataFrame([("s0", 0, 1234, 1000, 234, 0.1896)],
                                "source string, source_rank int, original_docs long, deduped_docs long, "
                                "removed_docs long, duplicate_rate double")
    tot = spark.createDataFrame([(1234, 1000, 234, 0.1896)],
                                "total_original_docs long, total_deduped_docs long, "
                                "total_removed_docs long, duplicate_rate double")
    lines = [r.line for r in D.summary(rep, tot).orderBy("_o").collect()]
    assert lines == ["s0 1,234 -> 1,000  (-234, 19.0%)", "TOTAL 1,234 -> 1,000  (-234, 19.0%)"]


def test_nothing_is_persisted(spark):
    src = inline_sources()
    rows = [(name, i, t) for name, texts in src for i, t in enumerate(texts)]
    corpus = spark.createDataFrame(rows, "source string, pos long, text string")
    status = D.dedup_status(corpus, registry(spark, [n for n, _ in src], para_sources=["s0"]))
    plan = status._jdf.queryExecution().toString()
    assert "InMemoryRelation" not in plan and "InMemoryTableScan" not in plan


def test_one_scan_decides_and_one_exchange_moves_the_text(spark, tmp_path):
    """The decisions' table holds no text; the status plan has one NFC-free text exchange."""
    src = inline_sources()
    rows = [(name, i, t) for name, texts in src for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "source string, pos long, text string").write.parquet(f"{tmp_path}/c")
    corpus = spark.read.parquet(f"{tmp_path}/c")
    reg = registry(spark, [n for n, _ in src], para_sources=["s0", "s3"])
    narrow = D.fingerprint_table(D._base(corpus, reg), "\n\n")
    assert "text" not in narrow.columns
    plan = narrow._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.count("Exchange hashpartitioning") == 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = D.dedup_status(corpus, reg)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ArrowEvalPython" not in plan and plan.count("text#") > 0 and plan.count("/c]") <= 1


def test_common_paragraph_and_unknown_source(spark):
    """A paragraph that most documents hold is split off; unregistered sources are an error."""
    common = "This paragraph stands in nearly every document of the source, word by word."
    texts = [f"{common}\n\nown text number {i} of this document" for i in range(200)] + ["a text of its own, long enough"]
    src = [("s0", texts), ("s1", texts[:3])]
    assert run_spark(spark, src, ["s0"]) == dedup_model(src, {"s0"})
    corpus = spark.createDataFrame([("other", 0, "text")], "source string, pos long, text string")
    with pytest.raises(Exception, match="not in the registry"):
        D.dedup_status(corpus, registry(spark, ["s0"])).collect()
    with pytest.raises(ValueError, match="white space"):
        D.dedup_status(corpus, registry(spark, ["other"]), para_sep="--")


def test_pieces_decide_like_whole_texts(spark):
    """A cleaned text equals a text of another source only as a whole: empty and padded
    pieces, separators of three line breaks, decomposed letters next to separators."""
    long = "Café paragraph which has certainly more than fifty characters in it"
    src = [("s0", [long + "\n\nfirst tail of the text", "  " + long + " \n\n\n second tail of the text",
                   long + "\n\n\n\nthird tail of the text ", "́mark first, twenty chars\n\nx"]),
           ("s1", ["first tail of the text", "second tail of the text", "\n third tail of the text",
                   "third tail of\n\n\nthe text", "́mark first, twenty chars\n\nx", "mark \n\nfirst, twenty chars"]),
           ("s2", ["third tail of\n\n\nthe text ", "mark \n\nfirst, twenty chars", "Café " + long[6:]])]
    assert run_spark(spark, src, ["s0"]) == dedup_model(src, {"s0"})
    assert run_spark(spark, src, ["s0", "s2"]) == dedup_model(src, {"s0", "s2"})
