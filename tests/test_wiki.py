from pyspark.sql import functions as F

from textloom.functions import wiki as W


def run(spark, fn, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return [r[0] for r in df.select(fn(F.col("t"))).collect()]


CASES = [
    # (input, expected clean_wikitext output)
    ("a<!-- x\ny -->b", "ab"),
    ("x<ref name=a/>y<REF>c\nd</ref>z", "xyz"),
    ("a<b>bold</b>c", "a bold c"),
    ("a<h2>t</h2>b", "atb"),
    ("a<blockquote>q</blockquote>b", "a q b"),
    ("a{{t|{{n}}}}b", "ab"),
    ("a}}b", "ab"),                               # stray template closer dropped
    ("a{{unclosed b c", "a"),                     # unclosed -> rest deleted
    ("a{|\n|x\n{|inner|}\n|}b", "ab"),           # nested tables
    ("a|}b", "a|}b"),                             # stray table closer kept
    ("x\n|-\n| cell\n|| c2\ny", "x\ny"),          # orphan rows
    ("[[Link]] and [[T|shown]]", "Link and shown"),
    ("[[File:x.png|thumb|cap]]z", "z"),
    ("[[Tập_tin:a.jpg|x]]z", "z"),
    ("a [[:fr:X]]", "a :fr:X"),
    ("[[:fr:X]]", "fr:X"),                        # then the list step drops a leading ':' 
    ("[[a|[[b]]]]", "[[b]]"),                     # inner links not resolved again
    ("[[abcdef", "abcd"),                         # unclosed: last 2 chars lost
    ("[wikt:word|label] [fr:Art] [wikt:w2]", "label w2"),
    ("[https://x.org label]", "//x.org label"),
    ("== Head ==\n\nBody", "Head\nBody"),
    ("==\nx", "x"),
    ("===\nx", "=\nx"),
    ("'''bold''' ''it'' a----b __TOC__", "bold it ab"),
    ("a&amp;b&nbsp;c &lt;b&gt;", "a&b c <b>"),
    ("* item\n# num\n; term : def\n:: indent\n  *  sp", "item\nnum\nterm: def\nindent\nsp"),
    ("Body\n\n== Tham khảo ==\nrefs", "Body"),
    ("Body\nSEE   ALSO \nmore", "Body"),
    ("a \t b\n\n\n\nc  \n  d", "a b\n\nc\nd"),
    ("x\r\ny\x85z", "x\ny\nz"),
    (None, ""),
]


def test_clean_wikitext(spark):
    got = run(spark, W.clean_wikitext, [c[0] for c in CASES])
    bad = [(c[0], g, c[1]) for c, g in zip(CASES, got) if g != c[1]]
    assert not bad


def test_split_lines(spark):
    got = run(spark, W.split_lines, ["a\nb\n", "", "\n", "a\r\nb\x0bc "])
    assert got == ["a\nb\n".splitlines(), "".splitlines(), "\n".splitlines(), "a\r\nb\x0bc ".splitlines()]


def _markup(seed, n):
    """Random runs of delimiters, white space and text."""
    import random
    rnd = random.Random(seed)
    parts = ["{|", "|}", "{{", "}}", "[[", "]]", "[", "]", "|", "\n", "\n| ", "\n|-", " ", "a", "File:", "abc:", "=", "== h ==\n",
             "'''", "----", "__X__", "&amp;", "&nbsp;", "{", "}", "https://x y", " ", "é"]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25))) for _ in range(n)]


def test_one_crossing_equals_the_single_steps(spark):
    texts = [c[0] for c in CASES] + _markup(1, 400) + [None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    one = {r.i: r.clean for r in W.clean_wikitext_df(df, "t").collect()}
    many = {r.i: r.clean for r in W.clean_wikitext_df(df, "t", steps=W.SINGLE_STEPS).collect()}
    assert one == many
    for links in ("code", "documented"):
        got = {r.i: r.c for r in df.select("i", W.clean_wikitext("t", links).alias("c")).collect()}
        want = {r.i: r.c for r in W.clean_wikitext_df(df, "t", "c", links, W.SINGLE_STEPS).collect()}
        assert got == want


def test_one_scan_of_braces_equals_two():
    for text in _markup(2, 4000):
        two = W._drop_nested(text, W._TABLE_TOK, "{|", keep_stray_closer=True)
        assert W.scan_braces(text) == W._drop_nested(two, W._TMPL_TOK, "{{", keep_stray_closer=False), text
