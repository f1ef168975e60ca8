"""Text-cleaning queries: wikitext with markup injected around real documents,
wiki URLs and nested-API flattening."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import wiki as W
from ..functions.text import wiki_url
from ..sources import formats as S
from .catalog import WS_SQL, register, sql_strip, table

# Markup wrapped around every document (comment, nested template, header with a
# blank line after it, list item with a labelled link and a media link,
# emphasis, a reference, a terminal section with an external link).
_INJECT_SPARK = [
    "{{Infobox|lang=", "@lang", "|n={{nested|x}}}}\n<!-- hidden -->== Giới thiệu ==\n\n"
    "* [[Mục tiêu|", "@lang", "]] và [[Tập_tin:A.png|nhỏ]]\n'''", "@source", "''' ", "@text",
    "<ref name=\"a\">cite</ref>\n== Tham khảo ==\n* [https://example.org nguồn]",
]


def _inject_col():
    parts = [F.coalesce(F.col(p[1:]), F.lit("")) if p.startswith("@") else F.lit(p)
             for p in _INJECT_SPARK]
    return F.concat(*parts)


def _clean_lines_sql(x: str) -> str:
    return (f"array_to_string(list_transform(string_split(regexp_replace({x}, '[ \\t]+', ' ', 'g'), "
            f"chr(10)), lambda l: trim(l, {WS_SQL})), chr(10))")


@register("clean_wikitext_injected", f"""
SELECT doc_id,
       {sql_strip("'Giới thiệu' || chr(10) || lang || ' và' || chr(10) || "
                  + _clean_lines_sql("source || ' ' || text"))} AS clean
FROM documents""")
def clean_wikitext_injected(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return W.clean_wikitext_df(d.select("doc_id", _inject_col().alias("raw")), "raw", "clean") \
            .select("doc_id", "clean")


# Markup that the steps above it never see: nested tables with orphan rows behind them,
# both kinds of reference, opening, closing and other tags, single brackets, a switch,
# entities, a definition, and a terminal section in other words.
_MARKUP = [
    "{| class=\"wikitable\"\n|-\n| a || {| nested\n|} b\n|}\n", "|- orphan row\n| orphan cell\n|+ caption\n",
    "<span style=\"c\">", "@lang", "</span><ref name=\"x\" />: <REF group=\"n\">cite\nmore</REF><h2>Mục</h2>\n",
    "[https://example.org nhãn ngoài] [en:Foo] [abc:Bar|nhãn]__NOTOC__\n", "; thuật ngữ : định nghĩa\n",
    "&lt;b&gt;&nbsp;x &amp;copy;\n", "<blockquote>trích</blockquote>----\n", "# ", "@source", "''", "@text",
    "''\n== Xem  thêm ==\n* gone",
]


@register("clean_wikitext_markup", f"""
SELECT doc_id,
       {sql_strip("lang || ' : Mục' || chr(10) || '//example.org nhãn ngoài nhãn' || chr(10) || 'thuật ngữ: định nghĩa' || chr(10) || "
                  "'<b> x &copy;' || chr(10) || 'trích' || chr(10) || " + _clean_lines_sql("source || text"))} AS clean
FROM documents""")
def clean_wikitext_markup(spark, sf_dir):
    """P6 over every kind of markup: W2, W4-W7, W9, W11, W14 and W15 change each row."""
    d = table(spark, sf_dir, "documents")
    raw = F.concat(*[F.coalesce(F.col(p[1:]), F.lit("")) if p.startswith("@") else F.lit(p) for p in _MARKUP])
    return W.clean_wikitext_df(d.select("doc_id", raw.alias("raw")), "raw", "clean").select("doc_id", "clean")


@register("wiki_url", """
SELECT p_partkey, 'https://vi.wikipedia.org/wiki/' ||
       replace(replace(replace(replace(url_encode(replace(p_name, ' ', '_')), '%2F', '/'), '%3A', ':'),
               '%7E', '~'), '*', '%2A') AS url
FROM part""")
def wiki_url_q(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", wiki_url("p_name").alias("url"))


@register("wiki_flatten", """
SELECT doc_id AS id, source AS title, text, 'https://vi.wikipedia.org/wiki/' ||
       replace(replace(replace(replace(url_encode(replace(source, ' ', '_')), '%2F', '/'), '%3A', ':'),
               '%7E', '~'), '*', '%2A') AS url
FROM documents WHERE coalesce(text, '') <> ''""")
def wiki_flatten(spark, sf_dir):
    """Documents re-shaped into the nested page-batch API response (one batch
    per source), serialised to JSON and parsed back, then flattened (S7/F5/P5)."""
    d = table(spark, sf_dir, "documents")
    page = F.struct(F.col("doc_id").alias("pageid"), F.col("source").alias("title"),
                    F.array(F.struct(F.struct(F.struct(F.col("text").alias("content")).alias("main"))
                                     .alias("slots"))).alias("revisions"))
    # 50 pages per API batch, as the crawler requests them (bounded groups)
    batches = (d.groupBy(F.floor(F.col("doc_id") / 50).alias("batch"))
               .agg(F.collect_list(page).alias("pages"))
               .select(F.to_json(F.struct(F.struct("pages").alias("query"))).alias("json")))
    parsed = batches.select(F.from_json("json", S.WIKI_API_SCHEMA).alias("r")).select("r.*")
    return S.flatten_wiki_pages(parsed)
