"""Poem/page queries: HTML cleaning on real pages, poem pages and stanzas
built from real documents inside the query, page counters, crawl frontier,
list links, first-seen merge, resume anti-join, incremental ingest."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import poem as PF
from ..functions.text import WS, WS_CODEPOINTS, collapse, is_ascii
from ..operators import incremental as I
from ..operators import poem as PO
from ..sources import formats as S
from .catalog import WS_SQL, register, sql_hash, sql_strip, table

RE2_WS = f"[{WS}]"


def _re2(x: str) -> str:
    return x.replace("'", "''")


def _sql_clean_poem_html(x: str) -> str:
    t = x
    for pat, rep, fl in (("<img[^>]*>", "''", "gi"), ("</img>", "''", "gi"), ("(?s)<i>.*?</i>", "''", "gi"),
                         ("</?b>", "''", "gi"), ("</?div[^>]*>", "''", "gi"), ("</?p>", "''", "gi"),
                         (f"<br{RE2_WS}*/?>", "chr(10)", "gi")):
        t = f"regexp_replace({t}, '{_re2(pat)}', {rep}, '{fl}')"
    # the fixture's entities; '&amp;' last so that nothing is decoded twice
    for ent, ch in (("&quot;", "'\"'"), ("&copy;", "chr(169)"), ("&middot;", "chr(183)"),
                    ("&amp;", "'&'")):
        t = f"replace({t}, '{ent}', {ch})"
    t = f"replace({t}, chr(160), ' ')"
    t = f"regexp_replace({t}, ' +', ' ', 'g')"
    t = f"regexp_replace({t}, '\\n{{3,}}', chr(10) || chr(10), 'g')"
    return sql_strip(t)


@register("poem_html_clean", f"""
SELECT page_id, {_sql_clean_poem_html('html')} AS content FROM pages""")
def poem_html_clean(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", PF.clean_poem_html("html").alias("content"))


# ---------------------------------------------------------------- poem pages from documents
def _poem_page():
    """A poem page per document: caption div, poem-content div with an intro
    (lost), a bold title + two ``br`` variants, the lines as ``<br>``, and a
    second titled poem."""
    return F.concat(
        F.lit('<html><body><div class="small"> Nguồn: '), F.col("source"),
        F.lit(" </div><div class=\"poem-content\">Intro "), F.col("lang"), F.lit("<b>"), F.col("source"),
        F.lit("</b><br/><BR>"), F.replace(F.col("text"), F.lit("\n"), F.lit("<br>")),
        F.lit("<b>Hai</b>\n\n"), F.col("lang"), F.lit("</div></body></html>"))


@register("poem_segments", """
SELECT doc_id, 0::INTEGER AS seg, source AS title, trim(text, chr(10)) AS content,
       'Nguồn: ' || source AS source, lang AS author FROM documents
UNION ALL
SELECT doc_id, 1::INTEGER AS seg, 'Hai' AS title, lang || '</div>' AS content,
       'Nguồn: ' || source AS source, lang AS author FROM documents""")
def poem_segments(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    pages = d.select("doc_id", F.concat(F.lit("poem://"), F.col("doc_id")).alias("url"),
                     F.col("source").alias("title"), _poem_page().alias("html"))
    blocks = pages.withColumn("_b", PF.extract_blocks("html")).filter(F.col("_b.content").isNotNull())
    blocks = blocks.select("doc_id", "url", "title", F.col("_b.content").alias("html"),
                           PF.clean_source(F.col("_b.source")).alias("source"))
    segs = PO.segments(blocks, "html", "title")
    meta = d.select(F.concat(F.lit("poem://"), F.col("doc_id")).alias("url"), F.col("lang").alias("author"))
    out = PO.attach_author(segs, meta)
    return out.select("doc_id", F.col("seg").cast("int"), F.col("poem_title").alias("title"),
                      "content", "source", "author")


@register("clean_poems", f"""
SELECT doc_id, trim(lang || chr(10) || text, {WS_SQL}) AS content,
       CASE WHEN source = 'src3' THEN '' ELSE 'Nguồn: ' || source || '  ' || chr(10) || lang END AS source,
       '<' || lang || '> & ' || source AS title
FROM documents WHERE doc_id % 7 <> 0 AND {sql_strip("lang || text")} <> ''""")
def clean_poems(spark, sf_dir):
    """Captions with the quick-comment phrase, titles with entities, and
    every seventh poem blank once it is cleaned."""
    d = table(spark, sf_dir, "documents")
    body = F.concat(F.lit("<b>"), "lang", F.lit("</b><br/>"), "text")
    df = d.select(
        "doc_id", F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit("<i>"), "source", F.lit("</i> &nbsp;<br>"))).otherwise(body).alias("content"),
        F.when(F.col("source") != "src3", F.concat(F.lit("Nguồn: "), "source", F.lit("  BÌNH luận nhanh "), "lang", F.lit("\n"), "lang"))
        .alias("source"),
        F.concat(F.lit("  &lt;"), "lang", F.lit("&gt; &amp; "), "source", F.lit("\u00a0 ")).alias("title"))
    return PO.clean_poems(df)


@register("content_pages", """
SELECT page_id, url FROM pages WHERE page_id % 3 = 0 AND NOT coalesce(nullif(page_id % 10, 4) IN (1, 6), false)""")
def content_pages(spark, sf_dir):
    """pages of the main namespace that are no redirects (unknown: none)."""
    p = table(spark, sf_dir, "pages")
    last = F.nullif(F.col("page_id") % 10, F.lit(4))
    p = p.select("page_id", "url", (F.col("page_id") % 3).alias("ns"), last.isin(1, 6).alias("redirect"))
    return S.content_pages(p).select("page_id", "url")


# ---------------------------------------------------------------- stanzas
_WORDS_5, _LINES_4 = " ".join(["[^ ]++"] * 5), "\n".join(["[^\n]++"] * 4)


def _stanza_content(d):
    """Re-flow each document into 5-word lines and 4-line stanzas separated by
    a blank line that holds a space: one walk per step, from match to match."""
    words = F.btrim(collapse("text", WS_CODEPOINTS, is_ascii("text")), F.lit(" "))
    lines = F.regexp_replace(words, f"\\G({_WORDS_5}) ", "$1\n")
    return d.select("doc_id", F.regexp_replace(lines, f"\\G({_LINES_4})\n", "$1\n \n").alias("content"))


def _stanza_sql():
    ws = f"[{WS}]"
    words = f"list_filter(string_split(regexp_replace(text, '{ws}+', ' ', 'g'), ' '), lambda w: w <> '')"
    lead = _re2('^["“”‘’]+')
    trail = _re2('["“”‘’":;,\\-–—]+$')
    punct = _re2('[.,!?;:"\'“”‘’\\-–—()]')

    def clean(v):
        t = sql_strip(f"regexp_replace({v}, '{ws}+', ' ', 'g')")
        t = sql_strip(f"regexp_replace({t}, '{lead}', '')")
        t = sql_strip(f"regexp_replace({t}, '{trail}', '')")
        return f"nfc_normalize({t})"

    def cw(v):
        return (f"len(list_filter(regexp_split_to_array(regexp_replace({v}, '{punct}', ' ', 'g'), "
                f"'{ws}+'), lambda x: x <> ''))")

    return f"""
WITH w AS (SELECT doc_id, {words} AS words FROM documents),
l AS (SELECT doc_id, list_transform(range(0, ceil(len(words) / 5)::BIGINT),
                                    lambda i: array_to_string(words[i * 5 + 1:i * 5 + 5], ' ')) AS lines FROM w),
c AS (SELECT doc_id, array_to_string(list_transform(range(0, ceil(len(lines) / 4)::BIGINT),
          lambda j: array_to_string(lines[j * 4 + 1:j * 4 + 4], chr(10))), chr(10) || ' ' || chr(10)) AS content
      FROM l),
r AS (SELECT doc_id, u.raw, (u.k - 1)::INTEGER AS stanza_idx
      FROM c, unnest(regexp_split_to_array({sql_strip('content')}, '\\n{ws}*\\n')) WITH ORDINALITY AS u(raw, k)),
s AS (SELECT doc_id, stanza_idx,
             list_filter(list_transform(list_filter(string_split({sql_strip('raw')}, chr(10)),
                                                    lambda x: {sql_strip('x')} <> ''),
                                        lambda x: {clean('x')}), lambda x: x <> '') AS lines FROM r),
v AS (SELECT doc_id, stanza_idx, array_to_string(lines, chr(10)) AS stanza FROM s
      WHERE len(lines) = 4 AND len(list_filter(lines, lambda x: {cw('x')} <> 5)) = 0)
SELECT stanza, doc_id, stanza_idx FROM (
  SELECT *, row_number() OVER (PARTITION BY stanza ORDER BY doc_id, stanza_idx) AS rn FROM v) WHERE rn = 1"""


@register("stanzas", _stanza_sql())
def stanzas(spark, sf_dir):
    d = _stanza_content(table(spark, sf_dir, "documents").select("doc_id", "text"))
    st = PO.extract_stanzas(d, "content")
    out = PO.distinct_first(st.select("doc_id", F.col("stanza_idx").cast("int"), "stanza"),
                            "stanza", ["doc_id", "stanza_idx"])
    return out


@register("stage2_dedup", f"""
SELECT conv_id, turn, sha256(nfc_normalize(t)) AS h FROM (
  SELECT conv_id, turn, t, row_number() OVER (PARTITION BY {sql_hash('t')} ORDER BY conv_id, turn) AS rn
  FROM (SELECT conv_id, turn, {sql_strip("coalesce(text, '')")} AS t FROM conversations)
  WHERE length(t) >= 20) WHERE rn = 1""")
def stage2_dedup(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    out = PO.dedup_samples(c, ["conv_id", "turn"])
    return out.select("conv_id", "turn", F.sha2("text", 256).alias("h"))


@register("word_count", f"""
SELECT doc_id, len(list_filter(regexp_split_to_array(regexp_replace(coalesce(text, ''),
         '{_re2('[.,!?;:"' + "'" + '“”‘’\\-–—()]')}', ' ', 'g'), '[{WS}]+'), lambda x: x <> ''))::INTEGER AS words
FROM documents""")
def word_count(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", PF.count_words(F.coalesce("text", F.lit(""))).alias("words"))


# ---------------------------------------------------------------- pages: counters, frontier, links
_TOTAL_SQL = f"""coalesce(
  try_cast(nullif(regexp_extract(html, 'tổng số (\\d+) trang', 1), '') AS BIGINT),
  try_cast(nullif(regexp_extract(html, 'Trang[{WS}]+\\d+[{WS}]*/[{WS}]*(\\d+)', 1), '') AS BIGINT),
  list_max(list_transform(regexp_extract_all(html, '(?i)<a\\b[^>]*href="[^"]*?Page=(\\d+)', 1),
                          lambda x: try_cast(x AS BIGINT))),
  1)::BIGINT"""


def _marked_pages(spark, sf_dir):
    """The pages with a counter (all three kinds, by id), and every fifth with a
    block phrase: the page table itself has neither."""
    p = table(spark, sf_dir, "pages")
    n = (F.col("page_id") % 13 + 1).cast("string")
    counter = (F.when(F.col("page_id") % 4 == 0, F.concat(F.lit("<p>tổng số "), n, F.lit(" trang</p>")))
               .when(F.col("page_id") % 4 == 1, F.concat(F.lit("<p>Trang 1 / "), n, F.lit("</p>")))
               .when(F.col("page_id") % 4 == 2, F.concat(F.lit('<a href="?x=1&Page='), n, F.lit('">n</a>')))
               .otherwise(F.lit("")))
    phrase = F.when(F.col("page_id") % 5 == 0, F.lit("<b>Too many requests</b>")).otherwise(F.lit(""))
    return p.withColumn("html", F.concat("html", counter, phrase))


_MARKED_SQL = """SELECT page_id, url, html || CASE page_id % 4
    WHEN 0 THEN '<p>tổng số ' || (page_id % 13 + 1)::VARCHAR || ' trang</p>'
    WHEN 1 THEN '<p>Trang 1 / ' || (page_id % 13 + 1)::VARCHAR || '</p>'
    WHEN 2 THEN '<a href="?x=1&Page=' || (page_id % 13 + 1)::VARCHAR || '">n</a>' ELSE '' END
  || CASE WHEN page_id % 5 = 0 THEN '<b>Too many requests</b>' ELSE '' END AS html FROM pages"""


@register("total_pages", f"SELECT page_id, {_TOTAL_SQL} AS total_pages FROM ({_MARKED_SQL})")
def total_pages(spark, sf_dir):
    return _marked_pages(spark, sf_dir).select("page_id", PF.total_pages("html").alias("total_pages"))


@register("blocked_filter", f"""
SELECT page_id, url FROM ({_MARKED_SQL}) WHERE NOT (
  contains(html, 'Danh sách quá dài') OR contains(html, 'Access denied') OR
  contains(html, 'Too many requests') OR contains(html, '403 Forbidden') OR
  contains(html, 'Xác nhận không phải máy'))""")
def blocked_filter(spark, sf_dir):
    return _marked_pages(spark, sf_dir).filter(~PF.is_blocked("html")).select("page_id", "url")


@register("frontier", f"""
WITH t AS (SELECT page_id, (page_id % 11)::INTEGER AS cfg, {_TOTAL_SQL} AS total,
                  CASE WHEN page_id % 7 = 0 THEN 'Unknown' ELSE regexp_extract(url, '://([^/]+)', 1) END AS author
           FROM ({_MARKED_SQL})),
a AS (SELECT author, arg_min(total, page_id) AS total FROM t WHERE author NOT IN ('', 'Unknown') GROUP BY author),
c AS (SELECT cfg, arg_min(total, page_id) AS total FROM t WHERE cfg <> 4 GROUP BY cfg),
cfg AS (SELECT * FROM (VALUES {", ".join(f"({i}, '{s}', '{o}')" for i, (s, o) in enumerate(PF.SORT_CONFIGS))})
        v(cfg, sort, sort_order))
SELECT 'sort' AS kind, cfg::VARCHAR AS seed, p::BIGINT AS page,
       '{PF.SEARCH_URL}' || CASE WHEN sort <> '' THEN '&Sort=' || sort ELSE '' END ||
       CASE WHEN sort_order <> '' THEN '&SortOrder=' || sort_order ELSE '' END || '&Page=' || p::VARCHAR AS url
FROM cfg LEFT JOIN c USING (cfg),
     LATERAL (SELECT unnest(generate_series(1, least(coalesce(c.total, 1), {PF.MAX_PAGES}))) AS p)
UNION ALL
SELECT 'author' AS kind, author AS seed, p::BIGINT AS page,
       '{PF.AUTHOR_URL}' || replace(url_encode(author), '%2F', '/') || '&Page=' || p::VARCHAR AS url
FROM a, LATERAL (SELECT unnest(generate_series(1, least(a.total, {PF.MAX_PAGES}))) AS p)""")
def frontier(spark, sf_dir):
    """Pages stand for first list pages: of configuration page_id % 11 (beyond the
    last, and configuration 4, never seen) and of an author (its host)."""
    p = _marked_pages(spark, sf_dir).select(
        "page_id", (F.col("page_id") % 11).cast("int").alias("cfg"), PF.total_pages("html").alias("total"),
        F.when(F.col("page_id") % 7 == 0, F.lit("Unknown")).otherwise(
            F.regexp_extract("url", "://([^/]+)", 1)).alias("author"))
    first = I.first_seen(p.select("cfg", "page_id", "total").filter("cfg <> 4"), "cfg", ["page_id"])
    authors = I.first_seen(p.select("author", "page_id", "total"), "author", ["page_id"])
    return I.frontier(first, authors)


_LI = '<li><a href="([^"]*)">([^<]*)</a></li>'


@register("list_links", f"""
SELECT page_id, (u.k - 1)::INTEGER AS item_idx, {sql_strip('regexp_extract(u.li, \'' + _re2(_LI) + '\', 2)')} AS title,
       regexp_extract(u.li, '{_re2(_LI)}', 1) AS url,
       coalesce(nullif({sql_strip('regexp_extract(u.li, ' + "'" + _re2(_LI) + "'" + ', 2)')}, ''), 'Unknown') AS author
FROM pages, unnest(regexp_extract_all(html, '{_re2(_LI)}')) WITH ORDINALITY AS u(li, k)
WHERE regexp_extract(u.li, '{_re2(_LI)}', 1) <> ''""")
def list_links(spark, sf_dir):
    """Each page's nav list re-marked as list items (header link + author link)."""
    p = table(spark, sf_dir, "pages")
    listed = F.regexp_replace("html", _LI, '<div class="list-item"><div class="head"><h4 class="list-item-header">'
                                           '<a href="$1">$2</a></h4></div><div>by <a href="/author-x">$2</a></div></div>')
    items = p.select("page_id", F.posexplode(PF.list_items(listed)).alias("item_idx", "it"))
    return items.select("page_id", F.col("item_idx").cast("int"), "it.title", "it.url", "it.author")


# ---------------------------------------------------------------- resume / first seen / ingest
@register("resume_anti_join", """
SELECT page_id, url FROM pages p
WHERE NOT EXISTS (SELECT 1 FROM pages d WHERE starts_with(d.url, 'https') AND d.url = p.url)""")
def resume_anti_join(spark, sf_dir):
    """Pages fetched over https count as done; the rest are pending."""
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    done = p.filter(F.col("url").startswith("https")).select("url")
    return I.pending(p, done, "url")


@register("resume_capped", """
WITH d AS (SELECT DISTINCT url FROM pages WHERE starts_with(url, 'https'))
SELECT page_id, url FROM pages p WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.url = p.url)
ORDER BY page_id LIMIT greatest(200 - (SELECT count(*) FROM d), 0)""")
def resume_capped(spark, sf_dir):
    """Stop at 200 articles in total, already finished ones included."""
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    done = p.filter(F.col("url").startswith("https")).select("url")
    return I.pending_capped(p, done, "url", 200, ["page_id"])


_CRAWL_SQL = f"""
crawl AS (
  SELECT 1 AS phase, (page_id * 1000 + u.k)::BIGINT AS seq, regexp_extract(u.li, '{_re2(_LI)}', 1) AS url,
         regexp_extract(u.li, '{_re2(_LI)}', 2) AS title, regexp_extract(p.url, '://([^/]+)', 1) AS author
  FROM pages p, unnest(regexp_extract_all(html, '{_re2(_LI)}')) WITH ORDINALITY AS u(li, k)
  UNION ALL
  SELECT 2 AS phase, (page_id * 1000 + u.k)::BIGINT AS seq, regexp_extract(u.li, '{_re2(_LI)}', 1) AS url,
         regexp_extract(u.li, '{_re2(_LI)}', 2) AS title, 'searched:' || regexp_extract(p.url, '://([^/]+)', 1)
  FROM pages p, unnest(regexp_extract_all(html, '{_re2(_LI)}')) WITH ORDINALITY AS u(li, k))"""


def _crawl(spark, sf_dir):
    """List-crawl (phase 1) and author-crawl (phase 2) rows from each page's nav
    links; the author crawl names the searched author."""
    p = table(spark, sf_dir, "pages")
    li = p.select("page_id", F.regexp_extract("url", "://([^/]+)", 1).alias("host"),
                  F.posexplode(F.regexp_extract_all("html", F.lit(_LI), 0)).alias("k", "li"))
    base = li.select((F.col("page_id") * 1000 + F.col("k") + 1).cast("long").alias("seq"),
                     F.regexp_extract("li", _LI, 1).alias("url"), F.regexp_extract("li", _LI, 2).alias("title"),
                     "host")
    a = base.select(F.lit(1).alias("phase"), "seq", "url", "title", F.col("host").alias("author"))
    b = base.select(F.lit(2).alias("phase"), "seq", "url", "title",
                    F.concat(F.lit("searched:"), F.col("host")).alias("author"))
    return a.unionByName(b)


@register("first_seen", f"""
WITH {_CRAWL_SQL}
SELECT url, phase, seq, title, author FROM (
  SELECT *, row_number() OVER (PARTITION BY url ORDER BY phase, seq) AS rn FROM crawl) WHERE rn = 1""")
def first_seen(spark, sf_dir):
    return I.first_seen(_crawl(spark, sf_dir), "url", ["phase", "seq"]).select(
        "url", "phase", "seq", "title", "author")


@register("known_authors", f"""
WITH {_CRAWL_SQL}
SELECT DISTINCT author FROM crawl WHERE phase = 1 AND author <> 'Unknown'""")
def known_authors(spark, sf_dir):
    return I.known_authors(_crawl(spark, sf_dir).filter(F.col("phase") == 1))


@register("incremental_ingest", """
WITH m AS (SELECT max(doc_id) AS mx FROM documents),
existing AS (SELECT doc_id FROM documents, m WHERE doc_id < m.mx / 2),
batch AS (SELECT doc_id, source, text FROM documents, m WHERE doc_id >= m.mx * 2 / 5)
SELECT doc_id, source, sha256(text) AS h FROM batch b
WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE e.doc_id = b.doc_id)""")
def incremental_ingest(spark, sf_dir):
    """R1 batch form: the table holds the first half of the documents; a new
    batch overlapping it by a tenth of the ids is ingested exactly once."""
    d = table(spark, sf_dir, "documents")
    mx = d.agg(F.max("doc_id").alias("mx"))
    d = d.crossJoin(mx)  # one row
    existing = d.filter(F.col("doc_id") < F.col("mx") / 2).select("doc_id")
    batch = d.filter(F.col("doc_id") >= F.col("mx") * 2 / 5).select("doc_id", "source", "text")
    return I.ingest_new(batch, existing, "doc_id").select("doc_id", "source", F.sha2("text", 256).alias("h"))
