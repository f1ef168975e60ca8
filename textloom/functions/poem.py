"""Poem-page cleaning and parsing as Column expressions (P7-P12, P18, F7,
G3/G4/G5 building blocks).  Native regex throughout; HTML entity decoding and
the HTML block extraction (G4) are the only Python pieces."""

from __future__ import annotations

from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import JAVA_WS, WS_CODEPOINTS, collapse, html_unescape, is_ascii, java_class, nfc, ustrip

S = f"[{JAVA_WS}]"

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------
QUICK_COMMENT = "Bình luận nhanh"                 # caption tail removed by P8
LEADING_QUOTES = "\"“”‘’"
TRAILING_PUNCT = "\"“”‘’\":;,\\-–—"
WORD_PUNCT = ".,!?;:\"'“”‘’\\-–—()"
LIST_PAGE_BLOCKS = ("Danh sách quá dài", "Access denied", "Too many requests", "403 Forbidden")
POEM_PAGE_BLOCK = "Xác nhận không phải máy"
LINES_PER_STANZA = 4
WORDS_PER_LINE = 5
MAX_PAGES = 10
SORT_CONFIGS = [("", ""), ("Author", "asc"), ("Author", "desc"), ("Views", "desc"),
                ("Views", "asc"), ("Date", "asc"), ("Date", "desc"), ("Poster", "asc"),
                ("Poster", "desc")]
SEARCH_URL = "https://www.thivien.net/search-poem.php?PoemType=16&Country=2"
AUTHOR_URL = "https://www.thivien.net/search-poem.php?PoemType=16&Author="


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --------------------------------------------------------------------------- P7-P12
def clean_poem_html(col) -> Column:
    """P7, in order: img tags out; <i>..</i> out with contents (across lines);
    b/div/p tags out keeping contents; br -> newline; entities; NBSP -> space;
    runs of spaces -> 1; 3+ newlines -> 2; strip."""
    t = _c(col)
    for pat, rep in (("(?iu)<img[^>]*>", ""), ("(?iu)</img>", ""), ("(?isu)<i>.*?</i>", ""),
                     ("(?iu)</?b>", ""), ("(?iu)</?div[^>]*>", ""), ("(?iu)</?p>", ""),
                     (f"(?iu)<br{S}*/?>", "\n")):
        t = F.regexp_replace(t, pat, rep)
    t = F.translate(html_unescape(t), "\u00a0", " ")
    t = F.regexp_replace(t, " +", " ")
    t = F.regexp_replace(t, "\\n{3,}", "\n\n")
    return ustrip(t)


def clean_source(col) -> Column:
    """null/'' -> ''; drop from the quick-comment phrase to end of line; strip."""
    t = F.coalesce(_c(col), F.lit(""))
    return ustrip(F.regexp_replace(t, f"(?iud){QUICK_COMMENT}.*", ""))


def clean_title(col) -> Column:
    """P10: entities decoded, stripped, null -> ''."""
    return ustrip(html_unescape(F.coalesce(_c(col), F.lit(""))))


def clean_line_no_nfc(col) -> Column:
    """P11 without the final NFC (usable inside higher-order functions)."""
    t = ustrip(F.regexp_replace(_c(col), f"{S}+", " "))
    t = ustrip(F.regexp_replace(t, f"^[{LEADING_QUOTES}]+", ""))
    return ustrip(F.regexp_replace(t, f"[{TRAILING_PUNCT}]+\\z", ""))


def clean_line(col) -> Column:
    """Whitespace runs -> 1 space, strip; leading quotes; trailing quotes,
    ``: ; ,`` and dashes; NFC."""
    return nfc(clean_line_no_nfc(col))


def count_words(col) -> Column:
    """Punctuation (incl. dashes, parentheses, quotes) -> space, then the
    number of whitespace-separated words."""
    t = F.regexp_replace(_c(col), f"[{WORD_PUNCT}]", " ")
    return F.size(F.filter(F.split(t, f"{S}+"), lambda x: x != ""))


def is_stanza(lines: Column, n_lines: int = LINES_PER_STANZA, n_words: int = WORDS_PER_LINE) -> Column:
    """exactly ``n_lines`` lines of exactly ``n_words`` words each."""
    return (F.size(lines) == n_lines) & F.forall(lines, lambda x: count_words(x) == n_words)


#: What parts words of a cleaned line; what a line ends with.
_PART = java_class(map(ord, " " + WORD_PUNCT.replace("\\", "")))
_TAIL = java_class(map(ord, TRAILING_PUNCT.replace("\\", "")))
#: Stands between stanzas once their white space is single spaces and line breaks.
STANZA_MARK = "\t"


def clean_stanzas(content) -> Column:
    """G2 and P11 (without NFC) on a whole poem: its stanzas with ``STANZA_MARK`` between them,
    lines cleaned as by ``clean_line_no_nfc``, empty ones dropped.  Every step walks the text once."""
    t = collapse(ustrip(F.coalesce(_c(content), F.lit(""))), set(WS_CODEPOINTS) - {0x0A}, is_ascii(content))
    for pat, rep in (("\\n[ \\n]*\\n", STANZA_MARK), (" ?([\\n\\t]) ?", "$1"),
                     (f"([\\n\\t]|\\A)[{LEADING_QUOTES}]+ ?", "$1"),
                     (f" ?(?=[{_TAIL}])(?<![{_TAIL}])[{_TAIL}]++(?=[\\n\\t]|\\z)", ""),
                     ("\\n{2,}", "\n"), ("\\n?\\t\\n?", STANZA_MARK)):
        t = F.regexp_replace(t, pat, rep)
    return F.btrim(t, F.lit("\n"))


def is_clean_stanza(stanza, n_lines: int = LINES_PER_STANZA, n_words: int = WORDS_PER_LINE) -> Column:
    """F9 on the cleaned lines of a stanza, joined: ``n_lines`` of ``n_words`` words (P12); a
    space is the only white space left in a line, and NFC makes none."""
    def pattern(part: str) -> str:
        line = f"[{part}]*+" + f"[{part}]++".join([f"[^\\n{part}]++"] * n_words) + f"[{part}]*+"
        return "\\A" + "\\n".join([line] * n_lines) + "\\z"

    s = _c(stanza)
    ascii_part = java_class(ord(c) for c in " " + WORD_PUNCT.replace("\\", "") if c.isascii())
    return F.when(is_ascii(s), s.rlike(pattern(ascii_part))).otherwise(s.rlike(pattern(_PART)))


# --------------------------------------------------------------------------- pages
def total_pages(html) -> Column:
    """P18: "tổng số N trang", else "Trang x / N", else the largest Page=N in a
    link href, else 1."""
    h = _c(html)
    a = F.nullif(F.regexp_extract(h, "tổng số (\\d+) trang", 1), F.lit("")).try_cast("long")
    b = F.nullif(F.regexp_extract(h, f"Trang{S}+\\d+{S}*/{S}*(\\d+)", 1), F.lit("")).try_cast("long")
    hrefs = F.regexp_extract_all(h, F.lit("(?i)<a\\b[^>]*href=\"[^\"]*?Page=(\\d+)"), 1)
    c = F.array_max(F.transform(hrefs, lambda x: x.try_cast("long")))
    return F.coalesce(a, b, c, F.lit(1).cast("long"))


def is_blocked(html, phrases=LIST_PAGE_BLOCKS + (POEM_PAGE_BLOCK,)) -> Column:
    """page contains any block phrase."""
    h = _c(html)
    out = F.lit(False)
    for p in phrases:
        out = out | h.contains(p)
    return F.coalesce(out, F.lit(False))


_TITLE = f"<b>(.*?)</b>{S}*\\n{{2,}}"
# A split mark in front of each title; a U+0000 of the page itself is written as _ZERO meanwhile.
_MARK, _ZERO = "\u0000m", "\u0000z"


def segment_poems(html, default_title) -> Column:
    """array<struct<title, content>>.  ``br`` -> newline; each single-line
    bold title followed by 2+ newlines starts a poem that runs to the next title
    (newline-stripped); text before the first title is dropped; no title -> one
    poem with the default title and the whole html.  A page may hold any character."""
    h = F.regexp_replace(_c(html), f"(?iu)<br{S}*/?>", "\n")
    marked = F.regexp_replace(F.replace(h, F.lit("\u0000"), F.lit(_ZERO)), f"(?iud){_TITLE}", _MARK + "$0")
    parts = F.split(marked, _MARK, -1)
    segs = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(1))),
                       lambda s: F.replace(s, F.lit(_ZERO), F.lit("\u0000")))
    found = F.transform(segs, lambda s: F.struct(
        ustrip(F.regexp_extract(s, f"(?iud)^{_TITLE}", 1)).alias("title"),
        F.btrim(F.regexp_replace(s, f"(?iud)^{_TITLE}", ""), F.lit("\n")).alias("content")))
    single = F.array(F.struct(_c(default_title).alias("title"), h.alias("content")))
    return F.when(F.size(parts) > 1, found).otherwise(single)


class _Blocks(HTMLParser):
    """First div with class ``poem-content`` (outer html, raw source) and the
    text of the first div with class ``small`` (chunks stripped, joined)."""

    def __init__(self, src):
        super().__init__(convert_charrefs=True)
        self.src, self.lines = src, None
        self.content = None
        self._cstart = None
        self._cdepth = 0
        self.small = None
        self._sdepth = 0
        self._stext = []

    def _offset(self):
        if self.lines is None:
            self.lines = [0]
            for ln in self.src.split("\n"):          # the parser counts "\n" only
                self.lines.append(self.lines[-1] + len(ln) + 1)
        line, col = self.getpos()
        return self.lines[line - 1] + col

    def handle_starttag(self, tag, attrs):
        if tag != "div":
            return
        classes = (dict(attrs).get("class") or "").split()
        if self._cdepth:
            self._cdepth += 1
        elif self.content is None and "poem-content" in classes:
            self._cstart, self._cdepth = self._offset(), 1
        if self._sdepth:
            self._sdepth += 1
        elif self.small is None and "small" in classes:
            self._sdepth = 1

    def handle_endtag(self, tag):
        if tag != "div":
            return
        if self._cdepth:
            self._cdepth -= 1
            if self._cdepth == 0:
                end = self._offset() + len(self.get_endtag_text())
                self.content = self.src[self._cstart:end]
        if self._sdepth:
            self._sdepth -= 1
            if self._sdepth == 0:
                self.small = "".join(self._stext)

    def get_endtag_text(self):
        rest = self.src[self._offset():]
        k = rest.find(">")
        return rest[:k + 1] if k >= 0 else rest

    def handle_data(self, data):
        if self._sdepth:
            s = data.strip()
            if s:
                self._stext.append(s)


_BLOCK_TYPE = T.StructType([T.StructField("content", T.StringType()),
                            T.StructField("source", T.StringType())])


#: Pages that a task parses at a time: a batch has as many rows as the session says, and
#: their strings would take several times its size.
PAGES = 64


def _parse_blocks(s: pa.Array) -> pa.Array:
    content, small = [], []
    for x in s.to_pylist():
        if x is None:
            content.append(None)
            small.append(None)
            continue
        p = _Blocks(x)
        p.feed(x)
        p.close()
        if p._cdepth and p.content is None:          # unclosed div: to end of text
            p.content = x[p._cstart:]
        content.append(p.content)
        small.append(p.small if p.small is not None else ("".join(p._stext) if p._sdepth else None))
    return pa.StructArray.from_arrays([pa.array(content, pa.string()), pa.array(small, pa.string())],
                                      fields=list(_BLOCK_TYPE_PA))


@F.arrow_udf(_BLOCK_TYPE)
def _blocks_arrow(s: pa.Array) -> pa.Array:
    return pa.concat_arrays([_parse_blocks(s.slice(at, PAGES)) for at in range(0, max(len(s), 1), PAGES)])


# A filter on the blocks must not be moved below them: it would parse every page once more.
_blocks_arrow = _blocks_arrow.asNondeterministic()


_BLOCK_TYPE_PA = [pa.field("content", pa.string()), pa.field("source", pa.string())]


def extract_blocks(html) -> Column:
    """struct(content = outer html of the first poem-content div or null,
    source = stripped text of the first small div or null).  Only pages that
    mention ``poem-content`` reach Python."""
    h = _c(html)
    return _blocks_arrow(F.when(h.contains("poem-content"), h))


# --------------------------------------------------------------------------- list pages
# Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


class _Items(HTMLParser):
    """Items (``div class="list-item"``) in page order: the first link that is a child of
    an ``h4 class="list-item-header"`` at any depth below the item, and the first link
    whose address holds ``/author-``."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, int | None]] = []  # (tag, is a header, item it begins)
        self.items: list[dict] = []
        self.links: list[tuple[int, list, list]] = []       # open links: (depth, targets, text)

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            return
        attrs = dict(attrs)
        item = None
        if tag == "div" and attrs.get("class") == "list-item":
            item = len(self.items)
            self.items.append({"title": None, "url": None, "author": None})
        if tag == "a":
            href, targets = attrs.get("href") or "", []
            below_header = bool(self.open) and self.open[-1][1]
            for i in {x[2] for x in self.open if x[2] is not None}:
                for name, holds in (("title", below_header), ("author", "/author-" in href)):
                    if holds and self.items[i][name] is None:
                        self.items[i][name] = ""
                        targets.append((i, name))
                        if name == "title":
                            self.items[i]["url"] = href
            if targets:
                self.links.append((len(self.open), targets, []))
        self.open.append((tag, tag == "h4" and attrs.get("class") == "list-item-header", item))

    def handle_endtag(self, tag):
        at = next((k for k in range(len(self.open) - 1, -1, -1) if self.open[k][0] == tag), None)
        if at is not None:  # a stray end tag closes nothing
            del self.open[at:]
            self.end_links(at)

    def end_links(self, depth):
        while self.links and self.links[-1][0] >= depth:
            _, targets, text = self.links.pop()
            for i, name in targets:
                self.items[i][name] = "".join(text).strip()

    def handle_data(self, data):
        for _, _, text in self.links:
            text.append(data)

    def result(self) -> list[dict]:
        self.end_links(0)
        return [{"title": x["title"], "url": x["url"], "author": x["author"] or "Unknown"} for x in self.items if x["url"]]


_ITEM_FIELDS = ("title", "url", "author")
_ITEM_TYPE = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in _ITEM_FIELDS]))


@F.arrow_udf(_ITEM_TYPE)
def _items_arrow(s: pa.Array) -> pa.Array:
    out = []
    for x in s.to_pylist():
        if x is None:
            out.append([])
            continue
        p = _Items()
        p.feed(x)
        p.close()
        out.append(p.result())
    return pa.array(out, pa.list_(pa.struct([(n, pa.string()) for n in _ITEM_FIELDS])))


def list_items(html) -> Column:
    """array<struct<title, url, author>> of a list page's items, by the page's
    structure: elements inside an item do not end it.  Items without a URL are dropped;
    missing/empty author -> 'Unknown'.  Only pages that mention ``list-item`` reach
    Python."""
    h = _c(html)
    return _items_arrow(F.when(h.contains("list-item"), h))
