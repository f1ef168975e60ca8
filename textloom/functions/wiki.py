"""Wikitext -> plain text, as a chain of Column expressions (steps W1..W18).

Regex steps are native ``regexp_replace`` (Java regex with ``(?d)`` so only
``\\n`` ends a line, ``(?u)`` for Unicode case folding, and the explicit
Python whitespace class in place of ``\\s``).  Only the three nesting-aware
scanners (tables, templates, links) and HTML entity decoding run in Python,
as Arrow-batched UDFs that receive NULL for rows without the delimiter.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import WS, html_unescape, ulstrip, urstrip, ustrip

S = f"[{WS}]"          # one Python-whitespace character

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------
# Opening tags replaced by a space.
BLOCK_TAGS = ("div", "span", "small", "big", "b", "i", "u", "s", "br", "p", "table", "tr", "th", "td",
              "ul", "ol", "li", "dl", "dt", "dd", "sub", "sup", "blockquote", "nowiki", "code", "pre",
              "gallery", "imagemap", "timeline", "score", "syntaxhighlight", "source", "poem", "section",
              "indicator", "templatestyles", "hiero", "math", "chem")
# Link targets that are media or category links (W10), lower case, '_' as ' '.
MEDIA_PREFIXES = ("file:", "image:", "tập tin:", "hình:", "ảnh:",
                  "category:", "thể loại:", "media:")
# Terminal section names (W17); words are separated by any whitespace.
TERMINAL_SECTIONS = ("Tham khảo", "Chú thích", "Ghi chú", "Liên kết ngoài",
                     "Xem thêm", "Thư mục", "Đọc thêm", "Nguồn tham khảo",
                     "Chú giải", "Ghi chú và tham khảo",
                     "References?", "External links?", "See also", "Notes?",
                     "Bibliography", "Further reading")
# Line boundaries of Python's str.splitlines().
SPLITLINES = "\\r\\n|[\\n\\r\\x0B\\x0C\\x1C\\x1D\\x1E\\x{85}\\x{2028}\\x{2029}]"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --------------------------------------------------------------------------- W1-W6
def strip_comments(col) -> Column:
    return F.regexp_replace(_c(col), "(?s)<!--.*?-->", "")


def strip_ref_selfclosed(col) -> Column:
    return F.regexp_replace(_c(col), f"(?iu)<ref[^>]*/{S}*>", "")


def strip_ref_pairs(col) -> Column:
    return F.regexp_replace(_c(col), "(?isu)<ref[^>]*>.*?</ref>", "")


def strip_open_tags(col) -> Column:
    return F.regexp_replace(_c(col), "(?iu)<(" + "|".join(BLOCK_TAGS) + ")[^>]*>", " ")


def strip_close_tags(col) -> Column:
    return F.regexp_replace(_c(col), "(?iu)</[a-z]+>", " ")


def strip_other_tags(col) -> Column:
    return F.regexp_replace(_c(col), "<[^>]+>", "")


# --------------------------------------------------------------------------- scanners
_TABLE_TOK = re.compile(r"\{\||\|\}")
_TMPL_TOK = re.compile(r"\{\{|\}\}")
_LINK_TOK = re.compile(r"\[\[|\]\]")


def _drop_nested(text: str, tok: re.Pattern, opener: str, keep_stray_closer: bool) -> str:
    """Delete balanced opener..closer spans (nesting-aware) in one pass over the
    delimiter positions.  An unclosed opener deletes the rest of the text.  A
    closer at depth 0 is kept as text or dropped, per ``keep_stray_closer``."""
    out, depth, last = [], 0, 0
    for m in tok.finditer(text):
        if depth == 0:
            out.append(text[last:m.start()])
        if m.group() == opener:
            depth += 1
        elif depth > 0:
            depth -= 1
        elif keep_stray_closer:
            out.append(m.group())
        last = m.end()
    if depth == 0:
        out.append(text[last:])
    return "".join(out)


def _resolve_links(text: str) -> str:
    """[[target|label]] -> label, [[target]] -> target, media/category -> ''.
    Nesting-aware match of the closing brackets; inner links are not resolved
    again; an unclosed link takes the rest of the text minus its last 2 chars."""
    out, i, n = [], 0, len(text)
    while True:
        k = text.find("[[", i)
        if k < 0:
            out.append(text[i:])
            break
        out.append(text[i:k])
        depth, j = 1, n
        for m in _LINK_TOK.finditer(text, k + 2):
            depth += 1 if m.group() == "[[" else -1
            if depth == 0:
                j = m.end()
                break
        inner = text[k + 2:j - 2]
        low = inner.lower().replace("_", " ")
        if not low.startswith(MEDIA_PREFIXES):
            out.append(inner.split("|", 1)[-1])
        i = j
    return "".join(out)


@F.arrow_udf(T.StringType())
def _tables_templates_arrow(s: pa.Array) -> pa.Array:
    res = []
    for x in s.to_pylist():
        if x is not None:
            x = _drop_nested(x, _TABLE_TOK, "{|", keep_stray_closer=True)
            x = _drop_nested(x, _TMPL_TOK, "{{", keep_stray_closer=False)
        res.append(x)
    return pa.array(res, type=pa.string())


@F.arrow_udf(T.StringType())
def _links_arrow(s: pa.Array) -> pa.Array:
    return pa.array([None if x is None else _resolve_links(x) for x in s.to_pylist()],
                    type=pa.string())


def strip_tables_templates(col) -> Column:
    """W7 then W8; rows without braces never reach Python."""
    c = _c(col)
    return F.coalesce(_tables_templates_arrow(F.when(c.contains("{") | c.contains("}"), c)), c)


def resolve_links(col) -> Column:
    """W10; rows without ``[[`` never reach Python."""
    c = _c(col)
    return F.coalesce(_links_arrow(F.when(c.contains("[["), c)), c)


# --------------------------------------------------------------------------- W9, W11-W14
# Patterns and replacements in order, as Java regex; ``python_rules`` has them for ``re``.
ORPHAN_ROWS = ((f"(?md)^{S}*\\|[-+|].*\\n?", ""), (f"(?md)^{S}*\\| [^\\n]*\\n?", ""))
INTERWIKI = (("\\[([a-z][a-z0-9_-]*):([^\\]|]*)\\|([^\\]]+)\\]", "$3"),  # labelled
             ("\\[[a-z]{2}:[^\\]]+\\]", ""),                            # of a language
             ("\\[[a-z][a-z0-9_-]*:([^\\]]+)\\]", "$1"))
EXTERNAL = ((f"\\[https?://[^{WS}\\]]+{S}+([^\\]]+)\\]", "$1"), ("\\[https?://[^\\]]+\\]", ""))
HEADERS = ((f"(?md)^=+{S}*(.+?){S}*=+{S}*$", "$1"), (f"(?md)^=+{S}*=+{S}*$", ""))
EMPHASIS = (("'''|''|----+", ""),)
SWITCHES = (("__[A-Z_]+__", ""),)


def _apply(col, rules) -> Column:
    t = _c(col)
    for pattern, replacement in rules:
        t = F.regexp_replace(t, pattern, replacement)
    return t


def python_rules(rules) -> list[tuple[re.Pattern, str]]:
    """The same rules for ``re``, whose ``\\s`` is the white space class and whose lines end
    at ``\\n`` only."""
    return [(re.compile(p.replace("(?md)", "(?m)").replace(f"[^{WS}\\]]", r"[^\s\]]").replace(S, r"\s")),
             r.replace("$", "\\")) for p, r in rules]


def link_rules(links: str = "code"):
    """W11 in the order of the code or as documented (``resolve_external``)."""
    return EXTERNAL + INTERWIKI if links == "documented" else INTERWIKI + EXTERNAL


def strip_orphan_rows(col) -> Column:
    return _apply(col, ORPHAN_ROWS)


def resolve_external(col, links: str = "code") -> Column:
    """Five ordered single-bracket rules.  ``links='code'`` (default) keeps
    the original order, where the last two cannot fire because the third
    already takes any lower-case ``scheme:rest`` (``[https://x lbl]`` becomes
    ``//x lbl``).  ``links='documented'`` applies the two external-link rules
    first, giving ``lbl`` and ``''`` as documented."""
    return _apply(col, link_rules(links))


def strip_headers(col) -> Column:
    return _apply(col, HEADERS)


def strip_emphasis(col) -> Column:
    return _apply(col, EMPHASIS)


def strip_switches(col) -> Column:
    return _apply(col, SWITCHES)


def decode_entities(col) -> Column:
    """HTML entities, then NBSP -> space."""
    return F.translate(html_unescape(_c(col)), "\u00a0", " ")


# --------------------------------------------------------------------------- W16
def split_lines(col) -> Column:
    """Python ``str.splitlines()`` as an array (no trailing empty element)."""
    c = _c(col)
    parts = F.split(c, SPLITLINES, -1)
    ends = c.rlike(f"(?:{SPLITLINES})\\z")
    return (F.when(c == "", F.array().cast("array<string>"))
            .when(ends, F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts))


def _list_line(line: Column) -> Column:
    s = ulstrip(line)
    prefix = F.regexp_extract(s, "^([*#;:]+)", 1)
    content = F.regexp_replace(s, f"^[*#;:]+{S}?", "")
    cut = F.instr(content, ": ")
    term = ustrip(F.substring(content, 1, cut - 1))
    defn = ustrip(F.substring(content, cut + 2, 1 << 30))
    definition = F.concat(term, F.when(defn != "", F.concat(F.lit(": "), defn)).otherwise(F.lit("")))
    content = F.when(prefix.contains(";") & (cut > 0), definition).otherwise(content)
    content = F.regexp_replace(content, f"^[{WS}:]+", "")
    return F.when(prefix != "", content).otherwise(line)


def strip_lists(col) -> Column:
    """Per line, drop list/definition prefixes ``* # ; :``; ``; a : b``
    becomes ``a: b``.  Line breaks are normalised to ``\\n`` (splitlines)."""
    return F.array_join(F.transform(split_lines(col), _list_line), "\n")


# --------------------------------------------------------------------------- W17, W18
def _terminal_regex() -> str:
    names = "|".join(n.replace(" ", f"{S}+") for n in TERMINAL_SECTIONS)
    return f"(?imdu)^{S}*=*{S}*({names}){S}*=*{S}*$"


def cut_terminal(col) -> Column:
    """Cut from the first stand-alone terminal-section line, right-strip."""
    c = _c(col)
    parts = F.split(c, _terminal_regex(), 2)
    return F.when(F.size(parts) > 1, urstrip(F.element_at(parts, 1))).otherwise(c)


def collapse_space(col) -> Column:
    """Runs of spaces/tabs -> one space, 3+ newlines -> 2, strip lines and text."""
    t = F.regexp_replace(_c(col), "[ \\t]+", " ")
    t = F.regexp_replace(t, "\\n{3,}", "\n\n")
    return ustrip(F.array_join(F.transform(split_lines(t), lambda x: ustrip(x)), "\n"))


# --------------------------------------------------------------------------- W7-W15 at once
_BRACE_TOK = re.compile(r"\{\||\|\}|\{\{|\}\}")


def scan_braces(text: str) -> str:
    """Tables first, templates in what is left.  One pass over the delimiters
    of both where they do not touch each other; texts in which two share a character
    (``{{|``, ``|}}``) or which hold no table take the two passes or the one needed."""
    tables, templates = "{|" in text or "|}" in text, "{{" in text or "}}" in text
    if not tables:
        return _drop_nested(text, _TMPL_TOK, "{{", keep_stray_closer=False) if templates else text
    if not templates:
        return _drop_nested(text, _TABLE_TOK, "{|", keep_stray_closer=True)
    tokens = list(_BRACE_TOK.finditer(text))
    if any(x in text for x in ("{{|", "|}}", "{{{", "}}}")) or _joined_by_tables(text, tokens):
        text = _drop_nested(text, _TABLE_TOK, "{|", keep_stray_closer=True)
        return _drop_nested(text, _TMPL_TOK, "{{", keep_stray_closer=False)
    out, table, template, last = [], 0, 0, 0
    for m in tokens:
        token = m.group()
        if not table and not template:
            out.append(text[last:m.start()])
        if token == "{|":
            table += 1
        elif token == "|}":
            if table:
                table -= 1
            elif not template:
                out.append(token)  # a stray closer stays
        elif not table:            # templates are looked for outside tables only
            template = template + 1 if token == "{{" else max(template - 1, 0)
        last = m.end()
    if not table and not template:
        out.append(text[last:])
    return "".join(out)


def _joined_by_tables(text: str, tokens: list[re.Match]) -> bool:
    """Removing a table would bring braces on both of its sides together."""
    depth = begin = 0
    for m in tokens:
        if m.group() == "{|":
            begin = m.start() if depth == 0 else begin
            depth += 1
        elif m.group() == "|}" and depth:
            depth -= 1
            if depth == 0 and begin and m.end() < len(text) and text[begin - 1] in "{}" and text[m.end()] in "{}":
                return True
    return False


def _middle(links: str):
    rules = [python_rules(r) for r in (ORPHAN_ROWS, link_rules(links) + HEADERS + EMPHASIS + SWITCHES)]

    @F.arrow_udf(T.StringType())
    def middle(s: pa.Array) -> pa.Array:
        out = []
        for x in s.to_pylist():
            if x is not None:
                x = scan_braces(x)
                for p, r in rules[0]:
                    x = p.sub(r, x)
                x = _resolve_links(x)
                for p, r in rules[1]:
                    x = p.sub(r, x)
                x = html.unescape(x).replace("\u00a0", " ")
            out.append(x)
        return pa.array(out, type=pa.string())
    return middle


def strip_middle(col, links: str = "code") -> Column:
    """W7 to W15 in one crossing to Python; rows without braces, double brackets and
    ``&`` take the native rules and never reach it."""
    c = _c(col)
    python = c.contains("{") | c.contains("}") | c.contains("[[") | c.contains("&")
    native = F.translate(_apply(c, ORPHAN_ROWS + link_rules(links) + HEADERS + EMPHASIS + SWITCHES), "\u00a0", " ")
    return F.coalesce(_middle(links)(F.when(python, c)), native)


# --------------------------------------------------------------------------- P6
def clean_wikitext(col, links: str = "code") -> Column:
    """The whole chain in the reference order.  Null -> ''.  Rows that end
    up empty are kept (empty string).  Prefer ``clean_wikitext_df`` for large
    plans (it stages each step as a column)."""
    t = F.coalesce(_c(col), F.lit(""))
    for step in STEPS:
        t = step(t, links) if step is strip_middle else step(t)
    return t


#: The chain: W1-W6, W7-W15 in one crossing, W16-W18.
STEPS = (strip_comments, strip_ref_selfclosed, strip_ref_pairs, strip_open_tags,
         strip_close_tags, strip_other_tags, strip_middle, strip_lists, cut_terminal, collapse_space)
#: The chain with every step by itself.
SINGLE_STEPS = STEPS[:6] + (strip_tables_templates, strip_orphan_rows, resolve_links, resolve_external,
                            strip_headers, strip_emphasis, strip_switches, decode_entities) + STEPS[7:]


def clean_wikitext_df(df, col: str, out: str = "clean", links: str = "code", steps: tuple = STEPS):
    """P6 as a DataFrame transform: the same chain, each step written to a
    column so that steps which read their input several times (the UDF guards,
    line splitting) do not copy the whole preceding chain into the plan."""
    tmp = "_wk"
    d = df.withColumn(tmp, F.coalesce(F.col(col), F.lit("")))
    for step in steps:
        c = step(F.col(tmp), links) if step in (strip_middle, resolve_external) else step(F.col(tmp))
        d = d.withColumn(tmp, c)
    return d.withColumnRenamed(tmp, out)
