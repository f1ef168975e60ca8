"""Scalar text functions (Column -> Column).

Everything that Spark can express natively stays JVM-side.  Only Unicode NFC
and HTML entity decoding need Python; both run as Arrow-batched UDFs and are
fed NULL for rows that cannot change (no character that NFC may touch / no ``&``), so those rows do
not pay the Python round trip.
"""

from __future__ import annotations

import html
import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# The code points Python's str.strip()/str.isspace()/re "\s"
# treat as whitespace (29 code points).
# ---------------------------------------------------------------------------
WS_CODEPOINTS = (
    [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680]
    + list(range(0x2000, 0x200B))
    + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)
WS_CHARS = "".join(chr(c) for c in WS_CODEPOINTS)


def _java_cp(c: int) -> str:
    return f"\\x{{{c:X}}}"


# Body of a regex character class matching WS (use as f"[{WS}]"); the same
# spelling works in Java regex and in RE2 (the DuckDB oracle).
WS = "".join(_java_cp(c) for c in WS_CODEPOINTS)


def java_class(codepoints) -> str:
    """Body of a Java character class.  Java asks every range of a class in turn, Latin-1's
    bit table last, so ranges that lie close together stand behind one range around them."""
    points = sorted(set(codepoints))
    runs: list[list[list[int]]] = []
    for c in points:
        if c < 0x100:
            continue
        if runs and c == runs[-1][-1][1] + 1:
            runs[-1][-1][1] = c
        elif runs and c - runs[-1][-1][1] < 0x400:
            runs[-1].append([c, c])
        else:
            runs.append([[c, c]])

    def spell(near):
        return "".join(_java_cp(a) if a == b else f"{_java_cp(a)}-{_java_cp(b)}" for a, b in near)

    return "".join(_java_cp(c) for c in points if c < 0x100) + "".join(
        spell(near) if len(near) == 1 else f"[{_java_cp(near[0][0])}-{_java_cp(near[-1][1])}&&[{spell(near)}]]" for near in runs)


#: The class ``WS`` for Java alone.
JAVA_WS = java_class(WS_CODEPOINTS)


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --------------------------------------------------------------------------- strip
def ustrip(col) -> Column:
    """Python ``str.strip()``: removes the 29 WS code points at both ends."""
    return F.btrim(_c(col), F.lit(WS_CHARS))


def ulstrip(col) -> Column:
    return F.ltrim(_c(col), F.lit(WS_CHARS))


def urstrip(col) -> Column:
    return F.rtrim(_c(col), F.lit(WS_CHARS))


def is_ascii(col) -> Column:
    """O(1) per row: byte length equals code-point length only for ASCII."""
    c = _c(col)
    return F.octet_length(c) == F.length(c)


def collapse(col, codepoints, ascii_only) -> Column:
    """Runs of ``codepoints`` become one space.  Where ``ascii_only`` holds, no character
    beyond ASCII is asked for: Java would try each such range first."""
    few = java_class(c for c in codepoints if c < 0x80)
    return F.regexp_replace(_c(col), F.when(ascii_only, F.lit(f"[{few}]+")).otherwise(F.lit(f"[{java_class(codepoints)}]+")),
                            F.lit(" "))


# --------------------------------------------------------------------------- NFC
#: Ranges of code points that the JVM check lets pass: the longest ones below and above U+FFFF.
NFC_RANGES = (32, 2)


@lru_cache(maxsize=1)
def nfc_safe_ranges() -> list[tuple[int, int]]:
    """The longest ranges of code points that NFC never touches, whatever stands beside
    them: each is its own normal form, is no combining mark and never joins the character
    before it.  Made from Python's Unicode data, which also normalises."""
    joins = set(range(0x1161, 0x1176)) | set(range(0x11A8, 0x11C3))  # vowels and finals of syllables made by rule
    unsafe = set()
    for c in range(0x110000):
        ch = chr(c)
        if 0xD800 <= c < 0xE000 or unicodedata.combining(ch) or unicodedata.normalize("NFC", ch) != ch:
            unsafe.add(c)
        parts = unicodedata.decomposition(ch).split(" ")
        if len(parts) == 2 and parts[0][:1] != "<":
            joins.add(int(parts[1], 16))
    ranges, begin = [], 0
    for c in sorted(unsafe | joins) + [0x110000]:
        if c > begin:
            ranges.append((begin, c - 1))
        begin = c + 1
    ranges.sort(key=lambda r: r[0] - r[1])
    low, high = ([r for r in ranges if (r[0] > 0xFFFF) == above][:n] for above, n in enumerate(NFC_RANGES))
    return sorted(low + high)


def may_need_nfc(col) -> Column:
    """JVM check: the text holds a character that NFC may change or move.  False for
    ASCII, and for precomposed text of nearly all scripts."""
    c = _c(col)
    # Java asks all ranges of a class; Latin, and the block of its precomposed letters, first
    safe = [f"{_java_cp(a)}-{_java_cp(b)}" for a, b in nfc_safe_ranges()]
    first = [r for r, (a, b) in zip(safe, nfc_safe_ranges(), strict=True) if a <= 0x41 <= b or a <= 0x1EA1 <= b]
    rest = "".join(r for r in safe if r not in first)
    return ~is_ascii(c) & c.rlike("[" + "&&".join(f"[^{r}]" for r in [*first, rest]) + "]")


@F.arrow_udf(T.StringType())
def _nfc_arrow(s: pa.Array) -> pa.Array:
    norm = unicodedata.normalize
    isn = unicodedata.is_normalized
    out = [None if x is None else (x if isn("NFC", x) else norm("NFC", x))
           for x in s.to_pylist()]
    return pa.array(out, type=pa.string())


def nfc(col) -> Column:
    """Unicode NFC with null -> ''.  Rows that cannot change never reach Python."""
    c = _c(col)
    return F.coalesce(_nfc_arrow(F.when(may_need_nfc(c), c)), c, F.lit(""))


def doc_hash(col) -> Column:
    """SHA-256 (hex) of the UTF-8 bytes of NFC(text); no case folding, no strip."""
    return F.sha2(nfc(col), 256)


# --------------------------------------------------------------------------- HTML entities
@F.arrow_udf(T.StringType())
def _unescape_arrow(s: pa.Array) -> pa.Array:
    un = html.unescape
    return pa.array([None if x is None else un(x) for x in s.to_pylist()], type=pa.string())


def html_unescape(col) -> Column:
    """Full HTML5 entity decoding (named incl. legacy no-semicolon, decimal, hex).
    Rows without ``&`` are passed through JVM-side."""
    c = _c(col)
    return F.coalesce(_unescape_arrow(F.when(F.instr(c, "&") > 0, c)), c)


# --------------------------------------------------------------------------- sizes & numbers
def format_size(col) -> Column:
    """1024 ladder B/KB/MB/GB/TB with two decimals; TB is uncapped."""
    b = _c(col).cast("double")
    k = F.lit(1024.0)

    def fmt(x, unit):
        # bytes / 1024^k is dyadic, so its decimal form is exact: HALF_EVEN
        # first gives Python's rounding of exact ties (Java's %.2f rounds up).
        return F.format_string(f"%.2f {unit}", F.bround(x, 2))

    return (F.when(b < k, fmt(b, "B"))
            .when(b < k ** 2, fmt(b / k, "KB"))
            .when(b < k ** 3, fmt(b / k ** 2, "MB"))
            .when(b < k ** 4, fmt(b / k ** 3, "GB"))
            .otherwise(fmt(b / k ** 4, "TB")))


def perplexity(loss) -> Column:
    """exp(loss); overflow gives +Infinity, null stays null."""
    return F.exp(_c(loss))


# --------------------------------------------------------------------------- URLs
# Fixed value: article URL prefix of the wiki the crawler targets.
WIKI_BASE = "https://vi.wikipedia.org/wiki/"


def wiki_url(title, base: str = WIKI_BASE) -> Column:
    """Percent-encode UTF-8 of the title with spaces as '_', keeping '/' ':'
    and the unreserved set ``A-Za-z0-9 _ . - ~``."""
    enc = F.url_encode(F.replace(_c(title), F.lit(" "), F.lit("_")))
    # url_encode is form encoding: it keeps '*' and encodes '~', '/', ':'.
    for a, b in (("%2F", "/"), ("%3A", ":"), ("%7E", "~"), ("*", "%2A")):
        enc = F.replace(enc, F.lit(a), F.lit(b))
    return F.concat(F.lit(base), enc)


# --------------------------------------------------------------------------- generated text
def strip_prefix(col, prefix: str) -> Column:
    """If the text starts with ``prefix``: cut it and strip; else unchanged."""
    c = _c(col)
    return F.when(c.startswith(prefix), ustrip(F.substring(c, len(prefix) + 1, 1 << 30))).otherwise(c)


def extract_reply(text, prompt) -> Column:
    """Drop the prompt by *length* (no prefix check) and strip; if nothing is
    left, the stripped full text."""
    t, p = _c(text), _c(prompt)
    rest = F.substring(t, F.length(p) + 1, 1 << 30)
    return F.coalesce(F.nullif(ustrip(rest), F.lit("")), ustrip(t))


def wrap_sample(col, prefix: str, eos: str) -> Column:
    """``prefix + NFC(text) + eos`` for a training sample."""
    return F.concat(F.lit(prefix), nfc(col), F.lit(eos))
