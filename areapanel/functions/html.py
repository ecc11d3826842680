"""Anchor extraction from HTML text held in a column (used by A5-A7).

Pages are parsed with JVM regular expressions: anchors are cut out with
``regexp_extract_all``, attributes with ``regexp_extract``. This covers the
anchors link pages use; it is not a general HTML parser.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Attributes up to the end of a tag: a quoted value may hold ">".
_ATTRIBUTES = r"""[^>"']*+(?:(?:"[^"]*+"|'[^']*+')[^>"']*+)*+"""
ANCHOR_RE = rf"(?is)<a(?=[\s/>]){_ATTRIBUTES}>.*?</a\s*>"
_TAG_RE = rf"(?is)^<a({_ATTRIBUTES})>"
_INNER_RE = rf"(?is)^<a{_ATTRIBUTES}>(.*)</a\s*>$"
# What holds no elements: comments, scripts, styles and the like, closed or to the end of the page.
_HIDDEN_RE = r"(?is)<!--.*?(?:-->|\z)|<(script|style|template|textarea|noscript)\b[^>]*+>.*?(?:</\1\s*+>|\z)"


def anchors(html: Column | str) -> Column:
    """All ``<a …>…</a>`` elements of a page, in document order; none from comments, scripts or styles."""
    html = F.col(html) if isinstance(html, str) else html
    shown = F.when(html.rlike(r"(?i)<!--|<(?:script|style|template|textarea|noscript)\b"), F.regexp_replace(html, _HIDDEN_RE, "")).otherwise(html)
    return F.regexp_extract_all(shown, F.lit(ANCHOR_RE), 0)


# Named character references of the HTML standard that end in a semicolon; what 128 to 159 stand for there.
# One text, "\x01name\x02character" for each: short in a plan, and searched only where a name is met.
_NAMED = "".join(f"\x01{name[:-1]}\x02{char}" for name, char in html5.items() if name[-1] == ";") + "\x01"
_C1 = "".join(map(chr, range(128, 160)))
_WINDOWS = "".join(bytes([i]).decode("cp1252", "ignore") or chr(i) for i in range(128, 160))


def _character(code: Column) -> Column:
    """The character of a code point, by its UTF-8 bytes; U+FFFD for 0, surrogates and what is past the last one."""
    def low(shift: int) -> Column:
        return 128 + F.shiftright(code, shift).bitwiseAND(F.lit(63))

    value = (F.when(code < 0x80, code).when(code < 0x800, (0xC0 + F.shiftright(code, 6)) * 256 + low(0))
             .when(code < 0x10000, ((0xE0 + F.shiftright(code, 12)) * 256 + low(6)) * 256 + low(0))
             .otherwise((((0xF0 + F.shiftright(code, 18)) * 256 + low(12)) * 256 + low(6)) * 256 + low(0)))
    valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    text = F.decode(F.unhex(F.hex(F.when(valid, value).otherwise(0xEFBFBD))), "UTF-8")
    return F.translate(text, _C1, _WINDOWS)


def _unescape(c: Column) -> Column:
    """Named and numeric character references that end in a semicolon, each decoded once; unknown names stay."""
    def character(name: Column, named: Column) -> Column:
        place = F.instr(named, F.concat(F.lit("\x01"), name, F.lit("\x02")))
        return F.when(place > 0, F.substring_index(F.substring(named, place + F.length(name) + 2, F.lit(8)), "\x01", 1))

    def decoded(part: Column, named: Column) -> Column:
        name = F.regexp_extract(part, r"^&([A-Za-z][A-Za-z0-9]*);", 1)
        ten, six = F.regexp_extract(part, r"^&#([0-9]+);", 1), F.regexp_extract(part, r"^&#[xX]([0-9A-Fa-f]+);", 1)
        code = F.when(ten != "", F.regexp_extract(ten, "^0*(.*)$", 1)).otherwise(
            F.conv(F.right(six, F.lit(8)), 16, 10))
        past = (F.length(code) > 7) | (F.length(F.regexp_replace(six, "^0+", "")) > 6)
        number = F.when(past, -1).otherwise(F.coalesce(code.try_cast("long"), F.lit(0)))
        char = F.when(name != "", character(name, named)).when((ten != "") | (six != ""), _character(number))
        return F.when(char.isNull(), part).otherwise(
            F.concat(char, F.substring(part, F.instr(part, ";") + 1, F.length(part))))

    return F.when(F.contains(c, F.lit("&")), F.element_at(F.transform(F.array(F.lit(_NAMED)), lambda named: F.array_join(
        F.transform(F.split(c, "(?=&)", -1), lambda part: decoded(part, named)), "")), 1)).otherwise(c)


def attribute(anchor: Column, name: str) -> Column:
    """Value of an attribute of the anchor tag, quoted or not, references decoded; NULL when absent."""
    return _unescape(raw_attribute(anchor, name))


def raw_attribute(anchor: Column, name: str) -> Column:
    """As ``attribute``, with references as they stand in the page."""
    tag = F.regexp_extract(anchor, _TAG_RE, 1)
    start = r"(?is)(?:^|\s)" + name + r"\s*=\s*"
    value = (F.when(tag.rlike(start + '"'), F.regexp_extract(tag, start + '"([^"]*)"', 1))
             .when(tag.rlike(start + "'"), F.regexp_extract(tag, start + "'([^']*)'", 1))
             .otherwise(F.regexp_extract(tag, start + r"""([^\s"'>]*)""", 1)))
    return F.when(tag.rlike(start), value)


def raw_text(anchor: Column) -> Column:
    """Text content of the anchor with inner tags removed and references as they stand."""
    inner = F.regexp_extract(anchor, _INNER_RE, 1)
    return F.regexp_replace(inner, rf"<{_ATTRIBUTES}>", "")


def link_text(anchor: Column) -> Column:
    """Text content of the anchor with inner tags removed and references decoded."""
    return _unescape(raw_text(anchor))


def decoded(values: Column) -> Column:
    """An array of raw attributes or texts with references decoded; where none has one, as it is."""
    return F.when(F.exists(values, lambda v: F.coalesce(F.contains(v, F.lit("&")), F.lit(False))), F.transform(
        values, _unescape)).otherwise(values)


def _collapse(path: Column) -> Column:
    """``.`` and ``..`` segments of an absolute path worked off from the left."""
    parts = F.slice(F.split(path, "/", -1), 2, F.length(path))

    def step(kept: Column, part: Column) -> Column:
        return F.when(part == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0)))).when(
            part == ".", kept).otherwise(F.concat(kept, F.array(part)))

    kept = F.aggregate(parts, F.array().cast("array<string>"), step)
    closed = F.when(path.rlike(r"/\.\.?$") & (F.size(kept) > 0), "/").otherwise("")
    return F.concat(F.lit("/"), F.array_join(kept, "/"), closed)


def resolve_url(base: Column | str, href: Column) -> Column:
    """Resolve ``href`` against ``base``: absolute URL, scheme-relative ``//host``, host-relative
    ``/path``, relative ``path`` with ``.`` and ``..``, ``?query``, ``#fragment`` and empty."""
    base = F.lit(base) if isinstance(base, str) else base
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    path = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    query = F.regexp_extract(base, r"^[^?#]*(\?[^#]*)", 1)
    own = F.regexp_extract(href, r"^([^?#]*)", 1)
    tail = F.substring(href, F.length(own) + 1, F.length(href))
    directory = F.regexp_extract(path, r"^(.*/)", 1)
    full = F.when(own.startswith("/"), own).otherwise(F.concat(F.when(directory == "", "/").otherwise(directory), own))
    dotted = full.rlike(r"(^|/)\.\.?(/|$)")
    return (F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
            .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
            .when(href == "", base)
            .when(href.startswith("#"), F.concat(origin, path, query, href))
            .when(href.startswith("?"), F.concat(origin, path, href))
            .otherwise(F.concat(origin, F.when(dotted, _collapse(full)).otherwise(full), tail)))
