"""Main text of web pages by the maximum-scoring subsequence of their tokens.

A page is a sequence of words and tags. Words score positive, tags negative; one linear scan finds the contiguous run with
the largest sum, which is the content region. Weights come from labelled pages: pages whose markup names its main part
with one ``<article>`` element say which tags stand inside the content and which outside. The label itself is not a
feature. Elements that stand outside in (almost) all labelled pages, and those whose name says so, are boilerplate: their
words score like tags and are left out where they lie inside the region. A tag outside boilerplate has a score learned from
such uses alone, so a list or a link of an article does not pay for those in menus.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areapanel.llm import tidy

#: Labelled pages to learn from, at most about. Elements of a class met on fewer than ``SUPPORT`` of them aren't taken for
#: boilerplate by their place; a tag's learned score counts for half at ``SUPPORT`` uses, for more with more uses.
LABELLED_PAGES, SUPPORT = 2000, 20
#: Score of a word, of a word in boilerplate, and the range of a tag's score.
WORD, BOILER, MILDEST, HARSHEST = 1.0, -0.1, -0.02, -4.0
#: An element is boilerplate if at most this share of its uses lies inside the content, and none that holds more than this
#: share of the page's words.
INSIDE, MOST = 0.02, 0.75

# Element names and class words whose meaning in HTML and on the web is fixed.
RAW = ("script", "style", "noscript", "template", "svg", "iframe", "textarea")
BOILERPLATE = frozenset("head title nav header footer aside form button select menu dialog".split()) | frozenset(RAW)
SECTIONS = frozenset("div section aside nav header footer form table ul ol menu details figure".split())
BLOCKS = SECTIONS | frozenset(
    "html body main article p br hr h1 h2 h3 h4 h5 h6 li dl dt dd tr td th thead tbody tfoot caption blockquote pre "
    "address fieldset legend figcaption head title summary center option select button".split()) | frozenset(RAW)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HINTS = frozenset("ad ads advert advertisement adverts sponsored promo sidebar comment comments cookie cookies consent notice "
                  "banner menu nav navbar navigation breadcrumb breadcrumbs footer share social related newsletter "
                  "subscribe popup modal masthead widget".split())
# Words that turn a class name into a statement about what a page has or lacks, not what the element is.
MODIFIERS = frozenset("has with no without not is free enabled disabled hide hidden show open closed above below".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][a-zA-Z0-9-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)"
                    r"|[^<]+|<", re.S)
_MARK = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*>?", re.I) for name in RAW}
_PART = re.compile(r"[a-z]+")


def _elements(html: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, rest) of each token: ``open`` and ``close`` with the element's name and attributes, ``text`` with the
    text. Comments, declarations and the inside of raw elements are left out; broken markup never raises."""
    at = 0
    while m := _TOKEN.match(html, at):
        at = m.end()
        name = m[2]
        if name:
            name = name.lower()
            if m[1]:
                yield "close", name, ""
            else:
                yield "open", name, m[3] or ""
                if name in _RAW_END:
                    end = _RAW_END[name].search(html, at)
                    at = end.end() if end else len(html)
                    yield "close", name, ""
        elif m[0][0] != "<" or m[0] == "<":
            yield "text", "", m[0]


def _signature(name: str, attributes: str) -> tuple[str, list[str]]:
    """The element's name with its class, id and role, and the single words in them."""
    marks = " ".join(x for m in _MARK.findall(attributes) for x in m if x).lower() if attributes else ""
    words = [w for mark in marks.split() for w in (_PART.findall(mark),) if MODIFIERS.isdisjoint(w)]
    return (f"{name} {marks}" if marks else name), [x for w in words for x in w]


@dataclass
class Weights:
    tags: dict[str, float] = field(default_factory=dict)  # by element name, outside boilerplate
    boilerplate: frozenset[str] = frozenset()  # signatures
    boiler_tags: dict[str, float] = field(default_factory=dict)  # by element name, in boilerplate

    def is_boilerplate(self, name: str, attributes: str) -> bool:
        if name in BOILERPLATE:
            return True
        signature, words = _signature(name, attributes)
        return signature in self.boilerplate or name in SECTIONS and not HINTS.isdisjoint(words)


def _enter(inside: list[str], name: str, attributes: str, weights: Weights, wrapper: bool = False) -> None:
    """Adds an opened element to ``inside`` if it is boilerplate, or named as the boilerplate element it stands in. Only its
    name can make a ``wrapper`` boilerplate."""
    if inside:
        if name == inside[0]:
            inside.append(name)
    elif name not in VOID and (name in BOILERPLATE or not wrapper and weights.is_boilerplate(name, attributes)):
        inside.append(name)


def _wrappers(tokens: list[tuple[str, str, str]]) -> set[int]:
    """Places of opened elements that hold the page's first article or main element (of no telling class), or most of its
    words outside elements that are boilerplate by name. Elements end with their closing tag, or with the page."""
    words, mains = [0], [0]
    named: list[str] = []
    opened: dict[str, list[int]] = {}
    ends: dict[int, int] = {}
    for i, (kind, name, rest) in enumerate(tokens):
        words.append(words[-1] + (len(rest.split()) if kind == "text" and not named else 0))
        first = kind == "open" and name in ("article", "main") and not mains[-1] and HINTS.isdisjoint(_signature(name, rest)[1])
        mains.append(mains[-1] + first)
        if kind == "open" and name in SECTIONS:
            opened.setdefault(name, []).append(i)
        elif kind == "close" and opened.get(name):
            ends[opened[name].pop()] = i
        if kind == "open" and (name == named[0] if named else name in BOILERPLATE):
            named.append(name)
        elif kind == "close" and named and name == named[0]:
            named.pop()
    ends |= {i: len(tokens) - 1 for left in opened.values() for i in left}
    return {i for i, end in ends.items() if mains[end + 1] > mains[i + 1] or words[end + 1] - words[i] > MOST * words[-1]}


def main_text(html: str | None, weights: Weights) -> str:
    """Text of the best region: character references decoded, white space inside a block one space, blocks in order
    joined by one space. Empty for a null page or one without words outside boilerplate."""
    inside: list[str] = []  # open boilerplate element, and elements of that name inside it
    best = (0.0, 0, 0)
    total, begin = 0.0, 0
    pieces: list[str | None] = []  # text outside boilerplate; None ends a block
    tokens = list(_elements(html or ""))
    wrappers = _wrappers(tokens)
    for i, (kind, name, rest) in enumerate(tokens):
        if kind == "text":
            words = len(rest.split())
            if inside:
                total += BOILER * words
            else:
                total += WORD * words
                pieces.append(unescape(rest))  # a reference never runs on across a tag
        else:
            if kind == "open":
                _enter(inside, name, rest, weights, i in wrappers)
            total += (weights.boiler_tags if inside else weights.tags).get(name, MILDEST)
            if name in BLOCKS:
                pieces.append(None)
            if kind == "close" and inside and name == inside[0]:
                inside.pop()
        if total <= 0:
            total, begin = 0.0, len(pieces)
        elif total > best[0]:
            best = (total, begin, len(pieces))
    blocks: list[list[str]] = [[]]
    for piece in pieces[best[1] : best[2]]:
        if piece is None:
            blocks.append([])
        else:
            blocks[-1].append(piece)
    return " ".join(t for t in (" ".join("".join(b).split()) for b in blocks) if t)


def _places(html: str | None, known: Weights | None = None) -> list[tuple[str, str, bool]]:
    """(name, signature, inside) of each element of a labelled page, outside the boilerplate of ``known`` if given; nothing
    unless it has exactly one article."""
    tokens = list(_elements(html or ""))
    if sum(kind == "open" and name == "article" for kind, name, _ in tokens) != 1:
        return []
    found, deep = [], False
    boilerplate: list[str] = []
    wrappers = _wrappers(tokens) if known is not None else set()
    for i, (kind, name, rest) in enumerate(tokens):
        if name == "article":
            deep = kind == "open"
        elif kind == "open":
            if known is not None:
                _enter(boilerplate, name, rest, known, i in wrappers)
            if not boilerplate:
                found.append((name, _signature(name, rest)[0], deep))
        elif kind == "close" and boilerplate and name == boilerplate[0]:
            boilerplate.pop()
    return found


def _uses(pages: DataFrame, known: Weights | None = None) -> list[dict]:
    """Per name and signature: uses inside the content, all uses, labelled pages. The drawn pages bound their number."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for page in batch.column(0).to_pylist():
                found = _places(page, known)
                counts.update((n, s, d, 0) for n, s, d in found)
                counts.update((n, s, True, 1) for n, s in {(n, s) for n, s, _ in found})
            keys = list(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
                 pa.array([counts[k] if not k[3] and k[2] else 0 for k in keys], pa.int64()),
                 pa.array([counts[k] if not k[3] else 0 for k in keys], pa.int64()),
                 pa.array([counts[k] if k[3] else 0 for k in keys], pa.int64())], ["name", "signature", "inside", "uses", "pages"])

    return pages.mapInArrow(tidy(places), "name string, signature string, inside long, uses long, pages long").groupBy(
        "name", "signature").agg(*(F.sum(c).alias(c) for c in ("inside", "uses", "pages"))).toArrow().to_pylist()


def _scores(rows: list[dict]) -> dict[str, float]:
    names: dict[str, list[int]] = {}
    for r in rows:
        held = names.setdefault(r["name"], [0, 0])
        held[0] += r["inside"]
        held[1] += r["uses"]
    return {name: MILDEST + (HARSHEST - MILDEST) * (uses - inside) / (uses + SUPPORT) for name, (inside, uses) in names.items()}


def learn_weights(pages: DataFrame, html: str = "html") -> Weights:
    """Weights from at most about ``LABELLED_PAGES`` pages, drawn by a hash of their markup: boilerplate first, then the
    tags outside it.

    A page is labelled if it has exactly one article element; null and empty pages are not, and copies of a page are drawn
    or left together. With few labelled pages scores stay near the mildest, with none (an empty table too) every tag has it.
    """
    share = min(1.0, LABELLED_PAGES / max(1, pages.count()))
    drawn = pages.where(F.pmod(F.xxhash64(html), F.lit(1 << 30)) < int(share * (1 << 30))).select(F.col(html).alias("html"))
    rows = _uses(drawn)
    outside = frozenset(r["signature"] for r in rows if r["name"] in SECTIONS and r["pages"] >= SUPPORT and r["inside"] <= INSIDE * r["uses"]
                        and (r["signature"] != r["name"] or r["name"] not in ("div", "section", "table", "ul", "ol")))
    return Weights(_scores(_uses(drawn, Weights(boilerplate=outside))), outside, _scores(rows))


def extract_text(pages: DataFrame, weights: Weights, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")
                 ) -> DataFrame:
    """One row per row of ``pages``: the ``keep`` columns as they are, text, n_chars (its code points).

    A null or empty page, or one without words, has an empty text. Rows that repeat give the same text. An empty table
    gives an empty result. Columns not named in ``keep`` are not read, so a text or n_chars among them does no harm.
    """
    shared = pages.sparkSession.sparkContext.broadcast(weights)
    rows = pages.select(F.col(html).alias("_html"), *keep)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x, shared.value) for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                [*keep, "text", "n_chars"])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:]]
    return rows.mapInArrow(tidy(extract), ", ".join([*kinds, "text string", "n_chars long"]))
