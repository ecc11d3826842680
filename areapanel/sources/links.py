"""Link extraction from a table of pages.

Downloading is out of scope (single-machine fetch); these jobs run over a
``pages(page_id, url, html)`` table, one page per row, so they scale with the
number of pages. Per-page results use partial aggregates (``min_by``) or a
window partitioned by page.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import html as H


def page_links(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: Sequence[str] = ()
               ) -> DataFrame:
    """All anchors: ``(id, *keep, link_pos, href, title, text, css_class)``; ``link_pos`` is 0-based."""
    exploded = pages.select(id_col, *keep, F.posexplode(H.anchors(html_col)).alias("link_pos", "_a"))
    a = F.col("_a")
    names = ["href", "title", "text", "css_class"]
    raw = F.array(H.raw_attribute(a, "href"), H.raw_attribute(a, "title"), H.raw_text(a), H.raw_attribute(a, "class"))
    return exploded.select(id_col, *keep, F.col("link_pos").cast("bigint").alias("link_pos"), H.decoded(raw).alias("_v")).select(
        id_col, *keep, "link_pos", *[F.col("_v")[i].alias(n) for i, n in enumerate(names)])


def links_by_title(pages: DataFrame, needle: str, base_url: str, attr: str = "title",
                   id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """A5: anchors whose ``attr`` (``title`` by default) contains ``needle``
    (case-sensitive) → ``(id, link_pos, title, url)`` with ``url = base_url + href``."""
    exploded = pages.select(id_col, F.posexplode(H.anchors(html_col)).alias("link_pos", "_a"))
    a = F.col("_a")
    part = {"text": H.raw_text(a), "css_class": H.raw_attribute(a, "class")}.get(attr)
    raw = exploded.select(id_col, F.col("link_pos").cast("bigint").alias("link_pos"), (
        H.raw_attribute(a, attr) if part is None else part).alias("_label"), H.raw_attribute(a, "href").alias("_href"))
    # A label without a reference is tested as it stands; what passes is decoded, and the rest of the labels tested then.
    kept = raw.where(F.col("_label").contains(needle) | F.col("_label").contains("&")).where("_href is not null")
    # As a generated column: a filter on it is not pushed below, where it would decode once more.
    found = kept.select(id_col, "link_pos", F.explode(F.array(H.decoded(F.array("_label", "_href")))).alias("_v"))
    return found.select(id_col, "link_pos", F.col("_v")[0].alias("title"), F.concat(F.lit(base_url), F.col("_v")[1]).alias("url")).where(
        F.col("title").contains(needle) & (F.col("title") != ""))


def nth_link_by_regex(pages: DataFrame, regex: str, n: int = 0, base_col: str | None = "url",
                      base_url: str | None = None, id_col: str = "page_id", html_col: str = "html",
                      on_missing: str = "error") -> DataFrame:
    """Per page, the ``n``-th (0-based) anchor whose ``href`` matches ``regex``
    anywhere, resolved against the page URL (or ``base_url``).

    A page with too few matches fails the job; ``on_missing='drop'`` leaves such pages out.
    """
    keep = [base_col] if base_col and not base_url else []
    links = page_links(pages, id_col, html_col, keep=keep).where(F.col("href").rlike(regex))
    w = Window.partitionBy(id_col).orderBy("link_pos")
    ranked = links.withColumn("_k", F.row_number().over(w) - 1)
    base = F.lit(base_url) if base_url else F.col(base_col)
    picked = ranked.where(F.col("_k") == n).select(id_col, "link_pos", "href",
                                                   H.resolve_url(base, F.col("href")).alias("url"))
    if on_missing == "error":
        counts = links.groupBy(id_col).agg(F.count(F.lit(1)).alias("_m"))
        short = pages.select(id_col).join(counts, id_col, "left").where(F.coalesce("_m", F.lit(0)) <= n)
        bad = short.select(id_col, F.coalesce("_m", F.lit(0)).alias("_m")).take(5)
        if bad:
            raise ValueError(f"link number {n} does not exist on these pages (page, links): {[(r[0], r[1]) for r in bad]}")
    return picked


def first_link_by_type(pages: DataFrame, css_class: str | None = None, types: Sequence[str] = ("excel", "xlsx"),
                       id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Per page, the first anchor (with ``css_class`` when given) whose lower-cased
    ``href`` contains any of ``types`` → ``(id, href)``; pages without one are absent."""
    links = page_links(pages, id_col, html_col)
    cond = F.col("href").isNotNull() & reduce(lambda a, b: a | b,
                                              [F.lower("href").contains(t) for t in types])
    if css_class is not None:
        cond = cond & F.array_contains(F.split(F.trim(F.coalesce("css_class", F.lit(""))), r"\s+"), css_class)
    return (links.where(cond).groupBy(id_col)
            .agg(F.min_by("href", "link_pos").alias("href"), F.min("link_pos").alias("link_pos")))
