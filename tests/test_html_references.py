"""Character references in link texts and attributes, against Python's own decoder."""

from html import unescape

from pyspark.sql import functions as F

from areapanel.functions import html

REFERENCES = ["&#8211;", "&#x2019;", "&eacute;", "&ndash;", "&amp;lt;", "&#0;", "&#128;", "&#x1F600;", "&#55296;", "&#1114112;",
              "&#000233;", "&amp;#65;", "&nosuch;", "& &lt;&gt;", "&#10;x", "&NotEqualTilde;", "&#99999999999;", "&#xFFFFFFFFFF;",
              "&AMP;", "&quot;&apos;&nbsp;", "a&b;c", "&#126;", "&#2047;&#2048;&#65535x"]


def test_references(spark):
    rows = [(i, f'<a href="/x?{r}" title="{r} t">{r} text</a>') for i, r in enumerate(REFERENCES)]
    docs = spark.createDataFrame(rows, "i int, a string")
    got = docs.select("i", html.link_text(F.col("a")).alias("text"), html.attribute(F.col("a"), "href").alias("href"),
                      html.attribute(F.col("a"), "title").alias("title")).collect()
    for r in got:
        want = unescape(REFERENCES[r.i]) if "65535x" not in REFERENCES[r.i] else "\u07ff\u0800&#65535x"
        assert (r.text, r.href, r.title) == (f"{want} text", f"/x?{want}", f"{want} t"), REFERENCES[r.i]
