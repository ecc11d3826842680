"""Inputs that the registered queries do not hold: mixed files, missing keys, URL and attribute forms."""

import datetime as dt
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from areapanel.functions import html as H
from areapanel.operators import relational as R
from areapanel.operators import spatial as SPA
from areapanel.sources import files, links


def test_urls_resolve_like_urljoin(spark):
    bases = ["http://a.b/c/d/e.html?x=1#f", "http://a.b", "https://a.b/c/"]
    hrefs = ["", "?q=1", "#f", "../z", "./y", "/k/../m", "g/h.xlsx?a=b/../c", "//h.i/j", "http://q/r", "..", "../../../t", "."]
    rows = spark.createDataFrame([(b, h) for b in bases for h in hrefs], "b string, h string")
    for r in rows.select("b", "h", H.resolve_url(F.col("b"), F.col("h")).alias("u")).collect():
        assert r.u == urljoin(r.b, r.h), (r.b, r.h)


def test_unquoted_attributes_and_entities(spark):
    page = "<a href=/x.xlsx title='Detected &quot;A&quot; &lt;1 &#233;'>t &amp;lt; z</a>"
    r = spark.createDataFrame([(page,)], "a string").select(
        H.attribute(F.col("a"), "href").alias("h"), H.attribute(F.col("a"), "title").alias("t"),
        H.link_text(F.col("a")).alias("x")).first()
    assert (r.h, r.t, r.x) == ("/x.xlsx", 'Detected "A" <1 \u00e9', "t &lt; z")


def test_date_split_keeps_rows_without_a_date(spark):
    rows = [(dt.date(2020, 1 + i % 12, 1),) for i in range(24)] + [(None,)] * 3
    train, test = R.date_split(spark.createDataFrame(rows, "date date"))
    assert train.count() + test.count() == 27 and test.where("date IS NULL").count() == 0


def test_promote_header_per_file(spark):
    rows = [("f", 0, "note", None), ("f", 1, "code", "n"), ("f", 2, "a", "1"),
            ("g", 0, "x", None), ("g", 1, "y", None), ("g", 2, "z", None), ("g", 3, "code", "n"), ("g", 4, "b", "2")]
    df = spark.createDataFrame(rows, "_file string, _row int, _c0 string, _c1 string")
    assert sorted(map(tuple, files.promote_header(df, "^code$").collect())) == [("a", "1"), ("b", "2")]
    with pytest.raises(ValueError):
        files.promote_header(df.where("_file = 'f' OR _row != 3"), "^code$")


def test_crosswalk_of_nothing_is_zero(spark):
    values = spark.createDataFrame([("s", None)], "source_code string, v double")
    walk = spark.createDataFrame([("s", "t", 0.5)], "source_code string, target_code string, weight double")
    assert SPA.crosswalk_reweight(values, walk, ["v"]).first().v == 0.0


def test_missing_link_is_an_error_by_default(spark):
    page = spark.createDataFrame([(1, "http://a.b/", "<a href='x.csv'>x</a>")], "page_id int, url string, html string")
    with pytest.raises(ValueError):
        links.nth_link_by_regex(page, "xlsx", 0)
