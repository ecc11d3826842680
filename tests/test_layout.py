"""Files read by block, tables clustered by area, and what lookups read of them."""

import random

import pytest

from areapanel.functions import html as H
from areapanel.plans import views as V
from areapanel.sinks import tables as K
from areapanel.sources import files as A
from areapanel.sources import links as L
from pyspark.sql import functions as F


@pytest.fixture
def small_blocks(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "32"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_lines_are_numbered_across_blocks(spark, tmp_path, small_blocks):
    random.seed(6)
    want = set()
    for name, end, tail in (("a", "\n", ""), ("b", "\r\n", "\n\n"), ("c", "\n", "\n\n\n"), ("d", "\n", "  \n")):
        lines = ["x" * random.randint(0, 150) + f"é{i}" * (random.random() < .8) for i in range(120)] + ["last"]
        (tmp_path / name).write_bytes((end.join(lines) + tail).encode())
        lines += ["  "] if name == "d" and tail else []
        if name == "d":
            lines = lines[:-2] + ["last  "]
        want |= {(name, i, len(lines), x) for i, x in enumerate(lines)}
    (tmp_path / "empty").write_bytes(b"")
    (tmp_path / "blank").write_bytes(b"\n\n\n")
    got = A.numbered_lines(spark, str(tmp_path)).where("_row < _n")
    assert got.rdd.getNumPartitions() > 20
    assert {(r._file.rsplit("/", 1)[1], r._row, r._n, r._line) for r in got.collect()} == want


def test_trimmed_csv_over_blocks_and_headers(spark, tmp_path, small_blocks):
    for name, header in (("p", "k,v,only_p"), ("q", "v,k"), ("r", "k,v,only_p")):
        rows = [f"{i},{name}{i},z" if name != "q" else f"{name}{i},{i}" for i in range(90)]
        (tmp_path / name).write_text("\n".join(["pre", "amble", "", header, *rows[:40], "", *rows[40:], "", "foot", "er"]) + "\n\n")
    got = A.read_trimmed_csv(spark, str(tmp_path), 2, 3, {"k": "int"}, keep_file=True)
    assert got.columns == ["_file", "k", "v", "only_p"]
    rows = {(r._file.rsplit("/", 1)[1], r.k, r.v, r.only_p) for r in got.collect()}
    assert rows == {(n, i, f"{n}{i}", None if n == "q" else "z") for n in "pqr" for i in range(90)}
    with pytest.raises(ValueError):
        A.read_trimmed_csv(spark, str(tmp_path), 5000, 0)


def scanned(df):
    """(files, rows) that the scan below ``df`` read."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    metrics = leaves.apply(0).metrics()
    return metrics.apply("numFiles").value(), metrics.apply("numOutputRows").value()


def test_lookups_read_one_part_and_few_pages(spark, tmp_path):
    months = F.expr("explode(sequence(date'2018-01-01', date'2021-12-01', interval 1 month))")
    df = spark.range(800).select(F.format_string("S%08d", "id").alias("ward_code"), months.alias("date")).withColumn(
        "count", F.xxhash64("ward_code", "date"))
    df = df.unionByName(spark.createDataFrame([(None, None, 1)], "ward_code string, date date, count long"))
    path = K.cluster_table(df, str(tmp_path / "t"), "ward_code", parts=4)
    table = K.read_table(spark, path, keep_year=True)
    assert K.read_table(spark, path).columns == df.columns and table.count() == df.count()
    files = len(table.inputFiles())
    one = V.history_optional(table, "S00000123")
    assert one.count() == 48 and set(one.columns) == set(df.columns)
    some, rows = scanned(one)
    assert some <= files / 3 and rows < df.count() / 3
    month = V.history_crime(table, "S00000123", "2019-05-01")
    assert month.count() == 1 and scanned(month)[0] <= files / 12
    assert V.history_optional(table).count() == df.count() and V.history_crime(table).count() == 800 * 48
    text = spark._jvm.PythonSQLUtils.explainString(one._jdf.queryExecution(), "formatted")
    assert "area_part_4" in text.split("PartitionFilters")[1].split("\n")[0]


PAGE = """<!-- <a href="/no1">x</a> --><script>var a = '<a href="/no2">y</a>';</script><a-widget href="/no3">w</a-widget>
<A title="a>b &amp; c" HREF='/one?x=1&amp;y=2'>One <b title=">">bold</b></A><a
href=/two class="x y">caf&eacute; &#8211; &unknown; &amp;lt;</a ><abbr>no</abbr><a name="z">no link</a><style><a href="/no4">s</a></style>
<a href="/open">never closed"""


def test_anchor_scan(spark):
    df = spark.createDataFrame([(1, "https://h.example/d/p", PAGE), (2, "u", None), (3, "u", "")], "page_id int, url string, html string")
    got = L.page_links(df).orderBy("link_pos").collect()
    assert [(r.page_id, r.href, r.title, r.text, r.css_class) for r in got] == [
        (1, "/one?x=1&y=2", "a>b & c", "One bold", None), (1, "/two", None, "café – &unknown; &lt;", "x y"), (1, None, None, "no link", None)]
    by_title = L.links_by_title(df, "b & c", "https://x.example").collect()
    assert [(r.link_pos, r.title, r.url) for r in by_title] == [(0, "a>b & c", "https://x.example/one?x=1&y=2")]
    assert L.links_by_title(df, "é –", "", attr="text").first().url == "/two"
    assert L.links_by_title(df, "&amp;", "", attr="title").count() == 0
    assert len(spark._jvm.PythonSQLUtils.explainString(L.links_by_title(df, "x", "")._jdf.queryExecution(), "simple")) < 200_000
    assert H.ANCHOR_RE.count("\\s") >= 1
