"""Sources (A1-A7, A10, B9), sinks (K1-K4) and served views (V1-V7) on small inputs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from areapanel.functions import html as H
from areapanel.plans import views as V
from areapanel.session import scratch_path
from areapanel.sinks import tables as K
from areapanel.sources import files as A
from areapanel.sources import links as L
from areapanel.sources.sql import param_sql


def _write_text(spark, files: dict[str, str]) -> str:
    """Write each text as its own file below a fresh scratch folder (Spark text writer)."""
    base = scratch_path(spark, "fixture")
    for name, text in files.items():
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite") \
            .option("lineSep", "\n").text(f"{base}/{name}")
    return base


def test_trimmed_csv_preamble_footer_blank_and_quotes(spark):
    text = "\n".join(["Title line", "Second, with comma", "", 'ward,count', '"Leith, Walk",5', "", "Fife,7",
                      "Total,12", "Source: somewhere"]) + "\n\n"
    base = _write_text(spark, {"a": text})
    df = A.read_trimmed_csv(spark, f"{base}/a", skiprows=3, skipfooter=2, schema={"count": "bigint"})
    assert sorted(tuple(r) for r in df.collect()) == [("Fife", 7), ("Leith, Walk", 5)]


def test_trimmed_csv_files_with_different_headers_stack(spark):
    base = _write_text(spark, {"y1/a": "pre\nx,y\n1,2\nfoot\n", "y2/b": "pre\nx,z\n3,4\nfoot\n"})
    df = A.read_trimmed_csv(spark, [f"{base}/y1/a", f"{base}/y2/b"], skiprows=1, skipfooter=1)
    got = sorted((r.x, r.y, r.z) for r in df.collect())
    assert got == [("1", "2", None), ("3", None, "4")]


def test_promote_header_and_no_match(spark):
    base = _write_text(spark, {"s": "Estimates\n\nName,Code,Total\nLeith,S1,10\nFife,S2,20\n"})
    raw = A.read_raw_rows(spark, f"{base}/s")
    out = A.promote_header(raw, "Code")
    assert out.columns == ["Name", "Code", "Total"] and out.count() == 2
    same = A.promote_header(raw, "nothing-matches")
    assert same.count() == raw.count()


def test_pick_sheet_error_lists_sheets(spark):
    df = spark.createDataFrame([("2001", 1), ("Notes", 2)], "sheet string, v int")
    assert A.pick_sheet(df, "2001").collect()[0].v == 1
    with pytest.raises(KeyError, match="Notes"):
        A.pick_sheet(df, "2021")


def test_read_many_keys_by_path(spark):
    base = scratch_path(spark, "many")
    spark.createDataFrame([(1, "a"), (2, "b")], "v int, year string").write.partitionBy("year").parquet(base)
    df = A.read_many(spark, base, "parquet", key_pattern=r"year=(\w+)")
    assert sorted((r.source_key, r.v) for r in df.collect()) == [("a", 1), ("b", 2)]


HTML = ('<html><a href="/data/crime-2023.xlsx" title="Detected crime 2023" class="btn excel">x</a>'
        '<a class="excel" href="https://other.org/file.XLSX">y</a>'
        "<A HREF='rel/page.html'>Detected <b>rel</b></A><a>no href</a></html>")


def test_links(spark):
    pages = spark.createDataFrame([(1, "https://site.org/pub/index.html", HTML)], "page_id long, url string, html string")
    by_title = L.links_by_title(pages, "Detected", "https://site.org").collect()
    assert [(r.title, r.url) for r in by_title] == [("Detected crime 2023", "https://site.org/data/crime-2023.xlsx")]
    first = L.nth_link_by_regex(pages, r"\.xlsx$", 0).first()
    assert first.url == "https://site.org/data/crime-2023.xlsx"
    rel = L.nth_link_by_regex(pages, r"\.html$", 0).first()
    assert rel.url == "https://site.org/pub/rel/page.html"
    with pytest.raises(ValueError):
        L.nth_link_by_regex(pages, r"\.xlsx$", 3, on_missing="error")
    typed = L.first_link_by_type(pages, "excel").first()
    assert typed.href == "/data/crime-2023.xlsx"
    assert L.first_link_by_type(pages, "nothere").count() == 0


def test_resolve_url_forms(spark):
    df = spark.createDataFrame([("https://a.org/x/y.html", h) for h in
                                ["https://b.org/z", "//c.org/q", "/root.csv", "rel.csv"]], "base string, href string")
    got = [r[0] for r in df.select(H.resolve_url(F.col("base"), F.col("href"))).collect()]
    assert got == ["https://b.org/z", "https://c.org/q", "https://a.org/root.csv", "https://a.org/x/rel.csv"]


def _crime(spark):
    return spark.createDataFrame([(5, "S1", dt.date(2023, 1, 1)), (3, None, dt.date(2023, 1, 1)),
                                  (7, "S2", dt.date(2023, 2, 1)), (2, "S1", None)],
                                 "count long, ward_code string, date date")


def test_history_views(spark):
    crime = _crime(spark)
    assert V.history_crime(crime).count() == 2                      # NULL code or date never returned
    assert V.history_crime(crime, "S1").count() == 1
    assert V.history_crime(crime, None, "2023-02-01").first().ward_code == "S2"
    assert V.history_optional(crime).count() == 4                   # every row without a filter
    assert V.history_optional(crime, "S1").count() == 2
    series = V.area_series(crime, "S1").collect()
    assert [r["count"] for r in series] == [5]
    shaped = V.typed_projection(crime.withColumn("extra", F.lit(1)), V.CRIME_SHAPE)
    assert shaped.columns == ["count", "ward_code", "date"]


def test_param_sql_null_folds(spark):
    crime = _crime(spark)
    sql = "SELECT * FROM {t} WHERE ward_code = COALESCE(:c, ward_code)"
    assert param_sql(spark, sql, {"c": None}, {"t": crime}).count() == 3
    assert param_sql(spark, sql, {"c": "S2"}, {"t": crime}).count() == 1


def test_map_slice_and_prediction_for(spark):
    panel = spark.createDataFrame([("S1", dt.date(2023, 1, 1), 0), ("S2", dt.date(2023, 1, 1), 4)],
                                  "area_code string, date date, count long")
    names = spark.createDataFrame([("S1", "a"), ("S2", "b")], "area_code string, area_name string")
    rows = {r.area_code: r.log_count for r in V.map_slice(panel, names, "2023-01-01").collect()}
    assert rows["S1"] is None and abs(rows["S2"] - 1.3862943611198906) < 1e-12
    preds = spark.createDataFrame([("S1", dt.date(2023, 2, 1), 3.5)], "area_code string, date date, "
                                                                        "crime_prediction double")
    assert V.prediction_for(preds, "S1").first().crime_prediction == 3.5


def test_replace_and_gated_tables(spark):
    df = _crime(spark).where(F.col("date").isNotNull())
    path = K.replace_table(df, scratch_path(spark, "t"))
    back = K.read_table(spark, path)
    assert sorted(back.columns) == sorted(df.columns) and back.count() == 3
    assert back.where(F.col("date") >= "2023-02-01").count() == 1
    with pytest.raises(ValueError):
        K.gated_replace(df, scratch_path(spark, "g"), ["count", "missing"])
