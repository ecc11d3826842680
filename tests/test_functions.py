import datetime as dt

import pytest
from pyspark.sql import functions as F

from areapanel.functions import dates as D
from areapanel.functions import numeric as N
from areapanel.functions.text import disambiguate, normalise_column_name, normalise_name, value_edits


def utf8_as_latin1(s):
    return s.encode("utf-8").decode("latin-1")


@pytest.mark.parametrize("raw,expected", [
    ("Eilean Ã¡ ChÃ¨o", "eileanacha o"),
    (utf8_as_latin1("Sgìr'Ùige agus Càrlabhagh"), "sgaraigecarlabhagh"),
    (utf8_as_latin1("Steòrnabhagh a Deas"), "stea2rnabhaghadeas"),
    ("Landward Caithness Ward", "landwardcaithness"),
    ("Tom and Jerry & Co.", "tomjerryco"),
    ("x and and y", "xandy"),
    ("(A)/B-C'd’", "abcd"),
    (None, ""),
    ("ﬁsh ½", "fish12"),
])
def test_normalise_name_goldens(spark, raw, expected):
    got = spark.createDataFrame([(raw,)], "s string").select(normalise_name("s")).first()[0]
    assert got == expected


def test_normalise_name_ignores_surrounding_space(spark):
    df = spark.createDataFrame([("  Leith Walk ",), ("Leith Walk",)], "s string")
    a, b = [r[0] for r in df.select(normalise_name("s")).collect()]
    assert a == b == "leithwalk"


def test_normalise_column_name():
    assert normalise_column_name("Electoral Ward 2022 (Name)") == "electoral_ward_2022"
    assert normalise_column_name("Region  Key") == "regionkey"


def test_value_edits_and_disambiguate(spark):
    df = spark.createDataFrame([("a", "x"), ("b", None), (None, "z")], "code string, name string")
    out = df.select(value_edits("name", {"x": "X"}).alias("e"),
                    disambiguate("code", "name", {"b": "bee"}).alias("d")).collect()
    assert [r.e for r in out] == ["X", None, "z"]
    assert [r.d for r in out] == ["x", "bee", "z"]


def test_divide_by_zero_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (-1.0, 0.0), (1.0, 4.0)], "a double, b double")
    assert [r[0] for r in df.select(N.ratio("a", "b")).collect()] == [None, None, None, 0.25]


def test_row_sum_nulls_are_zero(spark):
    df = spark.createDataFrame([(None, None), (1.0, None)], "a double, b double")
    assert [r[0] for r in df.select(N.row_sum(["a", "b"])).collect()] == [0.0, 1.0]


def test_month_functions(spark):
    df = spark.createDataFrame([(dt.date(2011, 1, 15), dt.date(2011, 3, 14)),
                                (dt.date(2011, 1, 31), dt.date(2011, 2, 28)),
                                (dt.date(2011, 1, 30), dt.date(2011, 2, 27))], "a date, b date")
    rows = df.select(D.month_diff("b", "a").alias("m"), D.months_elapsed("b", "a").alias("e")).collect()
    assert [(r.m, r.e) for r in rows] == [(2, 1), (1, 1), (1, 0)]
    one = spark.range(1).select(D.year_month_date(F.lit(2020), F.lit(2)).alias("d"),
                                D.to_month_date(F.lit("1997")).alias("y"),
                                D.to_month_date(F.lit("2001-08-15")).alias("t")).first()
    assert (one.d, one.y, one.t) == (dt.date(2020, 2, 1), dt.date(1997, 1, 1), dt.date(2001, 8, 15))


def test_month_13_raises(spark):
    with pytest.raises(Exception):
        spark.range(1).select(D.year_month_date(F.lit(2020), F.lit(13))).collect()


def test_log_features_null_at_zero(spark):
    df = spark.createDataFrame([(0.0,), (-1.0,), (1.0,)], "x double")
    rows = df.select(N.ln_value("x"), N.log1p_value("x")).collect()
    assert rows[0][0] is None and rows[1][1] is None and rows[2][0] == 0.0
