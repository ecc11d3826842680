"""Whole jobs on hand-made inputs shaped like the reference's source files."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from areapanel.plans import jobs as J
from areapanel.plans import specs as SP
from areapanel.sinks.tables import boundary_features

SCHEMA = "area_code string, part int, ring int, seq int, x double, y double"
X0, Y0 = 320000.0, 670000.0


def rect(code, x0, x1):
    pts = [(x0, 0), (x1, 0), (x1, 1000), (x0, 1000)]
    return [(code, 0, 0, i, X0 + x, Y0 + y) for i, (x, y) in enumerate(pts)]


@pytest.fixture(scope="module")
def layers(spark):
    new = spark.createDataFrame(rect("S13000001", 0, 1000) + rect("S13000002", 1000, 2000), SCHEMA)
    new_props = spark.createDataFrame([("S13000001", "Leith Walk", "S13000001"), ("S13000002", "Eilean á Chèo", "S13000002")],
                                      "area_code string, WD25NM string, WD25CD string")
    old = spark.createDataFrame(rect("S13000901", 0, 500) + rect("S13000900", 500, 1500)
                                + rect("S13000902", 1500, 2000), SCHEMA)
    old_props = spark.createDataFrame([("S13000901", "West Ward", "S13000901"), ("S13000900", "Old Town", "S13000900"),
                                       ("S13000902", "East", "S13000902")],
                                      "area_code string, Name string, ONS_2010 string")
    f22 = boundary_features(new, "area_code", new_props)
    f07 = boundary_features(old, "area_code", old_props)
    geo22, look22 = J.boundary_lookup(f22, SP.BOUNDARIES_2022, "2022")
    geo07, look07 = J.boundary_lookup(f07, SP.BOUNDARIES_2007, "2007")
    cw = J.crosswalk(geo07, geo22).cache()
    return {"f22": f22, "look22": look22.cache(), "look07": look07.cache(), "cw": cw}


def test_crosswalk(layers):
    got = {(r.ward_code_2007, r.ward_code_2022): round(r.overlap_pct, 9) for r in layers["cw"].collect()}
    assert got == {("S13000901", "S13000001"): 1.0, ("S13000900", "S13000001"): 0.5,
                   ("S13000900", "S13000002"): 0.5, ("S13000902", "S13000002"): 1.0}


def test_lookups(layers):
    names = {r.ward_code_2022: r.ward_name_2022 for r in layers["look22"].collect()}
    # boundary names are read as Latin-1 from UTF-8 bytes, then keyed
    assert names["S13000001"] == "leithwalk"
    names07 = {r.ward_code_2007: r.ward_name_2007 for r in layers["look07"].collect()}
    assert names07["S13000901"] == "west"


def test_crime_job(spark, layers):
    rows = [("Leith Walk", "Edinburgh", 2023, 1, 5), ("Leith Walk", "Edinburgh", 2023, 1, 2),
            ("Eilean a Cheo", "Highland", 2023, 2, 4), ("Other / Unknown", "Edinburgh", 2023, 1, 9),
            ("Leith Walk", "North Ayrshire", 2023, 1, 100), ("Nowhere", "Fife", 2023, 3, 1)]
    raw = spark.createDataFrame(rows, "`PSOS_MMW_Name` string, `COUNCIL NAME` string, `CALENDAR YEAR` int, "
                                      "`CALENDAR MONTH` int, `DETECTED CRIME` long")
    out = {(r.ward_code, r.date): r["count"] for r in J.crime_job(raw, layers["look22"]).collect()}
    assert out[("S13000001", dt.date(2023, 1, 1))] == 7
    assert out[(None, dt.date(2023, 3, 1))] == 1          # unmatched name kept with a null code (X7)
    assert len(out) == 3


def _long(spark, index, rows):
    return spark.createDataFrame(rows, f"`{index}` string, `Highest level of qualification` string, Count string")


def test_education_job(spark, layers):
    levels11 = list(SP.EDUCATION_2011["column_rename"])[1:]
    def ward11(name, total, l1, l2, l3, l4, none):
        vals = dict(zip(levels11, [l1, l2, l3, l4, none, total]))
        return [(name, k, str(v)) for k, v in vals.items()]
    raw11 = _long(spark, "Electoral Ward 2007", ward11("West Ward", 100, 10, 10, 20, 40, 20)
                  + ward11("Old Town", 200, 20, 20, 40, 100, 20) + ward11("East", 50, 5, 5, 10, 20, 10))
    levels22 = list(SP.EDUCATION_2022["column_rename"])[1:]
    def ward22(name, vals):
        return [(name, k, str(v)) for k, v in zip(levels22, vals)]
    raw22 = _long(spark, "Electoral Ward 2022", ward22("Leith Walk", [100, 10, 10, 10, 30, 10, 30])
                  + ward22("Eilean a Cheo", [10, 1, 1, 1, 3, 1, 3]))
    # 2022 name needs the manual edit 'eileanacheo' -> 'eileanacha o' to meet the boundary name
    out = J.education_job(raw11, raw22, layers["look07"], layers["look22"], layers["cw"])
    rows = {(r.ward_code, r.date): r for r in out.collect()}
    assert len(rows) == 2 * 133
    first = rows[("S13000001", dt.date(2011, 1, 1))]
    # share of the source summed with area weights: West 0.6 * 1.0 + Old Town 0.7 * 0.5
    assert abs(first.pop_with_qual - (0.6 + 0.35)) < 1e-12
    last = rows[("S13000001", dt.date(2022, 1, 1))]
    assert abs(last.pop_with_qual - 0.7) < 1e-12 and abs(last.pop_without_qual - 0.3) < 1e-12
    mid = rows[("S13000001", dt.date(2016, 7, 1))]
    assert abs(mid.pop_with_qual - (0.95 + (0.7 - 0.95) * 66 / 132)) < 1e-12


def test_employment_job(spark, layers):
    c11 = ["Electoral Ward 2007", "All people aged 16 to 74", "Economically active: Employee",
           "Economically active: Unemployed", "Economically inactive: Looking after home or family",
           "Economically inactive: Long-term sick or disabled"]
    raw11 = spark.createDataFrame([("West Ward", "100", "50", "10", "5", "4"), ("Old Town", "200", "100", "20", "10", "8"),
                                   ("East", "50", "25", "5", "2", "1")], ", ".join(f"`{c}` string" for c in c11))
    c22 = ["Economic activity - 20 groups, all", "All people aged 16 and over"] + SP.EMPLOYMENT_2022["active_columns"] \
        + SP.EMPLOYMENT_2022["unemployed_columns"] + ["Economically inactive - Looking after home/ family",
                                                      "Economically inactive - Long term sick or disabled"]
    raw22 = spark.createDataFrame([("Leith Walk", "100", "40", "10", "4", "1", "5", "6"),
                                   ("Eilean a Cheo", "10", "4", "1", "1", "0", "1", "1")],
                                  ", ".join(f"`{c}` string" for c in c22))
    out = J.employment_job(raw11, raw22, layers["look07"], layers["look22"], layers["cw"])
    rows = {(r.ward_code, r.date): r for r in out.collect()}
    assert len(rows) == 2 * 133
    first = rows[("S13000001", dt.date(2011, 1, 1))]
    # reference rule (X3): the denominator sums columns still named "economically active",
    # i.e. without the renamed unemployed column: West 10/50, Old Town 20/100
    assert abs(first.unemployed_adults - (0.2 * 1.0 + 0.2 * 0.5)) < 1e-12
    assert abs(first.caring_for_family - (0.05 + 0.05 * 0.5)) < 1e-12
    last = rows[("S13000001", dt.date(2022, 1, 1))]
    assert abs(last.unemployed_adults - 5 / 50) < 1e-12


def test_population_density_job(spark):
    def sheet(name, rows):
        pre = [(name, 0, "Estimates", None, None, None, None, None), (name, 1, None, None, None, None, None, None),
               (name, 2, "Electoral Ward 2022 Name", "Electoral Ward 2022 Code", "Sex", "Total", "Age 0", "Age 1")]
        return pre + [(name, 3 + i, *r) for i, r in enumerate(rows)]
    rows = sheet("2001", [("Leith Walk", "S13000001", "Persons", "1000", "5", "5"),
                          ("Leith Walk", "S13000001", "Males", "480", "2", "3")]) \
        + sheet("2021", [("Leith Walk", "S13000001", "Persons", "1240", "5", "5")]) \
        + sheet("Notes", [("x", "y", "z", "w", "v", "u")])
    raw = spark.createDataFrame(rows, "sheet string, _row int, _c0 string, _c1 string, _c2 string, _c3 string, "
                                      "_c4 string, _c5 string")
    area = spark.createDataFrame([("S13000001", "Leith Walk", 2_000_000.0), ("E05000001", "Elsewhere", 1.0)],
                                 "WD24CD string, WD24NM string, Shape__Area double")
    out = J.population_density_job(raw, area).orderBy("date").collect()
    assert len(out) == 289
    assert out[0].population_density == 500.0 and out[240].population_density == 620.0
    assert out[-1].date == dt.date(2025, 1, 1) and out[-1].population_density == 620.0
    assert abs(out[120].population_density - 560.0) < 1e-9


def test_ward_area_and_names(spark, layers):
    area = spark.createDataFrame([("S1", "a", 2e6), ("x1", "b", 1.0), ("E1", "c", 3.0)],
                                 "WD24CD string, WD24NM string, Shape__Area double")
    got = {r.ward_code: r.area for r in J.ward_area_job(area).collect()}
    assert got == {"S1": 2.0}
    names = {r.ward_code: r.ward_name for r in J.name_lookup_job(layers["f22"]).collect()}
    assert names["S13000001"] == "Leith Walk"


def test_boundary_job(spark, layers):
    out = J.boundary_job(layers["f22"])
    r = out.agg(F.min("x"), F.max("y")).first()
    assert -3.5 < r[0] < -3.0 and 55.8 < r[1] < 56.1
    assert out.select("ward_code").distinct().count() == 2


def test_training_and_scoring(spark):
    months = [dt.date(2015 + m // 12, m % 12 + 1, 1) for m in range(24)]
    wards = ["S1", "S2", "S3"]
    crime = spark.createDataFrame([(10 + (i * 7 + m) % 5, w, d) for i, w in enumerate(wards)
                                   for m, d in enumerate(months)], "count long, ward_code string, date date")
    edu = spark.createDataFrame([(w, 0.3 + i / 10, 0.7 - i / 10, d) for i, w in enumerate(wards) for d in months],
                                "ward_code string, pop_with_qual double, pop_without_qual double, date date")
    emp = spark.createDataFrame([(w, d, 0.05, 0.04 + m / 1000, 0.03) for w in wards for m, d in enumerate(months)],
                                "ward_code string, date date, unemployed_adults double, "
                                "long_term_sick_or_disabled double, caring_for_family double")
    den = spark.createDataFrame([(w, d, 100.0 + m) for w in wards for m, d in enumerate(months)],
                                "ward_code string, date date, population_density double")
    names = spark.createDataFrame([(w, w.lower()) for w in wards], "ward_code string, ward_name string")
    out = J.training_job(crime, edu, emp, den, names, num_trees=20)
    res = out["results"].collect()
    assert len(res) == 7  # ceil(0.1 * 63) rows, the last in (ward, date) order
    assert {r.ward_code for r in res} == {"S3"}
    m = out["metrics"].first()
    assert m.n == 7 and m.rmse >= 0
    scored = J.scoring_job(out["model"], crime, edu, emp, den).collect()
    assert len(scored) == 3 and all(r.date == dt.date(2017, 1, 1) for r in scored)
