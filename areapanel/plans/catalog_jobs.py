"""Whole jobs run through ``plans.jobs`` on inputs derived from the test tables.

The raw inputs are shaped like the reference's source files (same column names),
built with DataFrame operations over the whole tables; each job spec is the
reference's spec with the values of the stand-in data.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalise_name
from ..operators import spatial as G
from . import jobs as J
from . import specs as SP
from . import standins as S
from .catalog import _r, register

# What differs on the test tables stands in a JSON file.
CRIME_SPEC = {**SP.CRIME, **SP.load_specs(Path(__file__).with_name("standin_specs.json"))["crime"]}


def crime_workbook_rows(spark, sf) -> DataFrame:
    """Order rows in the crime workbook's layout (one row per order, count 1)."""
    nation = S.table(spark, sf, "nation").select("n_nationkey", "n_name")
    return (S.order_rows(spark, sf).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(F.col("n_name").alias("PSOS_MMW_Name"), F.col("c_mktsegment").alias("COUNCIL NAME"),
                    F.year("o_orderdate").alias("CALENDAR YEAR"), F.month("o_orderdate").alias("CALENDAR MONTH"),
                    F.lit(1).cast("bigint").alias("DETECTED CRIME")))


def ward_lookup(spark, sf) -> DataFrame:
    return S.table(spark, sf, "nation").select(normalise_name("n_name").alias("ward_name_2022"),
                                               S.area_code("n_nationkey").alias("ward_code_2022"))


@register
def q_crime_job(spark, sf):
    """J1 through the job code: council kept in the grouping, then dropped."""
    return J.crime_job(crime_workbook_rows(spark, sf), ward_lookup(spark, sf), CRIME_SPEC)


def area_csv(spark, sf) -> DataFrame:
    """Ward-area file layout: code, name, area in m² (plus a non-Scottish row per nation)."""
    n = S.table(spark, sf, "nation")
    scot = n.select(S.area_code("n_nationkey").alias("WD24CD"), F.col("n_name").alias("WD24NM"),
                    ((F.col("n_regionkey") + 1) * 1.5e6).alias("Shape__Area"))
    other = n.select(F.concat(F.lit("E"), F.lpad(F.col("n_nationkey").cast("string"), 8, "0")).alias("WD24CD"),
                     F.col("n_name").alias("WD24NM"), F.lit(1.0).alias("Shape__Area"))
    return scot.unionByName(other)


@register
def q_ward_area(spark, sf):
    """Scottish codes only, m² → km²."""
    return J.ward_area_job(area_csv(spark, sf)).select("ward_code", _r(F.col("area")).alias("area"))


POP_SPEC = {**SP.POPULATION, "years": {"1996": "1996-01-01", "2000": "2000-01-01"}, "end_date": "2001-01-01"}


def population_sheets(spark, sf) -> DataFrame:
    """Population workbook rows: per year sheet (all years) a two-line preamble, the header row,
    then per area a 'Persons' and a 'Males' row (orders in that year stand in for people)."""
    rows = S.order_rows(spark, sf)
    per = rows.groupBy(F.year("o_orderdate").cast("string").alias("sheet"), "c_nationkey").count()
    nation = S.table(spark, sf, "nation").select("n_nationkey", "n_name")
    data = per.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    code = S.area_code("n_nationkey")
    persons = data.select("sheet", (F.col("n_nationkey") * 2 + 3).alias("_row"), F.col("n_name").alias("_c0"),
                          code.alias("_c1"), F.lit("Persons").alias("_c2"), F.col("count").cast("string").alias("_c3"),
                          F.lit("1").alias("_c4"), F.lit("2").alias("_c5"))
    males = data.select("sheet", (F.col("n_nationkey") * 2 + 4).alias("_row"), F.col("n_name").alias("_c0"),
                        code.alias("_c1"), F.lit("Males").alias("_c2"),
                        F.floor(F.col("count") / 2).cast("string").alias("_c3"), F.lit("0").alias("_c4"),
                        F.lit("1").alias("_c5"))
    sheets = per.select("sheet").distinct()
    head = [(0, "Population estimates", None, None, None, None, None), (1, None, None, None, None, None, None),
            (2, "Electoral Ward 2022 Name", "Electoral Ward 2022 Code", "Sex", "Total", "Age 0", "Age 1")]
    pre = sheets.select("sheet", F.explode(F.array(*[
        F.struct(F.lit(r).alias("_row"), *[F.lit(v).cast("string").alias(f"_c{i}") for i, v in enumerate(vals)])
        for r, *vals in head])).alias("h")).select("sheet", "h.*")
    return pre.unionByName(persons).unionByName(males)


@register
def q_population_density_job(spark, sf):
    """Sheets → header promotion → Persons → density → monthly line → flat to the end."""
    out = J.population_density_job(population_sheets(spark, sf), area_csv(spark, sf), POP_SPEC)
    return out.withColumn("population_density", _r(F.col("population_density")))


# --- J2 education: two census years on two boundary layers -----------------------------------

EDU_2011 = {**SP.EDUCATION_2011, "manual_ward_edits": {}}
EDU_2022 = {**SP.EDUCATION_2022, "manual_ward_edits": {}}
LAYER = {"code": "code", "name": "name", "name_disambiguation": {}}
LAYER_2007 = {**LAYER, "code_prefix": "P"}


def _long(df: DataFrame, index_col: str, index_name: str, levels: dict) -> DataFrame:
    """Long census layout ``(index, level, count)`` from per-area count columns."""
    arr = F.array(*[F.struct(F.lit(name).alias("level"), F.col(col).cast("string").alias("n"))
                    for name, col in levels.items()])
    return (df.select(F.col(index_col).alias(index_name), F.explode(arr).alias("r"))
            .select(index_name, F.col("r.level").alias("Highest level of qualification"),
                    F.col("r.n").alias("Count")))


def census_2011(spark, sf) -> DataFrame:
    li = S.table(spark, sf, "lineitem")
    per = li.groupBy("l_suppkey").agg(
        F.count_if(F.col("l_returnflag") == "A").alias("l1"), F.count_if(F.col("l_returnflag") == "N").alias("l2"),
        F.count_if(F.col("l_returnflag") == "R").alias("l3"), F.count_if(F.col("l_linestatus") == "F").alias("l4"),
        F.count_if(F.col("l_linestatus") == "O").alias("nq"), F.count(F.lit(1)).alias("tot"))
    sup = S.table(spark, sf, "supplier").select("s_suppkey", "s_name")
    per = per.join(sup, F.col("l_suppkey") == F.col("s_suppkey"))
    names = list(EDU_2011["column_rename"])[1:]
    return _long(per, "s_name", "Electoral Ward 2007", dict(zip(names, ["l1", "l2", "l3", "l4", "nq", "tot"])))


def census_2022(spark, sf) -> DataFrame:
    c = S.table(spark, sf, "customer")
    seg = F.col("c_mktsegment")
    per = c.groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("tot"), F.count_if(seg == "AUTOMOBILE").alias("nq"),
        F.count_if(seg == "BUILDING").alias("l1"), F.count_if(seg == "FURNITURE").alias("l2"),
        F.count_if(seg == "HOUSEHOLD").alias("l3"), F.count_if(seg == "MACHINERY").alias("l35"),
        F.count_if(F.col("c_acctbal") > 5000).alias("l4"))
    nation = S.table(spark, sf, "nation").select("n_nationkey", "n_name")
    per = per.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    names = list(EDU_2022["column_rename"])[1:]
    return _long(per, "n_name", "Electoral Ward 2022",
                 dict(zip(names, ["tot", "nq", "l1", "l2", "l3", "l35", "l4"])))


def layer_features(spark, sf, which: str) -> DataFrame:
    from ..sinks.tables import boundary_features
    if which == "2007":
        verts = S.supplier_squares(spark, sf)
        props = S.table(spark, sf, "supplier").select(
            F.concat(F.lit("P"), F.col("s_suppkey").cast("string")).alias("area_code"), F.col("s_name").alias("name"))
    else:
        verts = S.nation_cover(spark, sf)
        props = S.names(spark, sf).select("area_code", F.col("area_name").alias("name"))
    props = props.withColumn("code", F.col("area_code"))
    return boundary_features(verts, "area_code", props)


@register
def q_education_job(spark, sf):
    """2011 shares on old boundaries moved to new ones by area share, 2022 shares,
    monthly line in between; the run-time checks are on."""
    geo07, look07 = J.boundary_lookup(layer_features(spark, sf, "2007"), LAYER_2007, "2007")
    geo22, look22 = J.boundary_lookup(layer_features(spark, sf, "2022"), LAYER, "2022")
    cw = J.crosswalk(geo07, geo22)
    out = J.education_job(census_2011(spark, sf), census_2022(spark, sf), look07, look22, cw, EDU_2011, EDU_2022)
    return out.select("ward_code", _r(F.col("pop_with_qual")).alias("pop_with_qual"),
                      _r(F.col("pop_without_qual")).alias("pop_without_qual"), "date")


# --- J3 employment, J5 boundaries, J6 names ----------------------------------------------------

def employment_2011(spark, sf) -> DataFrame:
    """Wide 2011 layout per old area (counts from lineitem per supplier, as text)."""
    li = S.table(spark, sf, "lineitem")
    per = li.groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("tot"), F.count_if(F.col("l_linestatus") == "F").alias("emp"),
        F.count_if(F.col("l_returnflag") == "R").alias("unemp"), F.count_if(F.col("l_discount") < 0.02).alias("care"),
        F.count_if(F.col("l_tax") > 0.07).alias("sick"))
    sup = S.table(spark, sf, "supplier").select("s_suppkey", "s_name")
    per = per.join(sup, F.col("l_suppkey") == F.col("s_suppkey"))
    cols = {"Electoral Ward 2007": "s_name", "All people aged 16 to 74": "tot", "Economically active: Employee": "emp",
            "Economically active: Unemployed": "unemp",
            "Economically inactive: Looking after home or family": "care",
            "Economically inactive: Long-term sick or disabled": "sick"}
    return per.select(*[F.col(v).cast("string").alias(k) for k, v in cols.items()])


def employment_2022(spark, sf) -> DataFrame:
    """Wide 2022 layout per new area (counts from customer per nation, as text)."""
    c = S.table(spark, sf, "customer")
    seg = F.col("c_mktsegment")
    per = c.groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("tot"), F.count_if(seg == "BUILDING").alias("act1"),
        F.count_if(seg == "FURNITURE").alias("act2"), F.count_if(F.col("c_acctbal") < 0).alias("un1"),
        F.count_if(F.col("c_acctbal") > 9000).alias("un2"), F.count_if(seg == "HOUSEHOLD").alias("care"),
        F.count_if(seg == "MACHINERY").alias("sick"))
    nation = S.table(spark, sf, "nation").select("n_nationkey", "n_name")
    per = per.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    spec = SP.EMPLOYMENT_2022
    cols = {"Economic activity - 20 groups, all": "n_name", "All people aged 16 and over": "tot",
            spec["active_columns"][0]: "act1", spec["active_columns"][1]: "act2",
            spec["unemployed_columns"][0]: "un1", spec["unemployed_columns"][1]: "un2",
            "Economically inactive - Looking after home/ family": "care",
            "Economically inactive - Long term sick or disabled": "sick"}
    return per.select(*[F.col(v).cast("string").alias(k) for k, v in cols.items()])


@register
def q_employment_job(spark, sf):
    """2011 rates on old boundaries moved by area share, 2022 rates, monthly line."""
    geo07, look07 = J.boundary_lookup(layer_features(spark, sf, "2007"), LAYER_2007, "2007")
    geo22, look22 = J.boundary_lookup(layer_features(spark, sf, "2022"), LAYER, "2022")
    cw = J.crosswalk(geo07, geo22)
    out = J.employment_job(employment_2011(spark, sf), employment_2022(spark, sf), look07, look22, cw,
                           {**SP.EMPLOYMENT_2011, "manual_ward_edits": {}},
                           {**SP.EMPLOYMENT_2022, "manual_ward_edits": {}})
    return out.select("ward_code", "date", *[_r(F.col(c)).alias(c) for c in
                                             ("unemployed_adults", "long_term_sick_or_disabled", "caring_for_family")])


@register
def q_name_lookup_job(spark, sf):
    """Code → name as read from the new boundary features."""
    return J.name_lookup_job(layer_features(spark, sf, "2022"), LAYER)


@register
def q_boundary_job(spark, sf):
    """New boundaries placed on the British National Grid → WGS84 → simplified; coordinates as the grid has them."""
    from .catalog_spatial import grid_layer
    from ..sinks.tables import boundary_features
    verts = grid_layer(spark, sf)
    props = S.names(spark, sf).select("area_code", F.col("area_code").alias("code"))
    out = J.boundary_job(boundary_features(verts, "area_code", props), LAYER)
    back = G.project_vertices(out, "EPSG:27700")
    return back.select("ward_code", F.col("seq").cast("bigint").alias("seq"), F.round("x", 1).alias("x"), F.round("y", 1).alias("y"))
