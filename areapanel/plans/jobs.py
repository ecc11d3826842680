"""Whole jobs (J1-J9): specs in, published tables out.

Each job is a lazy composition of the operators; the caller decides where the
inputs come from (``areapanel.sources``) and where results go
(``areapanel.sinks``). Steps that the reference ran in per-area Python loops
(densify, interpolate, fit) run for all areas at once, partitioned by area.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import year_month_date
from ..functions.text import normalise_name
from ..operators import checks as C
from ..operators import columns as B
from ..operators import features as M
from ..operators import models as ML
from ..operators import relational as R
from ..operators import spatial as G
from ..operators import topology as TP
from ..operators import timeseries as TS
from ..sources.files import pick_sheet, promote_header
from ..session import reliable_checkpoint, write_scratch
from . import specs as SP


def _numbers(df: DataFrame, keep_text: Sequence[str]) -> DataFrame:
    """Cast every column except ``keep_text`` to double (ANSI: bad text raises)."""
    return df.withColumns({c: B.q(c).cast("double") for c in df.columns if c not in set(keep_text)})


# --- boundaries, lookups, crosswalk (A8, H3, I4, J5, J6) -------------------------------------

def boundary_lookup(features: DataFrame, spec: Mapping, year: str, normalise: bool = True
                    ) -> tuple[DataFrame, DataFrame]:
    """Boundary features → (geometry keyed ``area_code``, lookup ``(ward_code_Y, ward_name_Y)``)
    with name keys and the code-based disambiguation applied."""
    prefix = spec.get("code_prefix", "S")
    code, name = f"ward_code_{year}", f"ward_name_{year}"
    vertices = G.geojson_vertices(features, props={spec["code"]: "area_code"}).where(F.col("area_code").startswith(prefix))
    lookup = G.boundary_names(features, spec["code"], spec["name"], year, prefix, normalise_name if normalise else None)
    lookup = B.disambiguate(lookup, code, name, spec.get("name_disambiguation", {}))
    return vertices.select("area_code", "part", "ring", "seq", "x", "y"), lookup


def crosswalk(geometry_2007: DataFrame, geometry_2022: DataFrame) -> DataFrame:
    """``(ward_code_2007, ward_code_2022, overlap_pct)``: share of each 2007 ward's area
    lying in each 2022 ward."""
    w = G.overlap_weights(geometry_2007, geometry_2022)
    cw = w.select(F.col("source_code").alias("ward_code_2007"), F.col("target_code").alias("ward_code_2022"),
                  F.col("weight").alias("overlap_pct"))
    # Computed once and written to the shared checkpoint folder, where the jobs that use it read it.
    return reliable_checkpoint(cw)


def name_lookup_job(features_2022: DataFrame, spec: Mapping = SP.BOUNDARIES_2022) -> DataFrame:
    """``(ward_code, ward_name)`` with the boundary file's names as read."""
    lookup = G.boundary_names(features_2022, spec["code"], spec["name"], "2022")
    return lookup.select(F.col("ward_code_2022").alias("ward_code"), F.col("ward_name_2022").alias("ward_name"))


def boundary_job(features_2022: DataFrame, spec: Mapping = SP.BOUNDARIES_2022,
                 tolerance: float = SP.SIMPLIFY_TOLERANCE_DEGREES) -> DataFrame:
    """Boundary vertices with codes containing ``S`` (any case), reprojected from the
    British National Grid to WGS84 and simplified with shared borders kept; vertex table keyed ``ward_code``."""
    v = G.geojson_vertices(features_2022, props={spec["code"]: "ward_code"})
    v = B.contains_all(v, "ward_code", "S")
    v = G.project_vertices(v.select("ward_code", "part", "ring", "seq", "x", "y"), "EPSG:4326")
    return TP.simplify_topology(v, tolerance, key="ward_code")


# --- J1 crime ---------------------------------------------------------------------------------

def crime_job(raw: DataFrame, lookup_2022: DataFrame, spec: Mapping = SP.CRIME) -> DataFrame:
    """Crime workbooks (all years in one frame) → ``(count, ward_code, date)``."""
    df = B.rename_columns(raw, spec["column_rename"])
    df = B.subset_columns(df, list(spec["column_rename"].values()))
    df = B.exclude_values(df, "council_name", spec["excluded_councils"])
    df = B.exclude_values(df, "ward_name_2022", spec["excluded_wards"])
    df = B.value_edits(df, "ward_name_2022", spec["manual_ward_edits"])
    df = B.transform_column(df, "ward_name_2022", normalise_name)
    df = R.group_sum(df, ["ward_name_2022", "council_name", "year", "month"], "count")
    df = R.lookup_left_join(df, lookup_2022.select("ward_name_2022", "ward_code_2022"), "ward_name_2022")
    df = B.rename_columns(df, {"ward_code_2022": "ward_code"})
    df = B.drop_columns(df, ["ward_name_2022", "council_name"])
    return df.select(F.col("count").cast("bigint").alias("count"), "ward_code",
                     year_month_date("year", "month").alias("date"))


# --- J2 education -----------------------------------------------------------------------------

def _education_year(raw_long: DataFrame, spec: Mapping, lookup: DataFrame, year: str) -> DataFrame:
    name, code = f"ward_name_{year}", f"ward_code_{year}"
    levels = [k for k in spec["column_rename"] if k != spec["index"]]
    long = raw_long.withColumn(spec["values"], B.q(spec["values"]).cast("double"))
    wide = R.pivot_wide(long, spec["index"], spec["columns"], spec["values"], pivot_values=levels)
    wide = B.rename_columns(wide, spec["column_rename"])
    wide = B.transform_column(wide, name, normalise_name)
    wide = B.value_edits(wide, name, spec["manual_ward_edits"])
    wide = R.lookup_left_join(wide, lookup.select(name, code), name)
    wide = B.row_sum_column(wide, "pop_with_qual", spec["with_qual"])
    wide = B.row_sum_column(wide, "pop_without_qual", spec["without_qual"])
    return B.fractions(wide, {"pop_with_qual": "total_population", "pop_without_qual": "total_population"})


# What the published education table must look like.
EDUCATION_SCHEMA = T.StructType([
    T.StructField("ward_code", T.StringType(), False), T.StructField("pop_with_qual", T.DoubleType(), False),
    T.StructField("pop_without_qual", T.DoubleType(), False), T.StructField("date", T.DateType(), False)])


def education_job(raw_2011: DataFrame, raw_2022: DataFrame, lookup_2007: DataFrame, lookup_2022: DataFrame,
                  crosswalk_df: DataFrame, spec_2011: Mapping = SP.EDUCATION_2011,
                  spec_2022: Mapping = SP.EDUCATION_2022, check: bool = True) -> DataFrame:
    """Census qualification counts (long form) for 2011 (2007 wards, moved to 2022
    wards by area share) and 2022 → monthly shares 2011-01 … 2022-01 per 2022 ward."""
    e11 = _education_year(raw_2011, spec_2011, lookup_2007, "2007")
    e11 = B.subset_columns(e11, ["ward_code_2007", "pop_with_qual", "pop_without_qual"])
    e11 = R.crosswalk_join(e11, crosswalk_df, "ward_code_2007")
    e11 = B.apply_weight(e11, "overlap_pct", ["pop_with_qual", "pop_without_qual"])
    e11 = R.group_sum(e11, "ward_code_2022", ["pop_with_qual", "pop_without_qual"])
    e11 = B.set_date(e11, "date", spec_2011["date"])
    e22 = _education_year(raw_2022, spec_2022, lookup_2022, "2022")
    e22 = B.subset_columns(e22, ["ward_code_2022", "pop_with_qual", "pop_without_qual"])  # X2: no name column
    e22 = B.set_date(e22, "date", spec_2022["date"])
    # Rows that matched no ward belong to no series.
    both = R.stack_frames([e11, e22]).withColumnRenamed("ward_code_2022", "ward_code").where("ward_code IS NOT NULL")
    out = TS.densify_linear(both, "ward_code", "date", ["pop_with_qual", "pop_without_qual"])
    out = out.select("ward_code", "pop_with_qual", "pop_without_qual", "date")
    if check:
        gate = C.Gate(EDUCATION_SCHEMA, "ward_code", "date", spec_2011["date"])
        out = write_scratch(gate.attach(out), "education")  # the one job that computes the table also checks it
        gate.verify()
    return out


# --- J3 employment ----------------------------------------------------------------------------

def employment_job(raw_2011: DataFrame, raw_2022: DataFrame, lookup_2007: DataFrame, lookup_2022: DataFrame,
                   crosswalk_df: DataFrame, spec_2011: Mapping = SP.EMPLOYMENT_2011,
                   spec_2022: Mapping = SP.EMPLOYMENT_2022) -> DataFrame:
    """Census economic-activity tables (wide form) → monthly rates per 2022 ward."""
    rates = {"caring_for_family": "total_pop", "long_term_sick_or_disabled": "total_pop",
             "unemployed_adults": "economically_active_adults"}
    keep = ["unemployed_adults", "long_term_sick_or_disabled", "caring_for_family"]

    d11 = B.rename_columns(raw_2011, spec_2011["column_rename"])
    d11 = _numbers(d11, ["ward_name_2007"])
    active = spec_2011.get("active_columns") or [c for c in d11.columns
                                                 if spec_2011["active_contains"] in c.lower()]
    d11 = B.row_sum_column(d11, "economically_active_adults", active)
    d11 = B.fractions(d11, rates)
    d11 = B.subset_columns(d11, ["ward_name_2007", *keep])
    d11 = B.transform_column(d11, "ward_name_2007", normalise_name)
    d11 = B.value_edits(d11, "ward_name_2007", spec_2011["manual_ward_edits"])
    d11 = R.lookup_left_join(d11, lookup_2007.select("ward_name_2007", "ward_code_2007"), "ward_name_2007")
    d11 = B.drop_columns(d11, "ward_name_2007")
    d11 = R.crosswalk_join(d11, crosswalk_df, "ward_code_2007")
    d11 = B.apply_weight(d11, "overlap_pct", keep)
    d11 = R.group_sum(d11, "ward_code_2022", keep).withColumnRenamed("ward_code_2022", "ward_code")
    d11 = B.set_date(d11, "date", spec_2011["date"])

    d22 = B.rename_columns(raw_2022, spec_2022["column_rename"])
    d22 = _numbers(d22, ["ward_name_2022"])
    d22 = B.row_sum_column(d22, "economically_active_adults", spec_2022["active_columns"])
    d22 = B.row_sum_column(d22, "unemployed_adults", spec_2022["unemployed_columns"])
    d22 = B.fractions(d22, rates)
    d22 = B.subset_columns(d22, ["ward_name_2022", "caring_for_family", "long_term_sick_or_disabled",
                                 "unemployed_adults"])
    d22 = B.transform_column(d22, "ward_name_2022", normalise_name)
    d22 = B.value_edits(d22, "ward_name_2022", spec_2022["manual_ward_edits"])
    d22 = R.lookup_left_join(d22, lookup_2022.select("ward_name_2022", "ward_code_2022"), "ward_name_2022")
    d22 = B.drop_columns(d22, "ward_name_2022").withColumnRenamed("ward_code_2022", "ward_code")
    d22 = B.set_date(d22, "date", spec_2022["date"])

    both = R.stack_frames([d11, d22]).where("ward_code IS NOT NULL")
    out = TS.densify_linear(both, "ward_code", "date", keep)
    return out.select("ward_code", "date", *keep)


# --- J4 population density, J9 ward areas -----------------------------------------------------

def ward_area_job(area_csv: DataFrame, spec: Mapping = SP.WARD_AREA) -> DataFrame:
    """``(ward_code, area)`` in km² for codes containing ``S`` (any case, X13)."""
    df = B.contains_all(area_csv, spec["code"], spec["code_contains"])
    df = B.drop_columns(df, keep_only=[spec["code"], spec["area"]])
    df = B.rename_columns(df, spec["rename"])
    return B.scale_column(df.withColumn("area", F.col("area").cast("double")), "area", spec["scale"])


def population_density_job(sheet_rows: DataFrame, area_csv: DataFrame, spec: Mapping = SP.POPULATION
                           ) -> DataFrame:
    """Yearly population sheets (raw rows with a ``sheet`` column) + ward areas →
    monthly density, linear between the two years, flat to the end date."""
    area = ward_area_job(area_csv)
    frames = []
    for sheet, date in spec["years"].items():
        raw = pick_sheet(sheet_rows, sheet)
        df = promote_header(raw, spec["header_regex"])
        df = B.drop_columns(df, contains=spec["drop_contains"])
        df = B.contains_all(df, spec["sex_col"], spec["sex_value"])
        df = B.drop_columns(df, spec["drop"])
        df = B.rename_columns(df, spec["column_rename"])
        df = B.set_date(df.withColumn("total_population", F.col("total_population").cast("double")), "date", date)
        frames.append(df.select("ward_code", "total_population", "date"))
    pop = R.stack_frames(frames)
    dens = R.ratio_join_density(pop, area, "ward_code", "total_population", "area")
    monthly = TS.densify_linear(dens, "ward_code", "date", "population_density")
    return TS.extend_flat(monthly, "ward_code", "date", spec["end_date"]).select(
        "ward_code", "date", "population_density")


# --- J7 training, J8 scoring ------------------------------------------------------------------

def _panels(crime: DataFrame, education: DataFrame, employment: DataFrame, density: DataFrame) -> list[DataFrame]:
    return [crime.where(F.col("ward_code").isNotNull()), education, employment, density]


def training_job(crime: DataFrame, education: DataFrame, employment: DataFrame, density: DataFrame,
                 names: DataFrame, model_path: str | None = None, test_fraction: float = 0.1,
                 num_trees: int = ML.FOREST_TREES) -> dict:
    """Features → ordered 90/10 split → forest → test predictions and metrics.

    Returns ``{"model", "results", "metrics", "metrics_by_area", "first_areas"}``.
    """
    feats, _ = M.training_features(_panels(crime, education, employment, density), "ward_code", "date", "count",
                                   "population_density", names=names)
    cols = [c for c in M.MODEL_FEATURES if c in feats.columns]
    train, test = R.ordered_split(feats, ["ward_code", "date"], test_fraction)
    model = ML.fit(ML.forest_pipeline(cols, num_trees=num_trees), train)
    results = ML.predict_frame(model, test, "ward_code")
    if model_path:
        ML.save_model(model, model_path)
    return {"model": model, "results": results, "metrics": ML.regression_metrics(results),
            "metrics_by_area": ML.metrics_by_area(results, "ward_code"),
            "first_areas": R.first_k_keys(results, "ward_code", 4)}


def scoring_job(model, crime: DataFrame, education: DataFrame, employment: DataFrame, density: DataFrame,
                months: int = 1) -> DataFrame:
    """Next month's predicted count for every ward: ``(ward_code, date, crime_prediction)``; with ``months`` above one
    the months after it too, each predicted from the ones before, and a column ``step``."""
    hist = R.join_panels(_panels(crime, education, employment, density), ("ward_code", "date"))
    if months > 1:
        return ML.forecast_months(model, reliable_checkpoint(hist), months, "ward_code", "date", "count", "population_density")
    rows = M.prediction_features(hist, "ward_code", "date", "count", "population_density")
    return ML.score(model, rows, "ward_code")
