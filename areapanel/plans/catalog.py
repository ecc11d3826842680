"""Registered queries: each SURVEY §2 operator run on the driver's test tables.

Every function takes ``(spark, sf_dir)`` and returns a DataFrame over the
whole tables (no id subsets, no row caps except where a limit is the feature).
``oracle.py`` holds the equivalent DuckDB SQL under the same names; computed
columns carry the same aliases there. Doubles that depend on summation order
are rounded on both sides; integer results are BIGINT on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import numeric as N
from ..functions.text import normalise_name as normalise_name_expr
from ..operators import checks as C
from ..operators import columns as B
from ..operators import relational as R
from ..operators import timeseries as TS
from . import standins as S

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}

ROUND = 6  # decimals kept for derived doubles on both sides of the oracle check


def register(fn: QueryFn) -> QueryFn:
    REGISTRY[fn.__name__.removeprefix("q_")] = fn
    return fn


def _r(c, k: int = ROUND):
    return F.round(c, k)


# --- J1 minimum slice -------------------------------------------------------------------------

EXCLUDED_SEGMENTS = ["AUTOMOBILE"]
EXCLUDED_NAMES = ["NATION_3"]


@register
def q_monthly_area_counts(spark: SparkSession, sf: str) -> DataFrame:
    """J1 on test tables: order rows → exclusions → name key → monthly sums →
    code lookup on the name key → first-of-month date."""
    nation = S.table(spark, sf, "nation")
    rows = (S.order_rows(spark, sf)
            .join(nation.select("n_nationkey", "n_name"),
                  F.col("c_nationkey") == F.col("n_nationkey"))
            .select(F.col("n_name").alias("ward_name"), F.col("c_mktsegment").alias("council_name"),
                    F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"),
                    F.lit(1).cast("bigint").alias("count")))
    rows = B.exclude_values(rows, "council_name", EXCLUDED_SEGMENTS)
    rows = B.exclude_values(rows, "ward_name", EXCLUDED_NAMES)
    rows = B.transform_column(rows, "ward_name", normalise_name_expr)
    summed = R.group_sum(rows, ["ward_name", "year", "month"], "count")
    lookup = nation.select(normalise_name_expr("n_name").alias("ward_name"),
                           S.area_code("n_nationkey").alias("ward_code"))
    joined = R.lookup_left_join(summed, lookup, "ward_name")
    return joined.select("count", "ward_code", D.year_month_date("year", "month").alias("date"))


# --- projections and filters ------------------------------------------------------------------

@register
def q_group_sum(spark, sf):
    li = S.table(spark, sf, "lineitem")
    out = R.group_sum(li, ["l_returnflag", "l_linestatus"], ["l_quantity", "l_extendedprice"])
    return out.select("l_returnflag", "l_linestatus", _r(F.col("l_quantity"), 2).alias("l_quantity"),
                      _r(F.col("l_extendedprice"), 2).alias("l_extendedprice"))


@register
def q_group_sum_wide(spark, sf):
    nation = S.table(spark, sf, "nation").select("n_nationkey", "n_name")
    rows = (S.order_rows(spark, sf).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(F.col("c_mktsegment").alias("council_name"), F.col("n_name").alias("ward_name"),
                    F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"),
                    F.col("o_orderstatus").alias("crime_group"), F.col("o_orderpriority").alias("group_description"),
                    F.lit(1).cast("bigint").alias("count")))
    return R.group_sum(rows, ["council_name", "ward_name", "year", "month", "crime_group", "group_description"],
                       "count")


def _keyed_one_up(spark, sf):
    """Nation lookup under keys one higher, so that the lowest key has no row (a lookup with misses)."""
    return S.table(spark, sf, "nation").select((F.col("n_nationkey") + 1).alias("c_nationkey"), "n_name", "n_regionkey")


@register
def q_lookup_left_join(spark, sf):
    customer = S.table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = _keyed_one_up(spark, sf).select("c_nationkey", F.col("n_name").alias("c_name"), "n_regionkey")
    return R.lookup_left_join(customer, nation, "c_nationkey")


@register
def q_exclude_values(spark, sf):
    c = S.table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return B.exclude_values(c, "c_mktsegment", ["AUTOMOBILE", "BUILDING"])


@register
def q_contains_all(spark, sf):
    p = S.table(spark, sf, "part").select("p_partkey", "p_name")
    return B.contains_all(p, "p_name", ["R", "i.g"])


@register
def q_prefix_filter(spark, sf):
    c = S.table(spark, sf, "customer").select("c_custkey", "c_name")
    return B.prefix_filter(c, "c_name", "Customer#00000001")


@register
def q_split_rows(spark, sf):
    o = S.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    eq, ne = B.split_rows(o, "o_orderstatus", "F")
    return eq.withColumn("half", F.lit("eq")).unionByName(ne.withColumn("half", F.lit("ne")))


@register
def q_rename_columns(spark, sf):
    return B.rename_columns(S.table(spark, sf, "nation"), {"n_nationkey": "ward_code", "n_name": "ward_name"})


@register
def q_subset_columns(spark, sf):
    return B.subset_columns(S.table(spark, sf, "orders"), ["o_orderkey", "o_custkey", "o_totalprice"])


@register
def q_drop_columns_by_pattern(spark, sf):
    li = S.table(spark, sf, "lineitem")
    return B.drop_columns(li, ["l_tax"], contains="ship")


@register
def q_select_by_suffix(spark, sf):
    n = S.table(spark, sf, "nation").select(
        S.area_code("n_nationkey").alias("ward_code"), F.col("n_name").alias("name_2011"),
        F.lower("n_name").alias("name_2022"), F.col("n_regionkey").alias("region_2011"))
    return B.select_by_suffix(n, "_2011", key="ward_code")


@register
def q_set_date(spark, sf):
    return B.set_date(S.table(spark, sf, "nation").select("n_nationkey", "n_name"), "date", "2011-01-01")


@register
def q_stack_frames(spark, sf):
    c = S.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    s = S.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("acctbal"),
                                              F.col("s_name").alias("name"))
    return R.stack_frames([c, s])


@register
def q_combine_year_month(spark, sf):
    o = S.table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"),
                                            F.month("o_orderdate").alias("month"))
    return o.select("o_orderkey", D.year_month_date("year", "month").alias("date"))


@register
def q_month_diff(spark, sf):
    o = S.table(spark, sf, "orders")
    return o.select("o_orderkey",
                    D.month_diff(F.col("o_orderdate").cast("date"), F.lit("1995-01-01").cast("date"))
                    .cast("bigint").alias("months"),
                    D.months_elapsed(F.col("o_orderdate").cast("date"), F.lit("1995-01-31").cast("date"))
                    .cast("bigint").alias("whole_months"))


@register
def q_normalise_column_names(spark, sf):
    n = S.table(spark, sf, "nation").toDF("Nation Key (ID)", "Nation Name", "Region  Key")
    return B.normalise_column_names(n)


@register
def q_find_column(spark, sf):
    li = S.table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", B.find_column(li, "extended"))


@register
def q_require_columns(spark, sf):
    c = C.require_columns(S.table(spark, sf, "customer"), ["c_custkey", "c_acctbal"])
    return c.select("c_custkey", "c_acctbal")


# --- arithmetic and scalar functions ----------------------------------------------------------

@register
def q_ratio_column(spark, sf):
    li = S.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_tax")
    out = B.ratio_column(li, "discount_per_tax", "l_discount", "l_tax")
    return out.select("l_orderkey", "l_linenumber", _r(F.col("discount_per_tax")).alias("discount_per_tax"))


@register
def q_fractions(spark, sf):
    li = S.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    out = B.fractions(li, {"l_discount": "l_tax", "l_quantity": "l_discount"})
    return out.select("l_orderkey", "l_linenumber", _r(F.col("l_discount")).alias("l_discount"),
                      _r(F.col("l_quantity")).alias("l_quantity"))


@register
def q_row_sum(spark, sf):
    li = S.table(spark, sf, "lineitem")
    out = B.row_sum_column(li, "total", ["l_quantity", "l_discount", "l_tax"])
    return out.select("l_orderkey", "l_linenumber", _r(F.col("total")).alias("total"))


@register
def q_apply_weight(spark, sf):
    li = S.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
                                               "l_discount")
    out = B.apply_weight(li, "l_discount", ["l_quantity", "l_extendedprice"])
    return out.select("l_orderkey", "l_linenumber", _r(F.col("l_quantity")).alias("l_quantity"),
                      _r(F.col("l_extendedprice")).alias("l_extendedprice"), "l_discount")


@register
def q_density(spark, sf):
    pop = S.panel(spark, sf).select("area_code", "date", F.col("count").alias("population"))
    area = S.table(spark, sf, "nation").select(S.area_code("n_nationkey").alias("area_code"),
                                               ((F.col("n_regionkey") + 1) * 1.5e6).alias("area"))
    area = B.scale_column(area, "area", 1e-6)
    out = R.ratio_join_density(pop, area, "area_code", "population", "area")
    return out.select("area_code", "date", _r(F.col("population_density")).alias("population_density"))


@register
def q_log_features(spark, sf):
    p = S.panel(spark, sf)
    return p.select("area_code", "date", _r(N.log1p_value("count")).alias("count_log1p"),
                    _r(N.ln_value("value")).alias("value_ln"))


@register
def q_to_number(spark, sf):
    e = S.table(spark, sf, "events")
    return e.select("event_id", N.to_number(F.regexp_extract("props", r"(-?\d+(\.\d+)?)", 1), strict=False)
                    .alias("k"))


@register
def q_to_number_strict(spark, sf):
    """H4 strict: account balances as text, parsed back; text that is no number would fail the query."""
    c = S.table(spark, sf, "customer")
    return c.select("c_custkey", N.to_number(F.concat(F.lit(" "), F.col("c_acctbal").cast("string"))).alias("acctbal"),
                    N.nan_to_null(F.when(F.col("c_custkey") % 7 == 0, F.lit("NaN").cast("double")).otherwise(
                        F.col("c_acctbal"))).alias("known"))


VALUE_EDITS = {"NATION_1": "nation one", "NATION_2": "nation two", "NATION_24": "nation twenty-four"}
DISAMBIGUATION = {"S00000003": "nationthree_north", "S00000013": "nationthirteen_south"}


@register
def q_value_edits(spark, sf):
    n = S.table(spark, sf, "nation").select("n_nationkey", "n_name")
    return B.value_edits(n, "n_name", VALUE_EDITS)


@register
def q_disambiguate(spark, sf):
    return B.disambiguate(S.names(spark, sf), "area_code", "area_name", DISAMBIGUATION)


@register
def q_apply_column_function(spark, sf):
    p = S.table(spark, sf, "part").select("p_partkey", "p_name")
    return B.transform_column(p, "p_name", lambda c: F.upper(F.trim(c)))


@register
def q_to_month_date(spark, sf):
    o = S.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return o.select("o_orderkey",
                    D.to_month_date(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("order_date"),
                    D.to_month_date(F.year("o_orderdate").cast("string")).alias("year_start"))


@register
def q_normalise_name(spark, sf):
    d = S.table(spark, sf, "documents").select("doc_id", "text")
    return d.select("doc_id", normalise_name_expr("text").alias("name_key"))


@register
def q_normalise_name_parts(spark, sf):
    p = S.table(spark, sf, "part").select("p_partkey", "p_name", "p_type")
    return p.select("p_partkey", normalise_name_expr(F.concat_ws(" and ", "p_name", "p_type")).alias("name_key"))


# --- pivot ------------------------------------------------------------------------------------

@register
def q_pivot_wide(spark, sf):
    li = S.table(spark, sf, "lineitem")
    long = R.group_sum(li, ["l_suppkey", "l_returnflag"], "l_quantity") \
        .withColumn("l_quantity", _r(F.col("l_quantity"), 2))
    return R.pivot_wide(long, "l_suppkey", "l_returnflag", "l_quantity", pivot_values=["A", "N", "R"])


# --- time series ------------------------------------------------------------------------------

@register
def q_expand_months(spark, sf):
    return TS.expand_months(S.anchors(S.panel(spark, sf), "count"), "area_code", "date")


@register
def q_densify_linear(spark, sf):
    out = TS.densify_linear(S.anchors(S.panel(spark, sf), "value"), "area_code", "date", "value")
    return out.withColumn("value", _r(F.col("value")))


@register
def q_extend_flat(spark, sf):
    return TS.extend_flat(S.panel(spark, sf), "area_code", "date", "2002-01-01")


def _gapped_panel(spark, sf):
    p = S.panel(spark, sf)
    return p.withColumn("value", F.when(~F.month("date").isin(3, 4, 7), F.col("value")))


@register
def q_interpolate_linear(spark, sf):
    out = TS.interpolate_linear(_gapped_panel(spark, sf), "area_code", "date", "value")
    return out.select("area_code", "date", "count", _r(F.col("value")).alias("value"))


@register
def q_resample_monthly(spark, sf):
    # mean price in cents: cents are whole numbers, so their sums do not depend on the order of the rows
    rows = S.order_rows(spark, sf).select(S.area_code("c_nationkey").alias("area_code"), "o_orderdate",
                                          F.round(F.col("o_totalprice") * 100).alias("o_totalprice"))
    out = TS.resample_monthly(rows, "area_code", "o_orderdate", "o_totalprice")
    return out.select("area_code", F.col("o_orderdate").alias("date"), _r(F.col("o_totalprice")).alias("value"))


@register
def q_sheets_to_monthly(spark, sf):
    rows = S.order_rows(spark, sf).select(S.area_code("c_nationkey").alias("area_code"),
                                          F.year("o_orderdate").cast("string").alias("sheet"),
                                          F.col("o_totalprice"))
    yearly = rows.groupBy("area_code", "sheet").agg(F.count(F.lit(1)).cast("double").alias("total"))
    notes = yearly.select("area_code", F.lit("Notes").alias("sheet"), F.lit(-1.0).alias("total"))
    out = TS.sheets_to_monthly(yearly.unionByName(notes), "sheet", "area_code", "total")
    return out.select("area_code", "date", _r(F.col("total"), 4).alias("total"))


@register
def q_lag_features(spark, sf):
    out = TS.lag_features(S.panel(spark, sf).select("area_code", "date", "count"), "area_code", "date", "count",
                          names=["crime_last_month", "crime_last_two_months", "crime_last_three_months"])
    return out


@register
def q_rolling_mean(spark, sf):
    out = TS.rolling_mean(S.panel(spark, sf).select("area_code", "date", "count"), "area_code", "date", "count",
                          name="crime_3month_avg")
    return out.withColumn("crime_3month_avg", _r(F.col("crime_3month_avg")))


@register
def q_latest_row(spark, sf):
    return R.latest_row(S.panel(spark, sf), "area_code", "date")


@register
def q_first_k_areas(spark, sf):
    return R.first_k_keys(S.panel(spark, sf), "area_code", 4)


@register
def q_ordered_split(spark, sf):
    train, test = R.ordered_split(S.panel(spark, sf), ["area_code", "date"], 0.1)
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


@register
def q_date_split(spark, sf):
    train, test = R.date_split(S.panel(spark, sf), "date", 0.1)
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


# --- checks -----------------------------------------------------------------------------------

@register
def q_check_nulls(spark, sf):
    customer = S.table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nation = _keyed_one_up(spark, sf)
    joined = R.lookup_left_join(customer, nation, "c_nationkey")
    return C.check_nulls(joined, ["c_custkey", "n_name", "n_regionkey"])


@register
def q_check_month_series(spark, sf):
    return C.check_month_series(S.panel(spark, sf), "area_code", "date") \
        .withColumn("position", F.col("position").cast("bigint"))


@register
def q_check_columns(spark, sf):
    """Q1 (with Q2 counts) on the flagship job's output."""
    return C.column_report(q_monthly_area_counts(spark, sf), ["count", "ward_code", "date", "population"])


@register
def q_check_schema(spark, sf):
    from pyspark.sql import types as T
    schema = T.StructType([
        T.StructField("area_code", T.StringType(), False),
        T.StructField("date", T.DateType(), False),
        T.StructField("count", T.DoubleType(), True),
        T.StructField("value", T.DoubleType(), False),
        T.StructField("population", T.LongType(), True),
    ])
    p = S.panel(spark, sf).withColumn("value", F.when(F.month("date") != 2, F.col("value")))
    return C.check_schema(p, schema)


# Further registered queries live in sibling modules; importing them fills REGISTRY.
from . import catalog_io  # noqa: E402,F401
from . import catalog_spatial  # noqa: E402,F401
from . import catalog_models  # noqa: E402,F401
from . import catalog_jobs  # noqa: E402,F401
