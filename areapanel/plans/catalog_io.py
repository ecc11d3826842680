"""Registered queries for sources, sinks, links, served views and panel joins.

File-based sources are exercised by first rendering a test table into files
below the shared checkpoint folder (``spark.checkpoint.dir``) with a Spark
write, then reading them back with the source under test.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import normalise_name
from ..operators import relational as R
from ..operators import timeseries as TS
from ..operators.checks import Gate
from ..operators.columns import extract_lookup
from ..session import scratch_path
from ..sinks import tables as K
from ..sources import files as A
from ..sources import links as L
from ..sources.sql import param_sql
from . import standins as S
from . import views as V
from .catalog import _r, register


def _write_text_files(lines: DataFrame, part_col: str, path: str) -> str:
    """Write ``(part_col, section, k, value)`` lines as one text file per ``part_col``
    value, ordered by ``(section, k)`` inside each file."""
    (lines.repartition(part_col).sortWithinPartitions(part_col, "section", "k")
     .select(part_col, "value").write.mode("overwrite").partitionBy(part_col).text(path))
    return path


def _meta(key_df: DataFrame, part_col: str, entries: list[tuple[int, int, object]]) -> DataFrame:
    arr = F.array(*[F.struct(F.lit(s).alias("section"), F.lit(k).cast("long").alias("k"),
                             (v if not isinstance(v, str) else F.lit(v)).alias("value")) for s, k, v in entries])
    return key_df.select(part_col, F.explode(arr).alias("m")).select(part_col, "m.section", "m.k", "m.value")


def render_customer_extract(spark, sf) -> str:
    """Customers as CSV extracts, one file per market segment, with a 3-line preamble and a 2-line trailer."""
    c = S.table(spark, sf, "customer")
    seg = F.col("c_mktsegment")
    data = c.select(seg.alias("seg"), F.lit(2).alias("section"), F.col("c_custkey").alias("k"),
                    F.concat_ws(",", "c_custkey", "c_name", "c_nationkey",
                                F.col("c_acctbal").cast("string")).alias("value"))
    segs = c.select(seg.alias("seg")).distinct()
    meta = _meta(segs, "seg", [(0, 0, "Customer extract"), (0, 1, F.concat(F.lit("Segment: "), F.col("seg"))),
                               (0, 2, ""), (1, 0, "c_custkey,c_name,c_nationkey,c_acctbal"), (3, 0, ""),
                               (3, 1, "Source: test tables")])
    return _write_text_files(data.unionByName(meta), "seg", scratch_path(spark, "customer_extract"))


@register
def q_trimmed_csv(spark, sf):
    path = render_customer_extract(spark, sf)
    return A.read_trimmed_csv(spark, path, skiprows=3, skipfooter=2,
                              schema={"c_custkey": "bigint", "c_nationkey": "int", "c_acctbal": "double"})


@register
def q_read_csv(spark, sf):
    path = scratch_path(spark, "supplier_csv")
    S.table(spark, sf, "supplier").write.mode("overwrite").option("header", True).csv(path)
    return A.read_csv(spark, path, schema="s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE")


@register
def q_pick_sheet(spark, sf):
    o = S.table(spark, sf, "orders").select(F.year("o_orderdate").cast("string").alias("sheet"), "o_orderkey",
                                            "o_totalprice")
    return A.pick_sheet(o, "1997")


@register
def q_multi_file_read(spark, sf):
    path = scratch_path(spark, "orders_by_year")
    (S.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("o_year"))
     .write.mode("overwrite").partitionBy("o_year").parquet(path))
    df = A.read_many(spark, path, "parquet", key_pattern=r"o_year=(\d+)")
    return df.select("source_key", "o_orderkey", "o_totalprice")


def render_nation_sheets(spark, sf) -> str:
    n = S.table(spark, sf, "nation")
    data = n.select(F.col("n_regionkey").alias("reg"), F.lit(2).alias("section"), F.col("n_nationkey").alias("k"),
                    F.concat_ws(",", "n_nationkey", "n_name", "n_regionkey").alias("value"))
    regs = n.select(F.col("n_regionkey").alias("reg")).distinct()
    meta = _meta(regs, "reg", [(0, 0, "Population estimates"), (0, 1, "Scotland, mid-year"), (0, 2, ""),
                               (1, 0, "Nation Key,Nation Name,Region Key")])
    return _write_text_files(data.unionByName(meta), "reg", scratch_path(spark, "nation_sheets"))


@register
def q_promote_header(spark, sf):
    raw = A.read_raw_rows(spark, render_nation_sheets(spark, sf), n_cols=3)
    out = A.promote_header(raw, "Nation Name")
    return out.select(F.col("Nation Key").cast("bigint").alias("Nation Key"), "Nation Name",
                      F.col("Region Key").cast("bigint").alias("Region Key"))


@register
def q_replace_table(spark, sf):
    path = K.replace_table(S.panel(spark, sf), scratch_path(spark, "panel_table"))
    return K.read_table(spark, path).select("area_code", "date", "count", "value")


@register
def q_gated_replace(spark, sf):
    path = K.gated_replace(S.supply_panel(spark, sf), scratch_path(spark, "supply_table"),
                           ["area_code", "date", "qty"])
    return K.read_table(spark, path).select("area_code", "date", "qty", "gross")


PANEL_SCHEMA = T.StructType([T.StructField("area_code", T.StringType(), False), T.StructField("date", T.DateType(), False),
                             T.StructField("value_trend", T.DoubleType(), False)])


@register
def q_checked_publish(spark, sf):
    """K3 with Q1-Q4: the monthly census-style panel written, checked and published by one job; rows as published."""
    path = scratch_path(spark, "trend_table")
    K.publish(trend_panel(spark, sf).select("area_code", "date", "value_trend"), path, Gate(PANEL_SCHEMA, "area_code"))
    return K.read_table(spark, path).select("area_code", "date", "value_trend")


@register
def q_extract_lookup(spark, sf):
    sup = S.table(spark, sf, "supplier")
    verts = S.squares(sup, "s_suppkey", 1.0, "P").join(
        sup.select(F.concat(F.lit("P"), F.col("s_suppkey").cast("string")).alias("area_code"), "s_name"), "area_code")
    return extract_lookup(verts, "area_code", "s_name", name_fn=normalise_name)


# --- links ------------------------------------------------------------------------------------

@register
def q_links_by_title(spark, sf):
    return L.links_by_title(S.table(spark, sf, "pages"), "the", "https://example.org", attr="text")


@register
def q_nth_link_by_regex(spark, sf):
    return L.nth_link_by_regex(S.table(spark, sf, "pages"), r"^/[a-z]", n=1, base_col="url", on_missing="drop")


@register
def q_first_link_by_type(spark, sf):
    return L.first_link_by_type(S.table(spark, sf, "pages"), None, ["th", "qu"])


# --- served views and panel joins -------------------------------------------------------------

def crime_table(spark, sf) -> DataFrame:
    """Published crime-table stand-in; area S00000005 has no code (unmatched name, X7)."""
    return S.panel(spark, sf).select(
        "count", F.when(F.col("area_code") != "S00000005", F.col("area_code")).alias("ward_code"), "date")


@register
def q_history_crime(spark, sf):
    return V.typed_projection(V.history_crime(crime_table(spark, sf)), V.CRIME_SHAPE)


def published_crime(spark, sf) -> DataFrame:
    """The crime table written by the sink, clustered by area, and read back with its partitions."""
    path = K.cluster_table(crime_table(spark, sf), scratch_path(spark, "crime_table"), "ward_code")
    return K.read_table(spark, path, keep_year=True)


@register
def q_history_crime_month(spark, sf):
    """V1 with a date bound: all areas of one month from the published table (one year's files are read)."""
    return V.typed_projection(V.history_crime(published_crime(spark, sf), None, "1997-05-01"), V.CRIME_SHAPE)


@register
def q_history_crime_area(spark, sf):
    """V1 with code and date bound."""
    return V.typed_projection(V.history_crime(published_crime(spark, sf), "S00000003", "1997-05-01"), V.CRIME_SHAPE)


@register
def q_history_optional_area(spark, sf):
    """V2 with a code bound, from the published table."""
    return V.history_optional(published_crime(spark, sf), "S00000003")


@register
def q_area_series_one(spark, sf):
    """V6 for one area, from the published table; the position shows the order."""
    out = V.area_series(published_crime(spark, sf), "S00000003")
    before = F.count(F.lit(1)).over(Window.partitionBy("ward_code").orderBy("date"))
    return out.withColumn("position", before)


@register
def q_vertex_table(spark, sf):
    """K2: the boundary vertices of the source layer written as a table (no date) and read back."""
    return K.read_table(spark, K.replace_table(S.supplier_squares(spark, sf), scratch_path(spark, "vertices")))


@register
def q_history_optional(spark, sf):
    return V.history_optional(crime_table(spark, sf))


@register
def q_area_names(spark, sf):
    n = S.names(spark, sf).select(F.col("area_code").alias("ward_code"), F.col("area_name").alias("ward_name"))
    return V.area_names(n)


@register
def q_area_series(spark, sf):
    return V.area_series(crime_table(spark, sf))


@register
def q_map_slice(spark, sf):
    out = V.map_slice(S.panel(spark, sf), S.names(spark, sf), "1998-01-01")
    return out.withColumn("log_count", _r(F.col("log_count")))


@register
def q_param_sql(spark, sf):
    return param_sql(spark, "SELECT area_code, date, count FROM {t} WHERE date >= :start AND count > :min_count",
                     {"start": dt.date(1999, 1, 1), "min_count": 5}, {"t": S.panel(spark, sf)})


@register
def q_join_panel(spark, sf):
    return R.join_panels([S.panel(spark, sf), S.supply_panel(spark, sf)], names=S.names(spark, sf))


@register
def q_join_bucketed(spark, sf):
    """The panels published in buckets of their areas, then joined without an exchange."""
    token = uuid.uuid4().hex[:8]
    panels = [K.bucket_panel(df, f"areapanel_{name}_{token}", scratch_path(spark, f"bucketed-{name}"))
              for name, df in (("orders", S.panel(spark, sf)), ("supply", S.supply_panel(spark, sf)), ("trend", trend_panel(spark, sf)))]
    return R.join_bucketed(panels, names=S.names(spark, sf))


def trend_panel(spark, sf, panel_df: DataFrame | None = None) -> DataFrame:
    """Census-style panel: value at each area's first and last month, densified."""
    panel_df = S.panel(spark, sf) if panel_df is None else panel_df
    out = TS.densify_linear(S.anchors(panel_df, "value"), "area_code", "date", "value")
    return out.select("area_code", "date", _r(F.col("value")).alias("value_trend"))


@register
def q_area_history(spark, sf):
    return R.join_panels([S.panel(spark, sf), S.supply_panel(spark, sf), trend_panel(spark, sf)],
                         names=S.names(spark, sf))
