"""Registered spatial queries: areas, overlaps, crosswalk, boundary files,
projection and simplification on polygons derived from the test tables."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions.text import normalise_name
from ..operators import clip as CL
from ..operators import spatial as G
from ..operators import topology as TP
from ..session import reliable_checkpoint
from ..sinks.tables import boundary_features
from . import standins as S
from .catalog import _r, register


@register
def q_polygon_area(spark, sf):
    out = G.polygon_area(S.parcels(spark, sf))
    return out.select("area_code", _r(F.col("area")).alias("area"))


@register
def q_overlap_area(spark, sf):
    out = G.overlap_area(S.supplier_squares(spark, sf), S.nation_cover(spark, sf))
    return out.select("source_code", "target_code", _r(F.col("overlap_area")).alias("overlap_area"))


@register
def q_overlap_weight(spark, sf):
    out = G.overlap_weights(S.supplier_squares(spark, sf), S.nation_cover(spark, sf))
    return out.select("source_code", "target_code", _r(F.col("weight")).alias("weight"))


@register
def q_crosswalk_reweight(spark, sf):
    cw = G.overlap_weights(S.supplier_squares(spark, sf), S.nation_cover(spark, sf))
    values = S.table(spark, sf, "supplier").select(
        F.concat(F.lit("P"), F.col("s_suppkey").cast("string")).alias("source_code"),
        F.col("s_acctbal").alias("acctbal"), F.lit(1.0).alias("suppliers"))
    out = G.crosswalk_reweight(values, cw, ["acctbal", "suppliers"])
    return out.select("target_code", _r(F.col("acctbal"), 4).alias("acctbal"),
                      _r(F.col("suppliers"), 6).alias("suppliers"))


def boundary_file(spark, sf):
    """Boundary features as GeoJSON text, one feature per row (both layers in one file)."""
    names = S.names(spark, sf).select("area_code", F.col("area_name").alias("name"))
    sup_names = S.table(spark, sf, "supplier").select(
        F.concat(F.lit("P"), F.col("s_suppkey").cast("string")).alias("area_code"), F.col("s_name").alias("name"))
    verts = S.nation_squares(spark, sf).unionByName(S.supplier_squares(spark, sf))
    return boundary_features(verts, "area_code", names.unionByName(sup_names))


@register
def q_prepare_boundaries(spark, sf):
    _, lookup = G.prepare_boundaries(boundary_file(spark, sf), "area_code", "name", 2022, prefix="S",
                                     name_fn=normalise_name)
    return lookup.select("ward_code_2022", "ward_name_2022", _r(F.col("area_2022")).alias("area_2022"))


@register
def q_boundary_features(spark, sf):
    """All positions of all features, in order."""
    f = boundary_features(S.supplier_squares(spark, sf))
    parts = F.from_json(F.get_json_object("feature", "$.geometry.coordinates"), "array<array<array<array<double>>>>")
    rows = f.select("area_code", F.get_json_object("feature", "$.type").alias("feature_type"),
                    F.get_json_object("feature", "$.geometry.type").alias("geometry_type"), F.posexplode(F.flatten(F.flatten(parts))))
    return rows.select("area_code", "feature_type", "geometry_type", F.col("pos").cast("bigint").alias("position"),
                       F.col("col")[0].alias("x"), F.col("col")[1].alias("y"))


def grid_layer(spark, sf):
    """Nation squares placed on the British National Grid (10 km units, over Scotland)."""
    v = S.nation_squares(spark, sf)
    return v.withColumns({"x": F.col("x") * 10000 + 250000, "y": F.col("y") * 10000 + 650000})


@register
def q_project_vertices(spark, sf):
    """Supplier squares (10 m) at one place of the grid to longitude and latitude, and back to the grid."""
    v = S.supplier_squares(spark, sf).withColumns({"x": F.col("x") * 10 + 250000, "y": F.col("y") * 10 + 650000})
    there = G.project_vertices(v, "EPSG:4326")
    back = G.project_vertices(there, "EPSG:27700").select("area_code", "seq", _r(F.col("x"), 2).alias("x"), _r(F.col("y"), 2).alias("y"))
    placed = there.select("area_code", "seq", (F.col("x").between(-5, -3.5) & F.col("y").between(55.5, 56.5)).alias("in_scotland"))
    return back.join(placed, ["area_code", "seq"])


def jagged_rings(spark, sf):
    """A 64-vertex star-like ring per part (radius modulated by part attributes)."""
    p = S.dealt(S.table(spark, sf, "part").select("p_partkey", "p_size"), "p_partkey")
    i = F.col("i")
    ang = i * (2 * math.pi / 64)
    r = 1 + 0.05 * F.sin(i * F.col("p_size")) + 0.3 * F.when(i % 16 == 0, 1).otherwise(0)
    return (p.select("p_partkey", "p_size", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("i"))
            .select(F.concat(F.lit("Q"), F.col("p_partkey").cast("string")).alias("area_code"),
                    F.lit(0).alias("part"), F.lit(0).alias("ring"), i.alias("seq"),
                    ((F.col("p_partkey") % 50) * 3 + r * F.cos(ang)).alias("x"),
                    (F.floor(F.col("p_partkey") / 50) * 3 + r * F.sin(ang)).alias("y")))


@register
def q_simplify_rings(spark, sf):
    return G.simplify_rings(jagged_rings(spark, sf), 0.1)


@register
def q_simplify_topology(spark, sf):
    out = TP.simplify_topology(S.jagged_parcels(spark, sf), 0.05)
    return out.select("area_code", F.col("seq").cast("bigint").alias("seq"), _r(F.col("x")).alias("x"),
                      _r(F.col("y")).alias("y"))


@register
def q_topology_faults(spark, sf):
    """Different border segments of the simplified layer, and pairs of them that meet elsewhere than in a common end."""
    v = reliable_checkpoint(TP.simplify_topology(S.jagged_parcels(spark, sf), 0.05))
    p, q = F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y"))
    segments = G.edges(v).select(F.least(p, q).alias("p"), F.greatest(p, q).alias("q")).groupBy("p", "q").count()
    return segments.agg(F.count("*").alias("segments"), F.count(F.when(F.col("count") == 2, 1)).alias("shared"), F.lit(
        TP.topology_faults(v).count()).cast("bigint").alias("faults"))


@register
def q_clip_overlaps(spark, sf):
    """Corners of the outline of every overlap, and the outline's number of rings and area."""
    v = reliable_checkpoint(CL.clip_overlaps(S.supplier_squares(spark, sf), S.nation_cover(spark, sf)))
    pair = F.concat_ws("|", "source_code", "target_code")
    area = G.polygon_area(v.select(pair.alias("pair"), "part", "ring", "seq", "x", "y"), "pair")
    rings = v.groupBy(pair.alias("pair")).agg(F.count_distinct("part", "ring").alias("rings"))
    return v.withColumn("pair", pair).join(area, "pair").join(rings, "pair").select(
        "source_code", "target_code", _r(F.col("x")).alias("x"), _r(F.col("y")).alias("y"), "rings", _r(F.col("area")).alias("area"))
