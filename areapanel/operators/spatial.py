"""Boundary geometry on Spark.

Geometry is a vertex table ``(area_code, part, ring, seq, x, y)``: ``part`` is
the polygon of a multipolygon, ``ring`` 0 is its outer ring and rings >= 1 are
holes, ``seq`` orders the vertices. No geometry library is used.

Overlap (I4) without a spatial index or theta join
-------------------------------------------------
Both layers are cut by square grids and compared cell by cell, one polygon part at a time.

1. Candidate pairs: a box lives on the grid level (cell size a power of two) that its own size asks for, so it touches at
   most four cells, and is repeated on the coarser levels the other layer uses. A pair meets once, on the level of its
   larger box, in the cell that holds the lower-left corner of the box intersection (no ``distinct``).
2. A pair is compared on cells of about the size of its smaller box, finer where both outlines are dense, and only on
   cells of its box intersection.
3. Each polygon is cut once per level. Inside a cell its indicator function is a signed sum of areas under line pieces:
   its clipped edges, a piece along the cell's top from each place where the outline crosses the top, and one along the
   whole top when the upper left corner is inside. The corner is found by a running sum down the grid line. Edges meet
   pairs by (polygon, level, cell), never by polygon alone.
4. ``area(A and B in the cell) = sum of s_a * s_b * integral of min(f_a, f_b)`` over pieces that share x-range. The integral
   of the lower of two lines is closed form; it is summed per cell, then per pair.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import drop_scratch, write_scratch
from .checks import require_columns

VERTEX_COLS = ["area_code", "part", "ring", "seq", "x", "y"]


# --- edges, areas, winding --------------------------------------------------------------------

EDGE_CHUNK = 50_000  # consecutive vertex positions handled by one window partition


def edges(vertices: DataFrame, key: str = "area_code", chunk_size: int = EDGE_CHUNK) -> DataFrame:
    """Directed ring edges ``(key, part, ring, x1, y1, x2, y2)``; rings are closed
    implicitly (last → first) and zero-length edges are dropped.

    Rings are cut into chunks of ``chunk_size`` consecutive positions: ``lead`` runs
    within a chunk, and a chunk's last vertex is joined to the first vertex of the
    next chunk (or of the ring). A window partition therefore never holds more than
    one chunk, however long a ring is; positions may have gaps.
    """
    require_columns(vertices, [key, "part", "ring", "seq", "x", "y"])
    rk = [key, "part", "ring"]
    v = vertices.select(*rk, "seq", "x", "y").withColumn("chunk", F.floor(F.col("seq") / chunk_size))
    firsts = v.groupBy(*rk, "chunk").agg(F.min_by(F.struct("x", "y"), "seq").alias("p"))
    wr = Window.partitionBy(*rk).orderBy("chunk")
    wall = wr.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    nxt = firsts.select(*rk, "chunk", F.coalesce(F.lead("p").over(wr), F.first("p").over(wall)).alias("np"))
    wc = Window.partitionBy(*rk, "chunk").orderBy("seq")
    e = v.select(*rk, "chunk", F.col("x").alias("x1"), F.col("y").alias("y1"),
                 F.lead("x").over(wc).alias("_x2"), F.lead("y").over(wc).alias("_y2"))
    e = e.join(nxt, [*rk, "chunk"]).select(
        *rk, "x1", "y1", F.coalesce("_x2", F.col("np.x")).alias("x2"), F.coalesce("_y2", F.col("np.y")).alias("y2"))
    return e.where((F.col("x1") != F.col("x2")) | (F.col("y1") != F.col("y2")))


def ring_signed_areas(edge_df: DataFrame, key: str = "area_code") -> DataFrame:
    """Shoelace per ring: positive for counter-clockwise rings."""
    return (edge_df.groupBy(key, "part", "ring")
            .agg((F.sum(F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")) / 2.0).alias("signed_area")))


def _areas(sa: DataFrame, key: str = "area_code") -> DataFrame:
    signed = F.when(F.col("ring") == 0, F.abs("signed_area")).otherwise(-F.abs("signed_area"))
    return sa.groupBy(key).agg(F.sum(signed).alias("area"))


def oriented_edges(vertices: DataFrame, key: str = "area_code") -> DataFrame:
    """Edges with outer rings counter-clockwise and holes clockwise (flipped where needed)."""
    e = edges(vertices, key)
    return _orient(e, ring_signed_areas(e, key), key)


def _orient(e: DataFrame, sa: DataFrame, key: str) -> DataFrame:
    want_ccw = F.col("ring") == 0
    flip = (want_ccw & (F.col("signed_area") < 0)) | (~want_ccw & (F.col("signed_area") > 0))
    j = e.join(sa.select(key, "part", "ring", flip.alias("_flip")), [key, "part", "ring"])
    sw = F.col("_flip")
    return j.select(key, "part", "ring",
                    F.when(sw, F.col("x2")).otherwise(F.col("x1")).alias("x1"),
                    F.when(sw, F.col("y2")).otherwise(F.col("y1")).alias("y1"),
                    F.when(sw, F.col("x1")).otherwise(F.col("x2")).alias("x2"),
                    F.when(sw, F.col("y1")).otherwise(F.col("y2")).alias("y2"))


def polygon_area(vertices: DataFrame, key: str = "area_code", out_col: str = "area") -> DataFrame:
    """Area per key = Σ |outer rings| − Σ |holes| (shoelace; projected units²)."""
    return _areas(ring_signed_areas(edges(vertices, key), key), key).withColumnRenamed("area", out_col)


def bounds(vertices: DataFrame, key: str = "area_code") -> DataFrame:
    """Box, size (longer side) and vertex count of every polygon part with an extent, as ``poly = (key, part)``."""
    b = (vertices.groupBy(F.struct(F.col(key).alias("area_code"), F.col("part")).alias("poly"))
         .agg(F.min("x").alias("xmin"), F.min("y").alias("ymin"), F.max("x").alias("xmax"), F.max("y").alias("ymax"),
              F.count(F.lit(1)).alias("n_vertices")))
    return (b.where((F.col("xmin") < F.col("xmax")) & (F.col("ymin") < F.col("ymax")))
            .withColumn("size", F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin"))))


# --- overlap ----------------------------------------------------------------------------------

CELL_EDGES = 8  # edges of the sparser outline per cell that the cell size of a pair aims at
LEVEL_SPAN = 14  # a pair's cells are at most 2**14 times smaller than its larger box


def _level(size: Column) -> Column:
    """Exponent of the smallest power of two that is not below ``size``."""
    return F.ceil(F.log2(size)).cast("int")


def _cell_size(level: str = "level") -> Column:
    return F.pow(F.lit(2.0), F.col(level))


def _index(x: Column, cell: Column) -> Column:
    return F.floor(x / cell)


def _whole(start: Column, end: Column) -> Column:
    """``start .. end`` as an array, NULL (no rows when exploded) if empty."""
    return F.when(start <= end, F.sequence(start, F.greatest(start, end)))


def _on_levels(b: DataFrame, other: DataFrame, own_kinds: list[int], lifted_kind: int) -> DataFrame:
    """Boxes in the cells they touch, on their own level and on the coarser ones of ``other``. ``kind`` tells whose own
    level a meeting is on, so boxes that are both lifted never meet. Levels are at most the exponents of a double."""
    used = other.agg(F.collect_set("own").alias("ls")).scalar()
    lifted = F.transform(F.filter("used", lambda l: l > F.col("own")),
                         lambda l: F.struct(l.alias("level"), F.lit(lifted_kind).alias("kind")))
    own = F.array(*[F.struct(F.col("own").alias("level"), F.lit(k).alias("kind")) for k in own_kinds])
    at = b.withColumn("used", used).withColumn("at", F.explode(F.concat(own, lifted)))
    at = at.select("*", "at.level", "at.kind").drop("at", "used")
    c = _cell_size()
    return (at.withColumn("cx", F.explode(F.sequence(_index(F.col("xmin"), c), _index(F.col("xmax"), c))))
            .withColumn("cy", F.explode(F.sequence(_index(F.col("ymin"), c), _index(F.col("ymax"), c)))))


def candidate_pairs(src_bounds: DataFrame, dst_bounds: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` of polygon parts whose boxes overlap, each once, with the box intersection
    ``(ix0, iy0, ix1, iy1)`` and the ``level`` of the cells they are compared on."""
    box = ["xmin", "ymin", "xmax", "ymax", "n_vertices", "size"]
    sb = src_bounds.withColumn("own", _level(F.col("size")))
    db = dst_bounds.withColumn("own", _level(F.col("size")))
    at = ["kind", "level", "cx", "cy"]
    a = _on_levels(sb, db, [0], 1).select(*at, F.col("poly").alias("a"), *[F.col(c).alias("a_" + c) for c in box])
    b = _on_levels(db, sb, [0, 1], 0).select(*at, F.col("poly").alias("b"), *[F.col(c).alias("b_" + c) for c in box])
    ix0, iy0 = F.greatest("a_xmin", "b_xmin"), F.greatest("a_ymin", "b_ymin")
    ix1, iy1 = F.least("a_xmax", "b_xmax"), F.least("a_ymax", "b_ymax")
    c = _cell_size()
    home = (_index(ix0, c) == F.col("cx")) & (_index(iy0, c) == F.col("cy"))
    j = a.join(b, at).where((ix0 < ix1) & (iy0 < iy1) & home)
    small, big = F.least("a_size", "b_size"), F.greatest("a_size", "b_size")
    near = F.least(*[F.col(s + "_n_vertices") * small / F.col(s + "_size") for s in "ab"])
    finer = F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(near / CELL_EDGES, F.lit(1.0))) / 2).cast("int"))
    return j.select("a", "b", ix0.alias("ix0"), iy0.alias("iy0"), ix1.alias("ix1"), iy1.alias("iy1"),
                    F.greatest(_level(small) - finer, _level(big) - LEVEL_SPAN).alias("level"))


def pair_cells(pairs: DataFrame) -> DataFrame:
    """The cells ``(a, b, level, cx, cy)`` of each pair's box intersection."""
    pairs = pairs.withColumn("c", _cell_size())
    c = F.col("c")

    def span(lo: str, hi: str) -> Column:
        first = _index(F.col(lo), c)
        return F.sequence(first, F.greatest(first, F.ceil(F.col(hi) / c) - 1))

    return pairs.withColumn("cx", F.explode(span("ix0", "ix1"))).withColumn("cy", F.explode(span("iy0", "iy1"))).select(
        "a", "b", "level", "cx", "cy")


def _pieces(e: DataFrame, cells: DataFrame) -> DataFrame:
    """Signed line pieces ``(poly, level, cx, cy, xl, xr, hl, hr, s)`` of every polygon of ``e`` (oriented edges) in the
    cells ``(poly, level, cx, cy)``, heights counted from the cell's bottom; other cells may come along."""
    at = ["poly", "level", "cx", "cy"]
    le = (e.select(F.struct("area_code", "part").alias("poly"), "x1", "y1", "x2", "y2")
          .join(cells.select("poly", "level").distinct(), "poly").withColumn("c", _cell_size()))
    c = F.col("c")
    x1, y1, x2, y2 = (F.col(n) for n in ("x1", "y1", "x2", "y2"))
    right_to_left = x1 > x2
    side = F.when(right_to_left, 1.0).otherwise(-1.0)

    # Clipped edges: first to grid columns, then to grid rows.
    lx, rx = F.least(x1, x2), F.greatest(x1, x2)
    ly, ry = F.when(right_to_left, y2).otherwise(y1), F.when(right_to_left, y1).otherwise(y2)
    cols = le.select("poly", "level", "c", side.alias("s"), lx.alias("lx"), ly.alias("ly"), rx.alias("rx"),
                     ry.alias("ry"), F.explode(_whole(_index(lx, c), _index(rx, c))).alias("cx"))
    cols = cols.withColumns({"xa": F.greatest(F.col("lx"), F.col("cx") * c),
                             "xb": F.least(F.col("rx"), (F.col("cx") + 1) * c)}).where(F.col("xa") < F.col("xb"))

    def y_at(x: str, end: str, y_end: str) -> Column:
        t = (F.col(x) - F.col("lx")) / (F.col("rx") - F.col("lx"))
        return F.when(F.col(x) == F.col(end), F.col(y_end)).otherwise(F.col("ly") + (F.col("ry") - F.col("ly")) * t)

    cols = cols.withColumns({"ya": y_at("xa", "lx", "ly"), "yb": y_at("xb", "rx", "ry")})
    rows = cols.withColumn("cy", F.explode(_whole(_index(F.least("ya", "yb"), c), _index(F.greatest("ya", "yb"), c))))
    rise = F.col("yb") - F.col("ya")

    def x_at(y: Column) -> Column:
        return F.col("xa") + (y - F.col("ya")) / F.nullif(rise, F.lit(0.0)) * (F.col("xb") - F.col("xa"))

    bottom, top = x_at(F.col("cy") * c), x_at((F.col("cy") + 1) * c)
    rows = rows.withColumns({  # greatest and least pass over the NULL of a flat edge
        "xl": F.greatest(F.col("xa"), F.when(rise > 0, bottom).otherwise(top)),
        "xr": F.least(F.col("xb"), F.when(rise > 0, top).otherwise(bottom))}).where(F.col("xl") < F.col("xr"))

    def height(x: str) -> Column:
        y = F.col("ya") + rise * ((F.col(x) - F.col("xa")) / (F.col("xb") - F.col("xa")))
        return F.greatest(F.lit(0.0), F.least(c, y - F.col("cy") * c))

    clipped = rows.select(*at, "xl", "xr", height("xl").alias("hl"), height("xr").alias("hr"), "s")

    # Crossings of row lines: to the right of one, the outline's share of the line above changes by one.
    def cross_x(y: Column) -> Column:
        x = x1 + (x2 - x1) * ((y - y1) / F.nullif(y2 - y1, F.lit(0.0)))
        return F.greatest(lx, F.least(rx, x))

    ylo, yhi = F.least(y1, y2), F.greatest(y1, y2)
    tops = le.withColumn("q", F.explode(_whole(_index(ylo, c) + 1, _index(yhi, c))))
    tops = tops.withColumn("xl", cross_x(F.col("q") * c)).withColumn("cx", _index(F.col("xl"), c))
    tops = tops.select("poly", "level", "cx", (F.col("q") - 1).alias("cy"), "xl", ((F.col("cx") + 1) * c).alias("xr"),
                       c.alias("hl"), c.alias("hr"), F.when(y2 > y1, -1.0).otherwise(1.0).alias("s"))

    # Crossings of column lines: the highest row line below each counts towards all corners from there down. Whether an
    # edge is above a corner is told by the column in which it crosses the row line, so both kinds always agree.
    sides = le.withColumn("cx", F.explode(_whole(_index(lx, c) + 1, _index(rx, c))))
    q0 = _index(y1 + (y2 - y1) * ((F.col("cx") * c - x1) / F.nullif(x2 - x1, F.lit(0.0))), c)

    def above(q: Column) -> Column:
        y = q * c
        before = _index(cross_x(y), c) < F.col("cx")
        return F.when((y1 < y) == (y2 < y), y1 >= y).otherwise(F.when((y2 > y1) == (x2 > x1), before).otherwise(~before))

    sides = sides.withColumn("q0", q0)
    q = F.when(above(F.col("q0") + 1), F.col("q0") + 1).when(above(F.col("q0")), F.col("q0")).otherwise(F.col("q0") - 1)
    events = (sides.select("poly", "level", "cx", q.alias("q"), side.alias("s")).groupBy("poly", "level", "cx", "q")
              .agg(F.sum("s").alias("s")).select("*", F.lit(0).alias("asks")))
    asks = cells.select("poly", "level", "cx", (F.col("cy") + 1).alias("q"), F.lit(0.0).alias("s"), F.lit(1).alias("asks"))
    down = (Window.partitionBy("poly", "level", "cx").orderBy(F.desc("q"), "asks")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    corners = (events.unionByName(asks).withColumn("s", F.sum("s").over(down))
               .where((F.col("asks") == 1) & (F.col("s") != 0)).withColumn("c", _cell_size())
               .select("poly", "level", "cx", (F.col("q") - 1).alias("cy"), (F.col("cx") * c).alias("xl"),
                       ((F.col("cx") + 1) * c).alias("xr"), c.alias("hl"), c.alias("hr"), "s"))
    return clipped.unionByName(tops).unionByName(corners)


def overlap_area(src: DataFrame, dst: DataFrame, key: str = "area_code", rel_eps: float = 1e-9) -> DataFrame:
    """I4: intersection area of every overlapping (source, target) pair:
    ``(source_code, target_code, overlap_area, source_area)``. Pairs that only touch are dropped
    (relative to the smaller polygon), as overlays keeping polygon results do. The result does
    not depend on cell sizes.
    """
    src = src.select(F.col(key).alias("area_code"), "part", "ring", "seq", "x", "y")
    dst = dst.select(F.col(key).alias("area_code"), "part", "ring", "seq", "x", "y")
    # Cells of all pairs are written once: both layers are cut by them and then meet in them.
    cells = write_scratch(pair_cells(candidate_pairs(bounds(src), bounds(dst))), "overlap-cells")
    at = ["level", "cx", "cy"]
    # So are the turned edges, which are cut three ways and give the areas.
    e_s, e_d = (write_scratch(oriented_edges(v), "overlap-edges") for v in (src, dst))
    pa = _pieces(e_s, cells.select(F.col("a").alias("poly"), *at).distinct())
    pb = _pieces(e_d, cells.select(F.col("b").alias("poly"), *at).distinct())
    line = ["xl", "xr", "hl", "hr", "s"]
    j = (pa.withColumnRenamed("poly", "a").join(cells, ["a", *at])
         .join(pb.select(F.col("poly").alias("b"), *at, *[F.col(n).alias("b_" + n) for n in line]), ["b", *at]))
    xl = F.greatest("xl", "b_xl")
    xr = F.least("xr", "b_xr")
    j = j.where(xl < xr)

    def at_x(x: Column, l: str, r: str, hl: str, hr: str) -> Column:
        return F.col(hl) + (F.col(hr) - F.col(hl)) * ((x - F.col(l)) / (F.col(r) - F.col(l)))

    aL, aR = at_x(xl, "xl", "xr", "hl", "hr"), at_x(xr, "xl", "xr", "hl", "hr")
    bL, bR = at_x(xl, "b_xl", "b_xr", "b_hl", "b_hr"), at_x(xr, "b_xl", "b_xr", "b_hl", "b_hr")
    t = j.select("a", "b", *at, (xr - xl).alias("w"), aL.alias("aL"), aR.alias("aR"), bL.alias("bL"),
                 bR.alias("bR"), (F.col("s") * F.col("b_s")).alias("ss"))
    dL = F.col("aL") - F.col("bL")
    dR = F.col("aR") - F.col("bR")
    no_cross = F.col("w") * F.least(F.col("aL") + F.col("aR"), F.col("bL") + F.col("bR")) / 2.0
    tt = dL / F.when(dL * dR < 0, dL - dR)  # only used where the lines cross
    m = F.col("aL") + (F.col("aR") - F.col("aL")) * tt
    cross = F.col("w") * (tt * (F.least("aL", "bL") + m) / 2.0 + (1 - tt) * (m + F.least("aR", "bR")) / 2.0)
    integral = F.when(dL * dR >= 0, no_cross).otherwise(cross)
    inter = t.groupBy(F.col("a.area_code").alias("src"), F.col("b.area_code").alias("dst")) \
        .agg(F.sum(F.col("ss") * integral).alias("overlap_area"))
    turned_area = F.sum(F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")) / 2.0  # holes count as negative
    sizes = e_s.groupBy(F.col("area_code").alias("src")).agg(turned_area.alias("_sa"))
    dsizes = e_d.groupBy(F.col("area_code").alias("dst")).agg(turned_area.alias("_da"))
    out = inter.join(sizes, "src").join(dsizes, "dst")
    keep = F.col("overlap_area") > F.lit(rel_eps) * F.least("_sa", "_da")
    return out.where(keep).select(F.col("src").alias("source_code"), F.col("dst").alias("target_code"),
                                  "overlap_area", F.col("_sa").alias("source_area"))


def overlap_weights(src: DataFrame, dst: DataFrame, key: str = "area_code", **kw) -> DataFrame:
    """I4: ``(source_code, target_code, overlap_area, weight)`` with
    ``weight = overlap_area / area(source)`` (the crosswalk's ``overlap_pct``)."""
    ov = overlap_area(src, dst, key, **kw)
    return ov.select("source_code", "target_code", "overlap_area",
                     F.try_divide(F.col("overlap_area"), F.col("source_area")).alias("weight"))


def crosswalk_reweight(values: DataFrame, crosswalk: DataFrame, value_cols: list[str], source_col: str = "source_code",
                       target_col: str = "target_code", weight_col: str = "weight",
                       group_cols: list[str] | None = None, kind: str = "count") -> DataFrame:
    """Move values from source areas to target areas: Σ value × weight per target
    (and per ``group_cols``, e.g. the date). ``kind='count'`` uses the share of the
    source (the reference's rule); ``kind='rate'`` averages rates with the share of the
    *target* instead (X1). Source rows without overlaps drop out of the sums."""
    group_cols = list(group_cols or [])
    require_columns(values, [source_col, *value_cols, *group_cols])
    require_columns(crosswalk, [source_col, target_col, weight_col])
    j = values.join(crosswalk.select(source_col, target_col, weight_col, *(
        ["overlap_area"] if kind == "rate" else [])), source_col)
    if kind == "count":
        return (j.groupBy(target_col, *group_cols)
                .agg(*[F.coalesce(F.sum(F.col(v) * F.col(weight_col)), F.lit(0.0)).alias(v) for v in value_cols]))
    share = F.col("overlap_area")
    return (j.groupBy(target_col, *group_cols)
            .agg(*[(F.sum(F.col(v) * share) / F.sum(F.when(F.col(v).isNotNull(), share))).alias(v)
                   for v in value_cols]))


# --- GeoJSON boundaries (A8) ------------------------------------------------------------------

_MULTI = "array<array<array<array<double>>>>"
_POLY = "array<array<array<double>>>"


def geojson_vertices(features: DataFrame, feature_col: str = "feature", props: dict[str, str] | None = None
                     ) -> DataFrame:
    """One GeoJSON ``Feature`` (text) per row → vertex rows plus chosen properties.

    ``props`` maps property names to output columns. Polygon and MultiPolygon are
    read; the closing position of each ring is dropped (edges close rings).
    """
    f = F.col(feature_col)
    gtype = F.get_json_object(f, "$.geometry.type")
    coords = F.get_json_object(f, "$.geometry.coordinates")
    multi = F.when(gtype == "Polygon", F.array(F.from_json(coords, _POLY))) \
        .otherwise(F.from_json(coords, _MULTI))
    prop_cols = [F.get_json_object(f, f"$.properties.{k}").alias(v) for k, v in (props or {}).items()]
    parts = features.select(*prop_cols, F.posexplode(multi).alias("part", "_rings"))
    rings = parts.select("*", F.posexplode("_rings").alias("ring", "_pts")).drop("_rings")
    n = F.size("_pts")
    closed = F.element_at("_pts", 1) == F.element_at("_pts", -1)
    trimmed = F.when(closed & (n > 1), F.slice("_pts", 1, n - 1)).otherwise(F.col("_pts"))
    pts = rings.select("*", F.posexplode(trimmed).alias("seq", "_p")).drop("_pts")
    return pts.select(*[c for c in pts.columns if c not in ("_p",)],
                      F.col("_p")[0].alias("x"), F.col("_p")[1].alias("y")).drop("_p")


def misdecode_latin1(c: Column | str) -> Column:
    """UTF-8 bytes read as Latin-1 (how the boundary files' names reach the reference)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.decode(F.encode(c, "UTF-8"), "ISO-8859-1")


def prepare_boundaries(features: DataFrame, code_prop: str, name_prop: str, year: str | int, prefix: str = "S",
                       name_fn=None, latin1: bool = True) -> tuple[DataFrame, DataFrame]:
    """Boundary features → ``(geometry, lookup)``.

    geometry: vertex table keyed ``ward_code_{year}`` with codes starting ``prefix``;
    lookup: ``(ward_code_{year}, ward_name_{year}, area_{year})`` with names optionally
    normalised and the polygon area.
    """
    code, area = f"ward_code_{year}", f"area_{year}"
    v = geojson_vertices(features, props={code_prop: "area_code"}).where(F.col("area_code").startswith(prefix))
    geometry = v.select("area_code", "part", "ring", "seq", "x", "y")
    areas = polygon_area(geometry).select(F.col("area_code").alias(code), F.col("area").alias(area))
    names = boundary_names(features, code_prop, name_prop, year, prefix, name_fn, latin1)
    return geometry.withColumnRenamed("area_code", code), names.join(areas, code)


def boundary_names(features: DataFrame, code_prop: str, name_prop: str, year: str | int, prefix: str = "S",
                   name_fn=None, latin1: bool = True) -> DataFrame:
    """The lookup of ``prepare_boundaries`` without areas: codes and names come from the features, one row each, and no
    geometry is read."""
    code, name = f"ward_code_{year}", f"ward_name_{year}"
    names = features.select(*[F.get_json_object("feature", f"$.properties.{k}").alias(v)
                              for k, v in ((code_prop, code), (name_prop, name))])
    names = names.where(F.col(code).startswith(prefix)).dropDuplicates([code])
    if latin1:
        names = names.withColumn(name, misdecode_latin1(name))
    if name_fn is not None:
        names = names.withColumn(name, name_fn(F.col(name)))
    return names


# --- projection (I1) --------------------------------------------------------------------------
# FIXED VALUES: published constants of the British National Grid (Ordnance Survey,
# "A guide to coordinate systems in Great Britain"): Airy 1830 ellipsoid, the
# national grid's true origin and scale, the GRS80/WGS84 ellipsoid, and the
# 7-parameter Helmert transformation WGS84 → OSGB36 (tx, ty, tz in metres,
# rx, ry, rz in arc-seconds, scale in ppm). Accuracy of this route: a few metres.
AIRY_A, AIRY_B = 6377563.396, 6356256.909
GRS80_A, GRS80_B = 6378137.000, 6356752.3141
F0 = 0.9996012717
LAT0, LON0 = 49.0, -2.0
E0, N0 = 400000.0, -100000.0
HELMERT_TO_OSGB36 = (-446.448, 125.157, -542.060, -0.1502, -0.2470, -0.8421, 20.4894)


def _cartesian(lat: Column, lon: Column, a: float, b: float):
    e2 = 1 - (b * b) / (a * a)
    phi, lam = F.radians(lat), F.radians(lon)
    nu = F.lit(a) / F.sqrt(1 - e2 * F.pow(F.sin(phi), 2))
    return nu * F.cos(phi) * F.cos(lam), nu * F.cos(phi) * F.sin(lam), nu * (1 - e2) * F.sin(phi)


def _helmert(x: Column, y: Column, z: Column, params, sign: float = 1.0):
    tx, ty, tz, rx, ry, rz, s = [p * sign for p in params]
    sec = math.pi / (180 * 3600)
    rx, ry, rz, s = rx * sec, ry * sec, rz * sec, s * 1e-6
    return (F.lit(tx) + (1 + s) * x - rz * y + ry * z,
            F.lit(ty) + rz * x + (1 + s) * y - rx * z,
            F.lit(tz) - ry * x + rx * y + (1 + s) * z)


def _geodetic(df: DataFrame, x: Column, y: Column, z: Column, a: float, b: float, lon_col: str, lat_col: str,
              iterations: int = 5) -> DataFrame:
    """Cartesian → geodetic on ellipsoid (a, b); each latitude iteration is its own
    projected column so the expression tree stays linear in the iteration count."""
    e2 = 1 - (b * b) / (a * a)
    df = df.withColumns({"_gx": x, "_gy": y, "_gz": z})
    p = F.sqrt(F.col("_gx") ** 2 + F.col("_gy") ** 2)
    df = df.withColumn("_gphi", F.atan2(F.col("_gz"), p * (1 - e2)))
    for _ in range(iterations):
        nu = F.lit(a) / F.sqrt(1 - e2 * F.pow(F.sin("_gphi"), 2))
        df = df.withColumn("_gphi", F.atan2(F.col("_gz") + e2 * nu * F.sin("_gphi"), p))
    df = df.withColumns({lat_col: F.degrees("_gphi"), lon_col: F.degrees(F.atan2("_gy", "_gx"))})
    return df.drop("_gx", "_gy", "_gz", "_gphi")


def _meridional_arc(phi: Column, phi0: float, n: float) -> Column:
    b = AIRY_B
    d, s = phi - phi0, phi + phi0
    return F.lit(b * F0) * (
        (1 + n + 1.25 * n ** 2 + 1.25 * n ** 3) * d
        - (3 * n + 3 * n ** 2 + 2.625 * n ** 3) * F.sin(d) * F.cos(s)
        + (1.875 * n ** 2 + 1.875 * n ** 3) * F.sin(2 * d) * F.cos(2 * s)
        - (35 / 24) * n ** 3 * F.sin(3 * d) * F.cos(3 * s))


def wgs84_to_bng(df: DataFrame, lon: str = "x", lat: str = "y") -> DataFrame:
    """WGS84 longitude/latitude (EPSG:4326) → British National Grid easting/northing
    (EPSG:27700), by Helmert datum shift and the transverse Mercator series; the
    results replace ``lon`` / ``lat``."""
    x, y, z = _cartesian(F.col(lat), F.col(lon), GRS80_A, GRS80_B)
    x, y, z = _helmert(x, y, z, HELMERT_TO_OSGB36)
    df = _geodetic(df, x, y, z, AIRY_A, AIRY_B, "_lon", "_lat")
    east, north = osgb36_to_grid(F.col("_lon"), F.col("_lat"))
    return df.withColumns({lon: east, lat: north}).drop("_lon", "_lat")


def osgb36_to_grid(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Transverse Mercator series: OSGB36 (Airy) longitude/latitude → easting/northing."""
    la, lo = lat, lon
    a, b = AIRY_A, AIRY_B
    e2 = 1 - (b * b) / (a * a)
    n = (a - b) / (a + b)
    phi, lam = F.radians(la), F.radians(lo)
    phi0, lam0 = math.radians(LAT0), math.radians(LON0)
    sin, cos, tan = F.sin(phi), F.cos(phi), F.tan(phi)
    nu = F.lit(a * F0) / F.sqrt(1 - e2 * sin * sin)
    rho = F.lit(a * F0 * (1 - e2)) / F.pow(1 - e2 * sin * sin, 1.5)
    eta2 = nu / rho - 1
    m = _meridional_arc(phi, phi0, n)
    i = m + N0
    ii = nu / 2 * sin * cos
    iii = nu / 24 * sin * F.pow(cos, 3) * (5 - tan * tan + 9 * eta2)
    iiia = nu / 720 * sin * F.pow(cos, 5) * (61 - 58 * tan * tan + F.pow(tan, 4))
    iv = nu * cos
    v = nu / 6 * F.pow(cos, 3) * (nu / rho - tan * tan)
    vi = nu / 120 * F.pow(cos, 5) * (5 - 18 * tan * tan + F.pow(tan, 4) + 14 * eta2 - 58 * tan * tan * eta2)
    dl = lam - lam0
    north = i + ii * dl ** 2 + iii * dl ** 4 + iiia * dl ** 6
    east = F.lit(E0) + iv * dl + v * dl ** 3 + vi * dl ** 5
    return east, north


def grid_to_osgb36(df: DataFrame, east: str, north: str, lon_col: str, lat_col: str, iterations: int = 6
                   ) -> DataFrame:
    """Inverse transverse Mercator: easting/northing → OSGB36 longitude/latitude.

    The latitude solves the meridional-arc equation by a fixed number of
    iterations (well under a millimetre), each staged as its own column."""
    a, b = AIRY_A, AIRY_B
    e2 = 1 - (b * b) / (a * a)
    n = (a - b) / (a + b)
    phi0, lam0 = math.radians(LAT0), math.radians(LON0)
    e_c, n_c = F.col(east), F.col(north)
    df = df.withColumn("_phi", (n_c - N0) / (a * F0) + phi0)
    for _ in range(iterations):
        df = df.withColumn("_phi", F.col("_phi") + (n_c - N0 - _meridional_arc(F.col("_phi"), phi0, n)) / (a * F0))
    phi = F.col("_phi")
    sin, cos, tan = F.sin(phi), F.cos(phi), F.tan(phi)
    df = df.withColumns({
        "_nu": F.lit(a * F0) / F.sqrt(1 - e2 * sin * sin),
        "_rho": F.lit(a * F0 * (1 - e2)) / F.pow(1 - e2 * sin * sin, 1.5)})
    nu, rho = F.col("_nu"), F.col("_rho")
    eta2 = nu / rho - 1
    sec = 1 / cos
    vii = tan / (2 * rho * nu)
    viii = tan / (24 * rho * F.pow(nu, 3)) * (5 + 3 * tan * tan + eta2 - 9 * tan * tan * eta2)
    ix = tan / (720 * rho * F.pow(nu, 5)) * (61 + 90 * tan * tan + 45 * F.pow(tan, 4))
    x = sec / nu
    xi = sec / (6 * F.pow(nu, 3)) * (nu / rho + 2 * tan * tan)
    xii = sec / (120 * F.pow(nu, 5)) * (5 + 28 * tan * tan + 24 * F.pow(tan, 4))
    xiia = sec / (5040 * F.pow(nu, 7)) * (61 + 662 * tan * tan + 1320 * F.pow(tan, 4) + 720 * F.pow(tan, 6))
    de = e_c - E0
    lat = phi - vii * de ** 2 + viii * de ** 4 - ix * de ** 6
    lon = lam0 + x * de - xi * de ** 3 + xii * de ** 5 - xiia * de ** 7
    return df.withColumns({lon_col: F.degrees(lon), lat_col: F.degrees(lat)}).drop("_phi", "_nu", "_rho")


def bng_to_wgs84(df: DataFrame, east: str = "x", north: str = "y", iterations: int = 6) -> DataFrame:
    """British National Grid (EPSG:27700) → WGS84 longitude/latitude (EPSG:4326):
    inverse series to OSGB36, then the reverse Helmert shift; results replace
    ``east`` / ``north``."""
    df = grid_to_osgb36(df, east, north, "_lon", "_lat", iterations)
    cx, cy, cz = _cartesian(F.col("_lat"), F.col("_lon"), AIRY_A, AIRY_B)
    cx, cy, cz = _helmert(cx, cy, cz, HELMERT_TO_OSGB36, sign=-1.0)
    df = _geodetic(df.drop(east, north), cx, cy, cz, GRS80_A, GRS80_B, east, north)
    return df.drop("_lon", "_lat")


def project_vertices(vertices: DataFrame, to: str = "EPSG:4326") -> DataFrame:
    """I1 on a vertex table: ``x, y`` replaced by the coordinates in ``to``
    (``EPSG:4326`` from British National Grid, or ``EPSG:27700`` from WGS84)."""
    cols = vertices.columns
    if to == "EPSG:4326":
        out = bng_to_wgs84(vertices, "x", "y")
    elif to == "EPSG:27700":
        out = wgs84_to_bng(vertices, "x", "y")
    else:
        raise ValueError(f"unsupported target CRS {to}")
    return out.select(*cols)


# --- simplification (I6) ----------------------------------------------------------------------

#: Vertices of a ring, or between two kept ones, that a task simplifies by itself.
SHORT = 20_000
#: Rows that a task takes up at once; more only if one ring or stretch has more.
TASK_ROWS = 1 << 17


def changes(*columns: np.ndarray) -> np.ndarray:
    """Places where a run of equal rows begins."""
    return np.concatenate([[0], 1 + np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0))])


def runs(starts: np.ndarray, size: int) -> np.ndarray:
    """The number of its run for each of ``size`` rows."""
    return np.repeat(np.arange(len(starts)), np.diff(np.append(starts, size)))


def _first_maxima(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The place of the first greatest value of each run."""
    run = runs(starts, len(values))
    at = np.flatnonzero(values == np.maximum.reduceat(values, starts)[run])
    return at[changes(run[at])]


def _distances(x: np.ndarray, y: np.ndarray, null: np.ndarray, rows: np.ndarray, lo: np.ndarray, hi: np.ndarray, run: np.ndarray
               ) -> tuple[np.ndarray, np.ndarray]:
    """How far each of ``rows`` is from the chord of its ``run``, -1 if that is null, and whether a run's chord is a point."""
    with np.errstate(all="ignore"):
        cx, cy = x[hi] - x[lo], y[hi] - y[lo]
        chord, px, py = np.hypot(cx, cy), x[rows] - x[lo][run], y[rows] - y[lo][run]
        far = np.abs(cx[run] * py - cy[run] * px) / chord[run]
        at = np.flatnonzero((chord == 0)[run])
        far[at] = np.hypot(px[at], py[at])
    if null.any():
        far[null[rows] | (null[lo] | null[hi])[run]] = -1
    return far, chord == 0


def keep_farthest(x: np.ndarray, y: np.ndarray, null: np.ndarray, seq: np.ndarray, rows: np.ndarray, lo: np.ndarray,
                  hi: np.ndarray, tolerance: float, ring: np.ndarray | None = None, closed: bool = False) -> np.ndarray:
    """Douglas-Peucker on many stretches at once: those of ``rows`` that are kept.

    ``rows``, ``lo`` and ``hi`` are places in ``x``, ``y`` (``null`` where one is null) and ``seq``: vertices, and the ends of
    the stretch of each. Rows of a stretch follow one another, of equally far ones the first is kept. Whatever the tolerance,
    with ``ring`` (of each place) the first stretch of a ring is split and then the farthest vertex of the ring is kept; with
    ``closed`` any stretch is split whose ends are one point.
    """
    kept, turn = [np.zeros(0, np.int64)], 0
    while len(rows):
        starts = changes(lo)
        run = runs(starts, len(rows))
        far, point = _distances(x, y, null, rows, lo[starts], hi[starts], run)
        limit = np.array([tolerance], np.float64)
        if np.isnan(far).any():  # in Spark NaN is above all numbers, as its bits are
            far[np.isnan(far)] = np.nan
            far, limit = far.view(np.int64), limit.view(np.int64)
        at = _first_maxima(far, starts)
        splits = (far[at] > limit) & (far[at] >= 0)
        if closed:
            splits |= point
        if ring is not None and turn == 0:
            splits[:] = True
        if ring is not None and turn == 1:
            splits |= np.isin(at, _first_maxima(far, changes(ring[rows])))
        kept.append(rows[at[splits]])
        mid, stays = rows[at], splits[run]
        rows, run = rows[stays], run[stays]
        place, middle = seq[rows], seq[mid][run]
        before = place < middle
        lo, hi = np.where(before, lo[starts][run], mid[run]), np.where(before, mid[run], hi[starts][run])
        stays = place != middle
        rows, lo, hi, turn = rows[stays], lo[stays], hi[stays], turn + 1
    return np.sort(np.concatenate(kept))


def by_groups(names: list[str], work: Callable[[pa.Table, np.ndarray], pa.Table]) -> Callable:
    """A task over rows of which those with equal ``names`` (no nulls) follow one another: ``work`` gets whole groups, about
    ``TASK_ROWS`` rows of them, and where each begins."""

    def begins(rows: pa.Table) -> np.ndarray:
        n = rows.num_rows
        other = [pc.fill_null(pc.not_equal(c.slice(1), c.slice(0, n - 1)), True).to_numpy() for c in map(rows.column, names)]
        return np.concatenate([[0], 1 + np.flatnonzero(np.any(other, axis=0))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, most = [], 0, TASK_ROWS
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < most:
                continue
            rows = pa.Table.from_batches(held).combine_chunks()
            starts = begins(rows)
            last = int(starts[-1])  # the last group may go on in the next batch
            if last:
                yield from work(rows.slice(0, last), starts[:-1]).to_batches()
            held, size = rows.slice(last).to_batches(), rows.num_rows - last
            most = max(TASK_ROWS, 2 * size)
        if size:
            rows = pa.Table.from_batches(held).combine_chunks()
            yield from work(rows, begins(rows)).to_batches()

    return run


def coordinates(rows: pa.Table, *names: str) -> tuple[list[np.ndarray], np.ndarray]:
    """Columns of doubles (NaN for null), and where any is null."""
    columns = [rows.column(c) for c in names]
    null = np.any([pc.is_null(c).to_numpy() for c in columns], axis=0)
    return [pc.fill_null(c, math.nan).to_numpy() for c in columns], null


def finish_stretches(names: list[str], seq: str, out: list[str], tolerance: float, closed: bool = False) -> Callable:
    """A task that simplifies stretches: ``names`` tell them apart, their rows follow one another with ``seq``, the vertex
    x, y and the ends x0, y0, x1, y1. Gives the columns ``out`` of the kept vertices."""

    def kept(rows: pa.Table, starts: np.ndarray) -> pa.Table:
        n, k = rows.num_rows, len(starts)
        run, parts = runs(starts, n), [rows, rows.take(starts), rows.take(starts)]
        found = [coordinates(t, *c) for t, c in zip(parts, (("x", "y"), ("x0", "y0"), ("x1", "y1")), strict=True)]
        (x, y), null = (np.concatenate(c) for c in zip(*(f[0] for f in found), strict=True)), np.concatenate([f[1] for f in found])
        at = keep_farthest(x, y, null, rows.column(seq).to_numpy(), np.arange(n), n + run, n + k + run, tolerance, closed=closed)
        return rows.take(at).select(out)

    return by_groups(names, kept)


def _whole_rings(rk: list[str], tolerance: float) -> Callable:
    """A task that simplifies whole rings, whose rows follow one another by seq, x and y descending."""

    def kept(rows: pa.Table, starts: np.ndarray) -> pa.Table:
        (x, y), null = coordinates(rows, "x", "y")
        ring = runs(starts, rows.num_rows)
        # Null positions come first; a ring that has one keeps only its first vertex.
        unplaced = pc.is_null(rows.column("seq")).to_numpy()
        seq = np.where(unplaced, -(1 << 40), pc.fill_null(rows.column("seq"), 0).to_numpy())
        outer = seq == seq[starts][ring]
        first = starts + np.add.reduceat(outer.astype(np.int64), starts) - 1
        inner = np.flatnonzero(~outer & ~unplaced[starts][ring])
        at = keep_farthest(x, y, null, seq, inner, first[ring[inner]], first[ring[inner]], tolerance, ring)
        return rows.take(np.concatenate([first, at]))

    return by_groups(rk, kept)


def simplify_rings(vertices: DataFrame, tolerance: float, key: str = "area_code") -> DataFrame:
    """Douglas-Peucker on every ring.

    A ring is first split at its first vertex and the vertex farthest from it. In every open segment the vertex farthest
    from its chord (of equals the first) is kept and splits it if it is farther than ``tolerance``, else the segment's
    vertices go. The ring's farthest one is kept in the first round whatever its distance, so a ring of three or more
    vertices keeps three. Rings of up to ``SHORT`` vertices are brought together, a task simplifies many of them at once.
    Longer ones are spread over tasks and split by rounds of grouped maxima, written to the shared folder, until no segment
    is longer. ``seq`` keeps the input positions. Shared borders of neighbouring areas are simplified independently
    (topology is not preserved).
    """
    require_columns(vertices, [key, "part", "ring", "seq", "x", "y"])
    rk = [key, "part", "ring"]
    v = vertices.select(F.col(key), *[F.col(n).cast("int").alias(n) for n in ("part", "ring", "seq")],
                        *[F.col(n).cast("double").alias(n) for n in ("x", "y")])
    known = reduce(Column.__and__, [F.col(n).isNotNull() for n in rk])
    long = write_scratch(v.where(known).groupBy(*rk).count().where(F.col("count") > SHORT).drop("count"), "long-rings")
    # One vertex of rings with a null name; of long rings there is at most one for SHORT vertices.
    nameless = v.where(~known).groupBy(*rk).agg(F.min(F.struct("seq", "x", "y")).alias("p")).select(*rk, "p.*")
    short = v.where(known)
    if long.isEmpty():
        kept = [nameless]
    else:
        short = short.join(F.broadcast(long), rk, "left_anti")
        kept = [nameless, *_long_rings(v.join(F.broadcast(long), rk), tolerance, rk)]
    ordered = short.repartition(*rk).sortWithinPartitions(*rk, "seq", F.desc("x"), F.desc("y"))
    return reduce(DataFrame.unionByName, [ordered.mapInArrow(_whole_rings(rk, tolerance), v.schema), *kept])


def _long_rings(v: DataFrame, tolerance: float, rk: list[str]) -> list[DataFrame]:
    """The kept vertices of rings that are spread over tasks."""
    firsts = v.groupBy(*rk).agg(F.min(F.struct("seq", "x", "y")).alias("p"))
    from_first = v.join(firsts, rk).where(F.col("seq") != F.col("p.seq"))
    far = F.hypot(F.col("x") - F.col("p.x"), F.col("y") - F.col("p.y"))
    best = F.max(F.struct(far.alias("d"), (-F.col("seq")).alias("back"), "x", "y"))
    seconds = from_first.groupBy(*rk).agg(best.alias("m"))
    kept = [firsts.select(*rk, "p.*"), seconds.select(*rk, (-F.col("m.back")).alias("seq"), "m.x", "m.y")]

    def split(points: DataFrame, but: Column | None = None) -> DataFrame:
        """Give each point but the splitting one ``m`` its new segment: start ``lo`` and end ``hi``. Where ``but`` holds it
        keeps its own."""
        m_seq = -F.col("m.back")
        mid = F.struct(m_seq.alias("seq"), F.col("m.x").alias("x"), F.col("m.y").alias("y"))
        but = F.lit(False) if but is None else but
        first_half = F.col("seq") < m_seq
        return points.where(but | (F.col("seq") != m_seq)).select(
            *rk, "seq", "x", "y", F.when(but | first_half, F.col("lo")).otherwise(mid).alias("lo"),
            F.when(but | ~first_half, F.col("hi")).otherwise(mid).alias("hi"))

    start = from_first.join(seconds, rk).withColumns({"lo": F.col("p"), "hi": F.col("p")})
    left = write_scratch(split(start), "ring-round")
    cx, cy = F.col("hi.x") - F.col("lo.x"), F.col("hi.y") - F.col("lo.y")
    px, py = F.col("x") - F.col("lo.x"), F.col("y") - F.col("lo.y")
    chord = F.hypot(cx, cy)
    distance = F.when(chord == 0, F.hypot(px, py)).otherwise(F.abs(cx * py - cy * px) / chord)
    first_round = True
    while True:
        best = F.max(F.struct(distance.alias("d"), (-F.col("seq")).alias("back"), "x", "y")).alias("m")
        segments = left.groupBy(*rk, F.col("lo.seq").alias("lo_seq")).agg(best, F.count("*").alias("size"))
        splits = F.coalesce(F.col("m.d") > tolerance, F.lit(False))
        if first_round:
            splits |= F.col("m") == F.max("m").over(Window.partitionBy(*rk))
        else:
            segments = segments.where(F.col("size") > SHORT)
        segments = write_scratch(segments.withColumn("splits", splits).drop("size"), "ring-splits")
        if segments.isEmpty():
            break
        kept.append(segments.where("splits").select(*rk, (-F.col("m.back")).alias("seq"), "m.x", "m.y"))
        # Segments that don't split lose their vertices, short ones wait.
        here = left.withColumn("lo_seq", F.col("lo.seq")).join(segments, [*rk, "lo_seq"], "left").where("splits is null or splits")
        done, left = left, write_scratch(split(here, F.col("splits").isNull()), "ring-round")
        drop_scratch(done)
        first_round = False
    ends = [F.col(f"{end}.{c}").alias(f"{c}{i}") for i, end in enumerate(("lo", "hi")) for c in "xy"]
    rows = left.select(*rk, F.col("lo.seq").alias("at"), "seq", "x", "y", *ends)
    ordered = rows.repartition(*rk, "at").sortWithinPartitions(*rk, "at", "seq", F.desc("x"), F.desc("y"))
    kept.append(ordered.mapInArrow(finish_stretches([*rk, "at"], "seq", v.columns, tolerance), v.schema))
    return kept
