"""Shapes of overlaps (D7, I4): the outline of the intersection of every overlapping pair of two polygon layers.

Both layers are cut by the grid cells of ``spatial.overlap_area``; edges meet only in cells of their pair. An edge is split
where the other outline meets it; a crossing point is computed once and given to both edges, so pieces fit exactly. A piece
belongs to the outline of the intersection if its middle lies inside the other polygon, told by the signed pieces of that
polygon in the middle's cell. Pieces that both outlines share count once where both polygons lie on the same side and not at
all where they lie on opposite sides.

With both layers turned so that the inside is to the left, kept pieces are chained end to start. Where several begin in a
point, the one furthest to the left follows, so rings that touch in a point stay apart. Rings and the order in them come from
pointer doubling: each round joins every piece with the one twice as far along, so a ring of n pieces takes log n rounds and
never has to fit into a task.

All points lie on a common grid far finer than the data: vertices are put on it first, crossing points are known by their
grid point. So points that differ by rounding only are one point, and pieces too short to tell a side do not occur. Where a
piece lies is still judged by its middle before rounding.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import drop_scratch, write_scratch
from .spatial import _cell_size, _index, _pieces, _whole, bounds, candidate_pairs, oriented_edges, pair_cells

_ENDS = ("x1", "y1", "x2", "y2")
#: Slack for the cells of an edge, as a share of the cell: rounding must not lose the cell in which two edges meet.
_SLACK = 1e-9
#: Bits of the largest coordinate that the grid of points keeps.
_BITS = 40


def _in_cells(e: DataFrame, cells: DataFrame, side: str) -> DataFrame:
    """Edges ``(poly, x1, y1, x2, y2)`` of one side in the cells of their pairs."""
    at = e.join(cells.select(F.col(side).alias("poly"), "level").distinct(), "poly").withColumn("c", _cell_size())
    c = F.col("c")
    low, high = (F.least("x1", "x2"), F.greatest("x1", "x2"))
    cols = at.withColumn("cx", F.explode(_whole(_index(low - _SLACK * c, c), _index(high + _SLACK * c, c))))

    def y_at(x: Column) -> Column:
        t = (x - F.col("x1")) / F.nullif(F.col("x2") - F.col("x1"), F.lit(0.0))
        return F.col("y1") + (F.col("y2") - F.col("y1")) * F.greatest(F.lit(0.0), F.least(t, F.lit(1.0)))

    flat = F.col("x1") == F.col("x2")
    ya = F.when(flat, F.col("y1")).otherwise(y_at(F.col("cx") * c - _SLACK * c))
    yb = F.when(flat, F.col("y2")).otherwise(y_at((F.col("cx") + 1) * c + _SLACK * c))
    rows = cols.withColumn("cy", F.explode(_whole(_index(F.least(ya, yb) - _SLACK * c, c), _index(F.greatest(ya, yb) + _SLACK * c, c))))
    return rows.select(F.col("poly").alias(side), "level", "cx", "cy", *[F.col(n).alias(f"{side}_{n}") for n in _ENDS]).join(
        cells, [side, "level", "cx", "cy"])


def _on_grid(x: Column, step: float) -> Column:
    return F.rint(x / step) * step


def _meetings(j: DataFrame) -> DataFrame:
    """Points in which an edge of a and one of b meet: the pair, both edges, x, y and the point's place ``a_t`` and ``b_t`` on
    them (0 and 1 are their ends)."""

    def cross(s: str, x: str, y: str) -> Column:
        return (F.col(f"{s}_x2") - F.col(f"{s}_x1")) * (F.col(y) - F.col(f"{s}_y1")) - (
            F.col(f"{s}_y2") - F.col(f"{s}_y1")) * (F.col(x) - F.col(f"{s}_x1"))

    def along(s: str, x: str, y: str) -> Column:
        dx, dy = F.col(f"{s}_x2") - F.col(f"{s}_x1"), F.col(f"{s}_y2") - F.col(f"{s}_y1")
        return ((F.col(x) - F.col(f"{s}_x1")) * dx + (F.col(y) - F.col(f"{s}_y1")) * dy) / (dx * dx + dy * dy)

    a1, a2 = cross("b", "a_x1", "a_y1"), cross("b", "a_x2", "a_y2")
    b1, b2 = cross("a", "b_x1", "b_y1"), cross("a", "b_x2", "b_y2")
    j = j.withColumns({"a1": a1, "a2": a2, "b1": b1, "b2": b2})
    t, u = F.col("a1") / (F.col("a1") - F.col("a2")), F.col("b1") / (F.col("b1") - F.col("b2"))
    proper = (F.signum("a1") * F.signum("a2") < 0) & (F.signum("b1") * F.signum("b2") < 0)
    x = F.col("a_x1") + (F.col("a_x2") - F.col("a_x1")) * t
    y = F.col("a_y1") + (F.col("a_y2") - F.col("a_y1")) * t

    def event(when: Column, px: Column, py: Column, ta: Column, tb: Column) -> Column:
        return F.when(when, F.struct(px.alias("x"), py.alias("y"), ta.cast("double").alias("a_t"), tb.cast("double").alias("b_t")))

    def end_on(side: str, other: str, k: str) -> Column:
        """End ``k`` of the edge of ``side`` on the other edge: splits that one unless at its end."""
        px, py = f"{side}_x{k}", f"{side}_y{k}"
        place = along(other, px, py)
        own = F.lit(0.0 if k == "1" else 1.0)
        ta, tb = (own, place) if side == "a" else (place, own)
        return event((F.col(f"{side}{k}") == 0) & place.between(0.0, 1.0), F.col(px), F.col(py), ta, tb)

    events = F.array(event(proper, x, y, t, u), end_on("a", "b", "1"), end_on("a", "b", "2"), end_on("b", "a", "1"),
                     end_on("b", "a", "2"))
    keep = [f"{s}_{n}" for s in "ab" for n in _ENDS]
    return j.select("a", "b", *keep, F.inline(F.filter(events, lambda e: e.isNotNull())))


def _split(e: DataFrame, met: DataFrame, side: str, step: float) -> DataFrame:
    """Pieces ``(a, b, x1, y1, x2, y2)`` between grid points of the edges ``e`` of one side, directed as their edge, with
    their middle ``mx, my``."""
    own = [f"{side}_{n}" for n in _ENDS]
    cuts = met.where((F.col(f"{side}_t") > 0) & (F.col(f"{side}_t") < 1)).select("a", "b", *own, F.col(f"{side}_t").alias("t"), "x", "y")
    starts = e.select("a", "b", *own, F.lit(0.0).alias("t"), F.col(own[0]).alias("x"), F.col(own[1]).alias("y"))
    order = Window.partitionBy("a", "b", *own).orderBy("t", "x", "y")
    points = starts.unionByName(cuts).distinct().withColumns({
        "x_": F.coalesce(F.lead("x").over(order), own[2]), "y_": F.coalesce(F.lead("y").over(order), own[3])})
    ends = {n: _on_grid(F.col(c), step) for n, c in zip(_ENDS, ("x", "y", "x_", "y_"), strict=True)}
    pieces = points.select("a", "b", *[c.alias(n) for n, c in ends.items()], ((F.col("x") + F.col("x_")) / 2).alias("mx"),
                           ((F.col("y") + F.col("y_")) / 2).alias("my"))
    return pieces.where("x1 <> x2 or y1 <> y2")


def _inside(pieces: DataFrame, pairs: DataFrame, signed: DataFrame, other: str) -> DataFrame:
    """The pieces whose middle lies inside polygon ``other`` of their pair."""
    p = pieces.join(pairs.select("a", "b", "level", "ix0", "iy0", "ix1", "iy1"), ["a", "b"]).withColumn("c", _cell_size())
    p = p.where("mx between ix0 and ix1 and my between iy0 and iy1")
    c = F.col("c")
    # On the far side of the box the middle belongs to the last cell, and what counts is the polygon just before it.
    last_x, last_y = F.ceil(F.col("ix1") / c) - 1, F.ceil(F.col("iy1") / c) - 1
    p = p.withColumns({"cx": F.least(_index(F.col("mx"), c), last_x), "cy": F.least(_index(F.col("my"), c), last_y)})
    lines = signed.select(F.col("poly").alias(other), "level", "cx", "cy", "xl", "xr", "hl", "hr", "s")
    j = p.join(lines, [other, "level", "cx", "cy"])
    mx = F.col("mx")
    edge = mx == (F.col("cx") + 1) * c
    covers = F.when(edge, (F.col("xl") < mx) & (mx <= F.col("xr"))).otherwise((F.col("xl") <= mx) & (mx < F.col("xr")))
    height = F.col("hl") + (F.col("hr") - F.col("hl")) * ((mx - F.col("xl")) / (F.col("xr") - F.col("xl")))
    above = covers & (height >= F.col("my") - F.col("cy") * c)
    return j.where(above).groupBy("a", "b", *_ENDS, "mx", "my").agg(F.sum("s").alias("w")).where("w > 0.5").drop("w")


def _doubled(links: DataFrame, value: str, merge: Column, name: str) -> DataFrame:
    """Pointer doubling: rounds of ``value = merge(value, value of the piece that to names)``, ``to = to of that piece``,
    until no value changes."""
    while True:
        far = links.select(F.col("id").alias("to"), F.col("to").alias("to2"), F.col(value).alias("far"))
        step = write_scratch(links.join(far, "to").select("id", F.col("to2").alias("to"), merge.alias(value),
                                                          (merge != F.col(value)).alias("changed")), name)
        drop_scratch(links)
        links = step.drop("changed")
        if step.where("changed").isEmpty():
            return links


def _rings(kept: DataFrame) -> DataFrame:
    """Kept pieces with ``ring`` (the smallest id in their ring), ``seq`` and ``straight`` (the outline goes straight on
    where the piece begins). Pieces that no ring closes are left out."""
    pieces = write_scratch(kept.withColumn("id", F.monotonically_increasing_id()), "clip-pieces")
    out = pieces.select("a", "b", "id", *[F.col(n).alias(f"o_{n}") for n in _ENDS]).withColumnRenamed("id", "to")
    meet = pieces.join(out, (pieces["a"] == out["a"]) & (pieces["b"] == out["b"]) & (F.col("x2") == F.col("o_x1")) & (
        F.col("y2") == F.col("o_y1"))).drop(out["a"], out["b"])
    back = F.atan2(F.col("y1") - F.col("y2"), F.col("x1") - F.col("x2"))
    ahead = F.atan2(F.col("o_y2") - F.col("o_y1"), F.col("o_x2") - F.col("o_x1"))
    turn = F.pmod(back - ahead, F.lit(6.283185307179586))  # clockwise from the way back; none at all is the way back itself
    cross = (F.col("x2") - F.col("x1")) * (F.col("o_y2") - F.col("o_y1")) - (F.col("y2") - F.col("y1")) * (F.col("o_x2") - F.col("o_x1"))
    straight = (cross == 0) & (turn > 3)
    follow = meet.groupBy("id").agg(F.min_by(F.struct("to", straight.alias("straight")), F.struct(F.when(turn == 0, 7.0).otherwise(
        turn), "to")).alias("n")).select("id", "n.to", "n.straight")
    follow = write_scratch(follow, "clip-next")
    # A piece without a follower, or that leads to one, is in no ring; nor is one that none leads to.
    while True:
        dead = follow.join(follow.select(F.col("to").alias("id")).distinct(), "id", "left_anti").union(
            follow.join(follow.select(F.col("id").alias("to")), "to", "left_anti").select("id", "to", "straight"))
        dead = write_scratch(dead.select("id").distinct(), "clip-open")
        if dead.isEmpty():
            break
        follow = write_scratch(follow.join(dead, "id", "left_anti"), "clip-next")
    low = _doubled(write_scratch(follow.select("id", "to", F.least("id", "to").alias("ring")), "clip-round"), "ring",
                   F.least("ring", "far"), "clip-round").select("id", "ring")
    marked = follow.join(low, "id")
    # Steps ahead to the piece that names the ring.
    first = F.col("id") == F.col("ring")
    steps = _doubled(write_scratch(marked.select("id", F.when(first, F.col("id")).otherwise(F.col("to")).alias("to"), F.when(
        first, 0).otherwise(1).cast("long").alias("steps")), "clip-round"), "steps", F.col("steps") + F.col("far"), "clip-round")
    begun = follow.select(F.col("to").alias("id"), "straight")
    placed = pieces.join(low, "id").join(steps.select("id", "steps"), "id").join(begun, "id")
    sizes = placed.groupBy("ring").agg((F.max("steps") + 1).alias("n"))
    return write_scratch(placed.join(sizes, "ring").withColumn("seq", (F.col("n") - F.col("steps")) % F.col("n")), "clip-rings")


def clip_overlaps(src: DataFrame, dst: DataFrame, key: str = "area_code", rel_eps: float = 1e-9) -> DataFrame:
    """Outlines of the intersections of all overlapping areas: ``(source_code, target_code, part, ring, seq, x, y)``.

    Outer rings (``ring`` 0) run counter-clockwise, holes clockwise and belong to the part around them. ``seq`` orders a ring
    and may have gaps; vertices on a straight line are left out. Areas equal ``overlap_area``; rings of less than
    ``rel_eps`` of what the boxes of their polygons share are dropped, as polygons that only touch have none.
    """
    src = src.select(F.col(key).alias("area_code"), "part", "ring", "seq", "x", "y")
    dst = dst.select(F.col(key).alias("area_code"), "part", "ring", "seq", "x", "y")
    size = F.max(F.greatest(F.abs("x"), F.abs("y"))).alias("size")
    largest = src.agg(size).unionByName(dst.agg(size)).agg(F.max("size")).first()[0]
    step = 2.0 ** (math.frexp(largest or 1.0)[1] - _BITS)
    src, dst = (v.withColumns({n: _on_grid(F.col(n).cast("double"), step) for n in ("x", "y")}) for v in (src, dst))
    pairs = write_scratch(candidate_pairs(bounds(src), bounds(dst)), "clip-pairs")
    cells = write_scratch(pair_cells(pairs), "clip-cells")
    at = ["level", "cx", "cy"]
    turned = [write_scratch(oriented_edges(v), "clip-edges") for v in (src, dst)]
    e_a, e_b = (e.select(F.struct("area_code", "part").alias("poly"), *_ENDS) for e in turned)
    in_a = write_scratch(_in_cells(e_a, cells, "a"), "clip-a")
    in_b = write_scratch(_in_cells(e_b, cells, "b"), "clip-b")
    j = in_a.join(in_b, ["a", "b", *at]).where(
        "least(a_x1, a_x2) <= greatest(b_x1, b_x2) and least(b_x1, b_x2) <= greatest(a_x1, a_x2) and "
        "least(a_y1, a_y2) <= greatest(b_y1, b_y2) and least(b_y1, b_y2) <= greatest(a_y1, a_y2)")
    met = write_scratch(_meetings(j).distinct(), "clip-meetings")
    p_a = write_scratch(_split(in_a, met, "a", step), "clip-split")
    p_b = write_scratch(_split(in_b, met, "b", step), "clip-split")
    ends = ["a", "b", *_ENDS]
    back = [F.col(n).alias(m) for n, m in zip(_ENDS, ("x2", "y2", "x1", "y1"), strict=True)]
    along = p_a.join(p_b, ends, "left_semi")
    free_a = p_a.join(p_b, ends, "left_anti").join(p_b.select("a", "b", *back), ends, "left_anti")
    free_b = p_b.join(p_a, ends, "left_anti").join(p_a.select("a", "b", *back), ends, "left_anti")
    signed_a = _pieces(turned[0], cells.select(F.col("a").alias("poly"), *at).distinct())
    signed_b = _pieces(turned[1], cells.select(F.col("b").alias("poly"), *at).distinct())
    kept = along.select(*ends).unionByName(_inside(free_a, pairs, signed_b, "b").select(*ends)).unionByName(
        _inside(free_b, pairs, signed_a, "a").select(*ends)).distinct()
    rings = _rings(kept)
    small = pairs.select("a", "b", ((F.col("ix1") - F.col("ix0")) * (F.col("iy1") - F.col("iy0")) * rel_eps).alias("least"))
    areas = rings.groupBy("a", "b", "ring").agg((F.sum(F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")) / 2).alias("area"),
                                                F.min(F.struct("x1", "y1")).alias("p"))
    areas = areas.join(small, ["a", "b"]).where(F.abs("area") > F.col("least"))
    numbered = write_scratch(_parts(areas, rings), "clip-parts")
    return rings.where("not straight").join(numbered, ["a", "b", "ring"]).select(
        F.col("a.area_code").alias("source_code"), F.col("b.area_code").alias("target_code"), "part", F.col("no").alias("ring"),
        "seq", F.col("x1").alias("x"), F.col("y1").alias("y"))


def _parts(areas: DataFrame, rings: DataFrame) -> DataFrame:
    """(a, b, ring) with its ``part`` among the overlaps of the two areas and its number ``no`` in it. A hole belongs to the
    smallest outer ring of its pair around its first vertex by coordinates, or to the smallest one that touches there."""
    codes = [F.col("a.area_code"), F.col("b.area_code")]
    outer = areas.where("area > 0").withColumn("part", (F.row_number().over(
        Window.partitionBy(*codes).orderBy("a.part", "b.part", "ring")) - 1).cast("int"))
    around = rings.join(outer.select("a", "b", "ring", "part", F.col("area").alias("size")), ["a", "b", "ring"]).select(
        "a", "b", "part", "size", *_ENDS)
    holes = areas.where("area < 0").select("a", "b", "ring", "p")
    px, py = F.col("p.x1"), F.col("p.y1")
    crosses = (F.col("y1") > py) != (F.col("y2") > py)
    right = px < F.col("x1") + (F.col("x2") - F.col("x1")) * (py - F.col("y1")) / F.nullif(F.col("y2") - F.col("y1"), F.lit(0.0))
    tested = holes.join(around, ["a", "b"]).groupBy("a", "b", "ring", "part", "size").agg(
        (F.count(F.when(crosses & right, 1)) % 2).alias("odd"))
    best = tested.groupBy("a", "b", "ring").agg(F.max_by("part", F.struct("odd", -F.col("size"))).alias("part"))
    holes = best.withColumn("no", F.row_number().over(Window.partitionBy(*codes, "part").orderBy("a.part", "b.part", "ring")).cast("int"))
    return outer.select("a", "b", "ring", "part", F.lit(0).alias("no")).unionByName(holes.select("a", "b", "ring", "part", "no"))
