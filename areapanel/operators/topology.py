"""Simplification that keeps a layer's topology (I6): shared borders stay shared, and no outline crosses itself or another.

Outlines of neighbours run along the same vertices. A vertex where they part has three or more different neighbours in the
whole layer: a junction. Junctions cut every ring into arcs. An arc is known by its end and the vertex next to it, read from
whichever end comes first by coordinates, so both neighbours of a border name it alike. Each arc is simplified once and all
rings take its vertices from there.

Douglas-Peucker keeps an arc within the tolerance but may cross other arcs, or lay two arcs between the same junctions on one
another. So after simplifying, segments meet on grid cells of the size of the larger one; a segment that touches another
elsewhere than in a common end gets back the vertex farthest from it, until there is none that can.

Work is spread by ring, by arc and by grid cell. Rings of up to ``SHORT`` vertices are cut and simplified many at a time inside
tasks. Longer ones are numbered in chunks of positions, their long arcs are split by rounds of grouped maxima until what lies
between two kept vertices is short, and only such short stretches are finished inside a task.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import drop_scratch, write_scratch
from .checks import require_columns
from .spatial import EDGE_CHUNK, SHORT, by_groups, changes, coordinates, edges, finish_stretches, keep_farthest, runs


def junctions(edge_df: DataFrame) -> DataFrame:
    """Vertices ``(x, y)`` with three or more different neighbours along the edges of all rings."""
    there = edge_df.select("x1", "y1", "x2", "y2")
    back = edge_df.select(F.col("x2").alias("x1"), F.col("y2").alias("y1"), F.col("x1").alias("x2"), F.col("y1").alias("y2"))
    pairs = there.unionByName(back).repartition("x1", "y1").distinct()  # one exchange for both groupings
    return pairs.groupBy(F.col("x1").alias("x"), F.col("y1").alias("y")).count().where("count >= 3").drop("count")


def _without_repeats(vertices: DataFrame, rk: list[str]) -> DataFrame:
    """Drops a vertex that equals the one before it in the ring (before the first stands the last)."""
    v = vertices.select(*rk, "seq", "x", "y", F.floor(F.col("seq") / EDGE_CHUNK).alias("chunk"))
    point = F.struct("x", "y")
    lasts = v.groupBy(*rk, "chunk").agg(F.max_by(point, "seq").alias("p"))
    ring = Window.partitionBy(*rk).orderBy("chunk")
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = lasts.select(*rk, "chunk", F.coalesce(F.lag("p").over(ring), F.last("p").over(whole)).alias("p"))
    within = Window.partitionBy(*rk, "chunk").orderBy("seq")
    last = F.coalesce(F.lag(point).over(within), "p")
    return v.join(before, [*rk, "chunk"]).withColumn("last", last).where(point != F.col("last")).drop("p", "last")


def _numbered(v: DataFrame, rk: list[str]) -> DataFrame:
    """Vertices with a ``cut`` flag: adds their number ``i`` in the ring, its size ``n`` and the last cut ``start`` at or
    before them (before the first cut stands the last one)."""
    within = Window.partitionBy(*rk, "chunk").orderBy("seq")
    ring = Window.partitionBy(*rk).orderBy("chunk")
    earlier = ring.rowsBetween(Window.unboundedPreceding, -1)
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = v.withColumn("k", F.row_number().over(within) - 1)
    chunks = placed.groupBy(*rk, "chunk").agg(F.count("*").alias("c"), F.max(F.when(F.col("cut"), F.col("k"))).alias("k"))
    chunks = chunks.withColumn("base", F.coalesce(F.sum("c").over(earlier), F.lit(0))).withColumn("at", F.col("base") + F.col("k"))
    chunks = chunks.select(*rk, "chunk", "base", F.sum("c").over(whole).alias("n"),
                           F.coalesce(F.max("at").over(earlier), F.max("at").over(whole)).alias("before"))
    joined = placed.join(chunks, [*rk, "chunk"]).withColumn("i", F.col("base") + F.col("k"))
    upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = F.coalesce(F.max(F.when(F.col("cut"), F.col("i"))).over(upto), "before")
    return joined.withColumn("start", start).drop("k", "base", "before", "chunk")


def _short_ring_arcs(rk: list[str], tolerance: float) -> Callable:
    """A task over whole rings, whose rows follow one another by seq: the rows of their arcs as of ``ring_arcs``, with the
    name of the arc in ax, ay, nx, ny, and whether each is ``kept``."""

    def arcs(rows: pa.Table, starts: np.ndarray) -> pa.Table:
        (x, y), null = coordinates(rows, "x", "y")
        seq, cut, size = rows.column("seq").to_numpy(), rows.column("cut").to_numpy(), rows.num_rows
        ring = runs(starts, size)
        sizes, i = np.diff(np.append(starts, size)), np.arange(size) - starts[ring]
        alone = ~np.maximum.reduceat(cut, starts)
        cut = cut.copy()
        cut[np.lexsort((seq, y, x, ring))[starts[alone]]] = True
        cuts = np.flatnonzero(cut)
        n = sizes[ring[cuts]]
        firsts = changes(ring[cuts])  # of each ring's cuts
        lasts = np.append(firsts[1:], len(cuts)) - 1
        follow = np.arange(1, len(cuts) + 1)
        follow[lasts] = firsts
        m = (i[cuts[follow]] - i[cuts] - 1) % n + 1
        here = np.cumsum(cut) - 1
        here = np.where(here < firsts[ring], lasts[ring], here)

        # Both ends of each arc, and the vertices next to them.
        base = starts[ring[cuts]]
        ends = [(cuts, base + (i[cuts] + 1) % n), (cuts[follow], base + (i[cuts[follow]] - 1) % n)]
        there, back = ([c[k] for k in e for c in (x, y)] for e in ends)
        turned, same = np.zeros(len(cuts), bool), np.ones(len(cuts), bool)
        for p, q in zip(there, back, strict=True):
            turned, same = turned | same & (q < p), same & (q == p)
        name = [np.where(turned, q, p) for p, q in zip(there, back, strict=True)]

        at, arc = np.concatenate([np.arange(size), cuts[follow]]), np.concatenate([here, np.arange(len(cuts))])
        p = np.concatenate([(i - i[cuts[here]]) % sizes[ring], m])
        pos = np.where(turned[arc], m[arc] - p, p)
        by = np.lexsort((pos, arc))
        at, arc, pos = at[by], arc[by], pos[by]
        x, y, null = x[at], y[at], null[at]
        first = changes(arc)
        inner = np.flatnonzero((pos > 0) & (pos < m[arc]))
        kept = (pos == 0) | (pos == m[arc])
        kept[keep_farthest(x, y, null, pos, inner, first[arc[inner]], (first + m)[arc[inner]], tolerance, closed=True)] = True
        own = by < size
        out = rows.select([*rk, "seq", "x", "y"]).take(at)
        for column, values in (("own", own), ("pos", pos), ("m", m[arc]), ("kept", kept), *(
                (c, v[arc]) for c, v in zip(("ax", "ay", "nx", "ny"), name, strict=True))):
            out = out.append_column(column, pa.array(values))
        return out

    return by_groups(rk, arcs)


def ring_arcs(vertices: DataFrame, tolerance: float, key: str = "area_code") -> tuple[DataFrame, DataFrame | None]:
    """The vertices of all arcs of all rings: key, part, ring, seq, x, y, ``own`` (false where the vertex is only the end of
    an arc), ``arc`` (name), ``pos`` (in the arc, from the end that names it), ``m`` (edges of the arc). A ring without
    junctions is one arc from its first vertex by coordinates back to itself.

    Rings of up to ``SHORT`` vertices are brought together and cut inside tasks, which also simplify their arcs (``kept``):
    both neighbours of a border read it from the same end and keep the same vertices. The rows of longer rings come second,
    not simplified, if there are any."""
    rk = [key, "part", "ring"]
    v = write_scratch(_without_repeats(vertices, rk), "outlines")
    meet = junctions(edges(v, key)).withColumn("cut", F.lit(True))
    marked = v.join(meet, ["x", "y"], "left").withColumn("cut", F.col("cut").isNotNull())
    long = write_scratch(v.groupBy(*rk).count().where(F.col("count") > SHORT).drop("count"), "long-rings")
    many = not long.isEmpty()
    short = marked.join(F.broadcast(long), rk, "left_anti") if many else marked  # at most one ring for SHORT vertices
    ordered = short.select(*rk, "seq", "x", "y", "cut").repartition(*rk).sortWithinPartitions(*rk, "seq")
    names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in v.select(*rk, "seq", "x", "y").schema)
    cut = ordered.mapInArrow(_short_ring_arcs(rk, tolerance), names + ", own boolean, pos long, m long, kept boolean, "
                             "ax double, ay double, nx double, ny double")
    arc = F.struct(F.struct(F.col("ax").alias("x"), F.col("ay").alias("y")).alias("a"),
                   F.struct(F.col("nx").alias("x"), F.col("ny").alias("y")).alias("next"))
    rows = write_scratch(cut.select(*rk, "seq", "x", "y", "own", arc.alias("arc"), "pos", "m", "kept"), "arcs")
    return rows, write_scratch(_long_ring_arcs(marked.join(F.broadcast(long), rk), rk), "arcs") if many else None


def _long_ring_arcs(marked: DataFrame, rk: list[str]) -> DataFrame:
    """The rows of arcs of rings that are spread over tasks."""
    first = marked.groupBy(*rk).agg(F.max("cut").alias("any"), F.min(F.struct("x", "y", "seq")).alias("first"))
    marked = marked.join(first, rk).withColumn("cut", F.col("cut") | (~F.col("any") & (F.col("seq") == F.col("first.seq"))))
    v = write_scratch(_numbered(marked.drop("any", "first"), rk), "outline-vertices")

    order = Window.partitionBy(*rk).orderBy("start")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cuts = v.where("cut").select(*rk, "start", "n", "seq", "x", "y")
    follow = F.coalesce(F.lead("start").over(order), F.first("start").over(whole))
    arcs = cuts.select(*rk, "start", F.coalesce(F.lag("start").over(order), F.last("start").over(whole)).alias("previous"),
                       "seq", "x", "y", (F.pmod(follow - F.col("start") - 1, F.col("n")) + 1).alias("m"))
    sizes = arcs.select(*rk, "start", "m")
    own = v.join(sizes, [*rk, "start"]).select(*rk, "start", "seq", "x", "y", "m", F.pmod(
        F.col("i") - F.col("start"), F.col("n")).alias("p"), F.lit(True).alias("own"))
    ends = arcs.select(*rk, F.col("previous").alias("start"), "seq", "x", "y").join(sizes, [*rk, "start"]).select(
        *rk, "start", "seq", "x", "y", "m", F.col("m").alias("p"), F.lit(False).alias("own"))
    rows = own.unionByName(ends)

    def at(place: Column) -> Column:
        return F.max(F.when(F.col("p") == place, F.struct("x", "y")))

    m = F.col("m")
    named = rows.where((F.col("p") <= 1) | (F.col("p") >= m - 1)).groupBy(*rk, "start").agg(
        F.struct(at(F.lit(0)).alias("a"), at(F.lit(1)).alias("next")).alias("there"),
        F.struct(at(m).alias("a"), at(m - 1).alias("next")).alias("back"))
    turned = F.col("back") < F.col("there")
    return rows.join(named, [*rk, "start"]).select(
        *rk, "seq", "x", "y", "own", F.least("there", "back").alias("arc"),
        F.when(turned, m - F.col("p")).otherwise(F.col("p")).cast("long").alias("pos"), m.cast("long").alias("m"))


def _distance(lo: str, hi: str) -> Column:
    cx, cy = F.col(f"{hi}.x") - F.col(f"{lo}.x"), F.col(f"{hi}.y") - F.col(f"{lo}.y")
    px, py = F.col("x") - F.col(f"{lo}.x"), F.col("y") - F.col(f"{lo}.y")
    chord = F.hypot(cx, cy)
    return F.when(chord == 0, F.hypot(px, py)).otherwise(F.abs(cx * py - cy * px) / chord)


_STRETCH = ("arc.a.x", "arc.a.y", "arc.next.x", "arc.next.y", "lo.pos")
_ENDS = {"x0": "lo.x", "y0": "lo.y", "x1": "hi.x", "y1": "hi.y"}


def simplify_arcs(points: DataFrame, tolerance: float) -> DataFrame:
    """The kept ``(arc, pos, x, y)`` of whole arcs ``(arc, pos, x, y, m)``, ends included: Douglas-Peucker, of equally far
    vertices the first. Where both ends of a stretch are one point its farthest vertex is always kept."""
    end = F.struct("pos", "x", "y")
    outer = points.where("pos = 0 or pos = m")
    ends = outer.groupBy("arc").agg(F.min(end).alias("lo"), F.max(end).alias("hi"))
    kept = outer.select("arc", "pos", "x", "y")
    left = write_scratch(points.where("pos > 0 and pos < m").select("arc", "pos", "x", "y").join(ends, "arc"), "arc-left")
    while True:
        best = F.max(F.struct(_distance("lo", "hi").alias("d"), (-F.col("pos")).alias("back"), "x", "y")).alias("far")
        closed = (F.col("lo.x") == F.col("hi.x")) & (F.col("lo.y") == F.col("hi.y"))
        long = left.groupBy("arc", F.col("lo.pos").alias("at")).agg(
            F.count("*").alias("size"), best, F.first("lo").alias("lo"), F.first("hi").alias("hi")).where(F.col("size") > SHORT)
        long = write_scratch(long.select("arc", "at", ((F.col("far.d") > tolerance) | closed).alias("splits"), F.struct(
            (-F.col("far.back")).alias("pos"), "far.x", "far.y").alias("mid")), "arc-splits")
        if long.isEmpty():
            break
        kept = kept.unionByName(long.where("splits").select("arc", "mid.*"))
        # Stretches that don't split lose their vertices, short ones wait.
        after = left.withColumn("at", F.col("lo.pos")).join(long, ["arc", "at"], "left").where(
            "splits is null or (splits and pos <> mid.pos)")
        low, high = F.col("pos") < F.col("mid.pos"), F.col("pos") > F.col("mid.pos")
        done, left = left, write_scratch(after.select(
            "arc", "pos", "x", "y", F.when(high, F.col("mid")).otherwise(F.col("lo")).alias("lo"),
            F.when(low, F.col("mid")).otherwise(F.col("hi")).alias("hi")), "arc-left")
        drop_scratch(done)
    ordered = left.repartition("arc", F.col("lo.pos")).sortWithinPartitions("arc", "lo.pos", "pos")
    rows = ordered.select(*[F.col(c).alias(f"s{i}") for i, c in enumerate(_STRETCH)],
                          *[F.col(c).alias(name) for name, c in _ENDS.items()], "pos", "x", "y", "arc")
    task = finish_stretches([f"s{i}" for i in range(len(_STRETCH))], "pos", ["arc", "pos", "x", "y"], tolerance, closed=True)
    arc = points.schema["arc"].dataType.simpleString()
    return kept.unionByName(rows.mapInArrow(task, f"arc {arc}, pos long, x double, y double"))


# --- segments that meet where they mustn't ----------------------------------------------------

def touching(segments: DataFrame, name: str = "id") -> DataFrame:
    """Pairs ``(a, b)`` (names, ``a < b``) of segments ``(name, x1, y1, x2, y2)`` that share a point other than a common
    end, or are the same twice. A segment meets others on grid cells of its own size (at most four) and of the larger sizes
    that occur, so each pair is compared on the cells of its larger segment."""
    lx, hx, ly, hy = F.least("x1", "x2"), F.greatest("x1", "x2"), F.least("y1", "y2"), F.greatest("y1", "y2")
    own = F.ceil(F.log2(F.greatest(hx - lx, hy - ly))).cast("int")
    s = segments.select(F.col(name).alias("id"), *[F.col(c) for c in ("x1", "y1", "x2", "y2")], lx.alias("lx"), hx.alias("hx"),
                        ly.alias("ly"), hy.alias("hy"), own.alias("own")).where("lx < hx or ly < hy")
    levels = s.agg(F.collect_set("own").alias("levels")).scalar()  # exponents of doubles: a bounded set
    at = s.withColumn("levels", levels).withColumn("level", F.explode(F.filter("levels", lambda l: l >= F.col("own"))))
    cell = F.pow(F.lit(2.0), F.col("level"))

    def span(lo: str, hi: str) -> Column:
        return F.explode(F.sequence(F.floor(F.col(lo) / cell), F.floor(F.col(hi) / cell)))

    at = at.drop("levels").withColumn("cx", span("lx", "hx")).withColumn("cy", span("ly", "hy"))
    meet = ["level", "cx", "cy"]
    large = at.where("own = level").select(*meet, *[F.col(c).alias("a_" + c) for c in s.columns])
    any_ = at.select(*meet, *[F.col(c).alias("b_" + c) for c in s.columns])
    j = large.join(any_, meet).where("a_lx <= b_hx and b_lx <= a_hx and a_ly <= b_hy and b_ly <= a_hy")
    j = j.where((F.col("b_own") < F.col("a_own")) | (F.col("a_id") < F.col("b_id")) & (F.col("b_own") == F.col("a_own")))
    # Once for each pair: in the cell of the lower left corner of what both boxes share.
    j = j.where((F.floor(F.greatest("a_lx", "b_lx") / cell) == F.col("cx")) & (
        F.floor(F.greatest("a_ly", "b_ly") / cell) == F.col("cy")))

    def side(s: str, x: str, y: str) -> Column:
        """Which side of the line of ``s`` a point is on."""
        dx, dy = F.col(f"{s}_x2") - F.col(f"{s}_x1"), F.col(f"{s}_y2") - F.col(f"{s}_y1")
        return F.signum(dx * (F.col(y) - F.col(f"{s}_y1")) - dy * (F.col(x) - F.col(f"{s}_x1")))

    def equal(p: str, q: str) -> Column:
        return (F.col(f"a_x{p}") == F.col(f"b_x{q}")) & (F.col(f"a_y{p}") == F.col(f"b_y{q}"))

    def beyond(p: str, q: str) -> Column:
        """From the common end, ends ``p`` of a and ``q`` of b, both run the same way."""
        o, r = ("2", "1")[p == "2"], ("2", "1")[q == "2"]
        ax, ay = F.col(f"a_x{o}") - F.col(f"a_x{p}"), F.col(f"a_y{o}") - F.col(f"a_y{p}")
        bx, by = F.col(f"b_x{r}") - F.col(f"b_x{q}"), F.col(f"b_y{r}") - F.col(f"b_y{q}")
        return equal(p, q) & (ax * by - ay * bx == 0) & (ax * bx + ay * by > 0)

    common = equal("1", "1") | equal("1", "2") | equal("2", "1") | equal("2", "2")
    crossing = (side("a", "b_x1", "b_y1") * side("a", "b_x2", "b_y2") <= 0) & (
        side("b", "a_x1", "a_y1") * side("b", "a_x2", "a_y2") <= 0)
    along = beyond("1", "1") | beyond("1", "2") | beyond("2", "1") | beyond("2", "2")
    found = j.where(F.when(common, along).otherwise(crossing))
    return found.select(F.least("a_id", "b_id").alias("a"), F.greatest("a_id", "b_id").alias("b"))


def topology_faults(vertices: DataFrame, key: str = "area_code") -> DataFrame:
    """Pairs of different segments of a whole layer that share a point other than a common end. None means: no ring crosses
    itself or another, and neighbours run along the very same segments wherever they touch."""
    e = edges(vertices, key).select(F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")).alias("p"),
                                    F.struct(F.col("x2").alias("x"), F.col("y2").alias("y")).alias("q"))
    once = e.select(F.least("p", "q").alias("p"), F.greatest("p", "q").alias("q")).distinct()
    return touching(once.select(F.struct("p", "q").alias("id"), F.col("p.x").alias("x1"), F.col("p.y").alias("y1"),
                                F.col("q.x").alias("x2"), F.col("q.y").alias("y2")))


def _segments(kept: DataFrame) -> DataFrame:
    """Segments between consecutive kept vertices of each arc; ``id`` holds the arc and the places of both ends."""
    w = Window.partitionBy("arc").orderBy("pos")
    nxt = kept.select("arc", "pos", "x", "y", *[F.lead(c).over(w).alias(f"{c}_") for c in ("pos", "x", "y")]).where("pos_ is not null")
    return nxt.select(F.struct("arc", "pos", F.col("pos_").alias("end")).alias("id"), F.col("x").alias("x1"),
                      F.col("y").alias("y1"), F.col("x_").alias("x2"), F.col("y_").alias("y2"))


def simplify_topology(vertices: DataFrame, tolerance: float, key: str = "area_code") -> DataFrame:
    """The layer ``(key, part, ring, seq, x, y)`` with every arc simplified to ``tolerance`` and all faults that this
    would make mended. ``seq`` keeps the input positions. Neighbours keep identical borders and rings of three or more
    different vertices keep three. Faults of the input itself (segments that cross, borders with vertices on one side only)
    stay as they are. Repeated rows and rings of fewer than three vertices should not occur; they don't fail."""
    require_columns(vertices, [key, "part", "ring", "seq", "x", "y"])
    short, long = ring_arcs(vertices, tolerance, key)
    kept, rings, points = short.where("kept").select("arc", "pos", "x", "y"), short, short.select("arc", "pos", "x", "y")
    if long is not None:
        whole = write_scratch(long.groupBy("arc", "pos").agg(*[F.first(c).alias(c) for c in ("x", "y", "m")]), "arc-points")
        found = write_scratch(simplify_arcs(whole, tolerance), "arc-found")
        kept, points = kept.unionByName(found), points.unionByName(whole.drop("m"))
        rings = short.unionByName(long.join(found.select("arc", "pos").distinct().withColumn("kept", F.lit(True)), ["arc", "pos"], "left")
                                  .withColumn("kept", F.col("kept").isNotNull()))
    kept = write_scratch(kept.dropDuplicates(["arc", "pos"]), "arc-kept")
    restored = []
    while True:
        faulty = touching(_segments(kept)).select(F.explode(F.array("a", "b")).alias("id")).distinct()
        faulty = faulty.where(F.col("id.end") > F.col("id.pos") + 1)
        ends = faulty.select("id.arc", F.col("id.pos").alias("from"), F.col("id.end").alias("to"))
        # The ends of the stretch, then the vertex between them that is farthest from it.
        named = ends.join(kept.select("arc", F.col("pos").alias("from"), F.struct("x", "y").alias("lo")), ["arc", "from"]).join(
            kept.select("arc", F.col("pos").alias("to"), F.struct("x", "y").alias("hi")), ["arc", "to"])
        between = points.join(named, "arc").where("pos > from and pos < to")
        best = F.max(F.struct(_distance("lo", "hi").alias("d"), (-F.col("pos")).alias("back"), "x", "y")).alias("far")
        back = write_scratch(between.groupBy("arc", "from").agg(best).select(
            "arc", (-F.col("far.back")).alias("pos"), "far.x", "far.y"), "arc-restored")
        if back.isEmpty():
            break
        restored.append(back.select("arc", "pos"))
        done, kept = kept, write_scratch(kept.unionByName(back), "arc-kept")
        drop_scratch(done)
    out = [rings.where("own and kept")]
    if restored:
        out.append(rings.where("own and not kept").join(
            reduce(DataFrame.unionByName, restored).distinct(), ["arc", "pos"], "left_semi"))
    return reduce(DataFrame.unionByName, [df.select(key, "part", "ring", "seq", "x", "y") for df in out])
