import math
import random

from pyspark.sql import functions as F

from areapanel.operators import spatial as G
from areapanel.sinks.tables import boundary_features

SCHEMA = "area_code string, part int, ring int, seq int, x double, y double"


def poly(code, rings, part=0):
    return [(code, part, r, i, float(x), float(y)) for r, ring in enumerate(rings) for i, (x, y) in enumerate(ring)]


def sq(x0, y0, w):
    return [(x0, y0), (x0 + w, y0), (x0 + w, y0 + w), (x0, y0 + w)]


def test_unit_squares(spark):
    a = spark.createDataFrame(poly("A", [sq(0, 0, 1)]), SCHEMA)
    b = spark.createDataFrame(poly("B", [sq(0.5, 0.5, 1)]), SCHEMA)
    assert [tuple(r)[:3] for r in G.overlap_area(a, b).collect()] == [("A", "B", 0.25)]


def test_hole_and_winding(spark):
    holed = spark.createDataFrame(poly("H", [sq(0, 0, 4), sq(1, 1, 2)]), SCHEMA)  # hole given CCW
    left = spark.createDataFrame(poly("L", [[(0, 0), (2, 0), (2, 4), (0, 4)][::-1]]), SCHEMA)  # CW outer
    assert G.overlap_area(holed, left).first().overlap_area == 6.0
    assert G.polygon_area(holed).first().area == 12.0


def test_grids_49_pairs(spark):
    a, b = [], []
    for i in range(4):
        for j in range(4):
            a += poly(f"a{i}{j}", [sq(i, j, 1)])
            b += poly(f"b{i}{j}", [sq(i + 0.25, j + 0.25, 1)])
    out = G.overlap_area(spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA)).collect()
    assert len(out) == 49
    assert abs(sum(r.overlap_area for r in out) - 14.0625) < 1e-12
    sizes = sorted(round(r.overlap_area, 9) for r in out)
    assert sizes.count(0.5625) == 16 and sizes.count(0.1875) == 24 and sizes.count(0.0625) == 9


def _inside(pt, ring):
    x, y = pt
    c = False
    for i in range(len(ring)):
        x1, y1 = ring[i]
        x2, y2 = ring[(i + 1) % len(ring)]
        if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
            c = not c
    return c


def test_concave_against_sampling(spark):
    ell = [(0, 0), (3, 0), (3, 1), (1, 1), (1, 3), (0, 3)]
    tri = [(0.5, 0.5), (2.5, 0.2), (0.2, 2.8)]
    got = G.overlap_area(spark.createDataFrame(poly("L", [ell]), SCHEMA),
                         spark.createDataFrame(poly("T", [tri]), SCHEMA)).first().overlap_area
    rnd = random.Random(7)
    n = 200_000
    hits = sum(_inside(p, ell) and _inside(p, tri) for p in ((rnd.uniform(0, 3), rnd.uniform(0, 3))
                                                             for _ in range(n)))
    assert abs(got - 9 * hits / n) < 0.02


def test_weights_sum_to_one_when_targets_tile(spark):
    src = spark.createDataFrame(poly("s", [[(0.3, 0.2), (2.7, 0.4), (2.2, 2.9), (0.1, 1.7)]]), SCHEMA)
    tiles = []
    for i in range(3):
        for j in range(3):
            tiles += poly(f"t{i}{j}", [sq(i, j, 1)])
    w = G.overlap_weights(src, spark.createDataFrame(tiles, SCHEMA))
    assert abs(w.agg(F.sum("weight")).first()[0] - 1.0) < 1e-12


def test_reweight_preserves_count_total(spark):
    src = spark.createDataFrame(poly("s1", [sq(0, 0, 2)]) + poly("s2", [sq(2, 0, 2)]), SCHEMA)
    dst = spark.createDataFrame(poly("d1", [sq(0, 0, 1.5)]) + poly("d2", [[(1.5, 0), (4, 0), (4, 2), (1.5, 2)]])
                                + poly("d3", [[(0, 1.5), (1.5, 1.5), (1.5, 2), (0, 2)]]), SCHEMA)
    cw = G.overlap_weights(src, dst)
    vals = spark.createDataFrame([("s1", 10.0), ("s2", 30.0)], "source_code string, v double")
    out = G.crosswalk_reweight(vals, cw, ["v"])
    assert abs(out.agg(F.sum("v")).first()[0] - 40.0) < 1e-9


def test_touching_pairs_dropped(spark):
    a = spark.createDataFrame(poly("a", [sq(0, 0, 1)]), SCHEMA)
    b = spark.createDataFrame(poly("b", [[(1, 0), (2, 0), (2, 1), (1, 0.5)]]), SCHEMA)
    assert G.overlap_area(a, b).count() == 0


def test_os_worked_example(spark):
    lat = 52 + 39 / 60 + 27.2531 / 3600
    lon = 1 + 43 / 60 + 4.5177 / 3600
    df = spark.createDataFrame([(lon, lat)], "lon double, lat double")
    e, n = G.osgb36_to_grid(F.col("lon"), F.col("lat"))
    r = df.select(e.alias("e"), n.alias("n")).first()
    assert abs(r.e - 651409.903) < 0.001 and abs(r.n - 313177.270) < 0.001
    back = G.grid_to_osgb36(spark.createDataFrame([(651409.903, 313177.270)], "x double, y double"),
                            "x", "y", "lon", "lat").first()
    assert abs(back.lat - lat) < 1e-8 and abs(back.lon - lon) < 1e-8


def test_projection_round_trip(spark):
    v = spark.createDataFrame([("a", 0, 0, 0, 325000.0, 673000.0), ("a", 0, 0, 1, 651409.903, 313177.27)], SCHEMA)
    w = G.project_vertices(v, "EPSG:4326")
    first = w.orderBy("seq").first()
    assert 55.9 < first.y < 56.0 and -3.3 < first.x < -3.1  # Edinburgh area
    back = G.project_vertices(w, "EPSG:27700").orderBy("seq").collect()
    assert abs(back[0].x - 325000.0) < 0.01 and abs(back[1].y - 313177.27) < 0.01


def test_simplify_keeps_corners(spark):
    ring = []
    for i in range(40):
        t = i / 10
        ring.append((t, 0.001 * math.sin(i)))
    ring += [(4, 1), (0, 1)]
    v = spark.createDataFrame(poly("z", [ring]), SCHEMA)
    out = G.simplify_rings(v, 0.01).orderBy("seq").collect()
    pts = {(round(r.x, 6), round(r.y, 6)) for r in out}
    assert (4.0, 1.0) in pts and (0.0, 1.0) in pts and len(out) < 10


def test_geojson_round_trip_and_prepare(spark):
    v = spark.createDataFrame(poly("S1", [sq(0, 0, 2), sq(0.5, 0.5, 1)]) + poly("X9", [sq(5, 5, 1)]), SCHEMA)
    props = spark.createDataFrame([("S1", "Steòrnabhagh a Deas"), ("X9", "Other")], "area_code string, name string")
    feats = boundary_features(v, "area_code", props)
    back = G.geojson_vertices(feats, props={"area_code": "code"})
    assert back.count() == 12
    from areapanel.functions.text import normalise_name
    geom, lookup = G.prepare_boundaries(feats, "area_code", "name", 2022, name_fn=normalise_name)
    row = lookup.first()
    assert lookup.count() == 1 and row.ward_name_2022 == "stea2rnabhaghadeas" and row.area_2022 == 3.0


def _seg_dist(p, a, b):
    (px, py), (ax, ay), (bx, by) = p, a, b
    dx, dy = bx - ax, by - ay
    L = dx * dx + dy * dy
    t = 0.0 if L == 0 else max(0.0, min(1.0, ((px - ax) * dx + (py - ay) * dy) / L))
    return math.hypot(px - ax - t * dx, py - ay - t * dy)


def test_simplify_stays_within_tolerance(spark):
    rnd = random.Random(3)
    ring = [(math.cos(2 * math.pi * i / 200) * (10 + rnd.uniform(-0.3, 0.3)),
             math.sin(2 * math.pi * i / 200) * (10 + rnd.uniform(-0.3, 0.3))) for i in range(200)]
    v = spark.createDataFrame(poly("c", [ring]), SCHEMA)
    tol = 0.5
    out = sorted((r.seq, r.x, r.y) for r in G.simplify_rings(v, tol).collect())
    pts = [(x, y) for _, x, y in out]
    assert 3 <= len(pts) < 200
    segs = list(zip(pts, pts[1:] + pts[:1]))
    assert max(min(_seg_dist(p, a, b) for a, b in segs) for p in ring) <= tol + 1e-9
    spread = G.simplify_rings(v.repartition(7), tol)
    assert sorted((r.seq, r.x, r.y) for r in spread.collect()) == out


def test_simplify_square_keeps_four_and_flat_ring_three(spark):
    side = [(i / 25, 0) for i in range(25)] + [(1, i / 25) for i in range(25)] \
        + [(1 - i / 25, 1) for i in range(25)] + [(0, 1 - i / 25) for i in range(25)]
    flat = [(0, 0), (1, 1e-9), (2, 0), (1, -2e-9)]
    v = spark.createDataFrame(poly("s", [side]) + poly("f", [flat]) + poly("t", [[(0, 0), (1, 1)]]), SCHEMA)
    got = {}
    for r in G.simplify_rings(v, 0.01).collect():
        got.setdefault(r.area_code, set()).add(r.seq)
    assert got == {"s": {0, 25, 50, 75}, "f": {0, 2, 3}, "t": {0, 1}}


def test_simplify_empty(spark):
    assert G.simplify_rings(spark.createDataFrame([], SCHEMA), 0.1).count() == 0


def _half_plane_cut(ring, box):
    """Sutherland-Hodgman: area of a simple ring clipped to a box (exact for any simple ring's area)."""
    x0, y0, x1, y1 = box
    for axis, lim, sign in ((0, x0, 1), (0, x1, -1), (1, y0, 1), (1, y1, -1)):
        out = []
        for p, q in zip(ring, ring[1:] + ring[:1]):
            dp, dq = sign * (p[axis] - lim), sign * (q[axis] - lim)
            if dp >= 0:
                out.append(p)
            if (dp > 0 > dq) or (dp < 0 < dq):
                t = dp / (dp - dq)
                out.append((p[0] + (q[0] - p[0]) * t, p[1] + (q[1] - p[1]) * t))
        ring = out
    return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1]))) / 2


def test_one_huge_box_over_many_small(spark):
    small = [r for i in range(30) for j in range(30) for r in poly(f"s{i}_{j}", [sq(i, j, 0.5)])]
    huge = poly("h", [sq(-5000.25, -4999.75, 10000)])
    out = G.overlap_area(spark.createDataFrame(small, SCHEMA), spark.createDataFrame(huge, SCHEMA)).collect()
    assert len(out) == 900 and all(abs(r.overlap_area - 0.25) < 1e-12 for r in out)
    back = G.overlap_area(spark.createDataFrame(huge, SCHEMA), spark.createDataFrame(small, SCHEMA)).collect()
    assert len(back) == 900 and all(abs(r.overlap_area - 0.25) < 1e-12 for r in back)


def test_steep_coast_against_clipping(spark):
    rnd = random.Random(5)
    coast = [(10 + rnd.uniform(-0.4, 0.4), y / 20) for y in range(400)]  # many edges in a narrow band of x
    ring = [(0.0, -1.0), *coast, (0.0, 21.0)]
    tiles = [(f"t{i}_{j}", (8 + i * 1.3, j * 2.5 - 1.7, 8 + i * 1.3 + 1.3, j * 2.5 + 0.8)) for i in range(4)
             for j in range(9)]
    dst = [r for n, (x0, y0, x1, y1) in tiles for r in poly(n, [[(x0, y0), (x1, y0), (x1, y1), (x0, y1)]])]
    got = {r.target_code: r.overlap_area for r in G.overlap_area(
        spark.createDataFrame(poly("c", [ring]), SCHEMA), spark.createDataFrame(dst, SCHEMA)).collect()}
    for n, box in tiles:
        assert abs(got.get(n, 0.0) - _half_plane_cut(ring, box)) < 1e-9, n


def test_overlap_on_grid_lines_and_vertical_edges(spark):
    a = [r for i in range(4) for j in range(4) for r in poly(f"a{i}{j}", [sq(i, j, 1)])]
    b = poly("b", [[(0, 0), (2, 0), (2, 2), (1, 2), (1, 1), (0, 1)]]) + poly("b", [sq(3, 3, 1)], part=1)
    out = {r.source_code: r.overlap_area for r in G.overlap_area(
        spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA)).collect()}
    assert out == {"a00": 1.0, "a10": 1.0, "a11": 1.0, "a33": 1.0}


def test_overlap_of_wards_against_points(spark):
    """Random star shapes on both sides: areas agree with counting points of a fine lattice."""
    rnd = random.Random(11)

    def star(cx, cy, r, n):
        return [(cx + r * rnd.uniform(0.4, 1) * math.cos(2 * math.pi * i / n),
                 cy + r * rnd.uniform(0.4, 1) * math.sin(2 * math.pi * i / n)) for i in range(n)]

    A = {"big": star(0, 0, 4, 60), "mid": star(1, 1, 1, 12)}
    B = {"x": star(0.5, 0.2, 3, 40), "y": star(-2, 1, 0.7, 9)}
    mk = lambda d: spark.createDataFrame([r for n, ring in d.items() for r in poly(n, [ring])], SCHEMA)
    got = {(r.source_code, r.target_code): r.overlap_area for r in G.overlap_area(mk(A), mk(B)).collect()}
    step = 0.04
    pts = [(i * step + 0.013, j * step + 0.007) for i in range(-100, 100) for j in range(-100, 100)]
    inside = {n: {p for p in pts if _inside(p, ring)} for n, ring in {**A, **B}.items()}
    for i in A:
        for j in B:
            want = len(inside[i] & inside[j]) * step * step
            assert abs(got.get((i, j), 0.0) - want) < 0.02 * max(want, 1), (i, j)


def test_edges_in_chunks_close_rings(spark):
    ring = [(0, 0), (4, 0), (4, 1), (2, 3), (0, 1)]
    rows = [("r", 0, 0, s, float(x), float(y)) for s, (x, y) in zip([0, 1, 3, 7, 8], ring)]  # gaps in seq
    v = spark.createDataFrame(rows, SCHEMA)
    for chunk in (2, 3, 50_000):
        e = {(r.x1, r.y1, r.x2, r.y2) for r in G.edges(v, chunk_size=chunk).collect()}
        want = {(float(a), float(b), float(c), float(d)) for (a, b), (c, d) in zip(ring, ring[1:] + ring[:1])}
        assert e == want, chunk
        assert G.polygon_area(v).first().area == 8.0


def test_simplify_brings_short_rings_to_one_task_and_splits_long_ones(spark, monkeypatch):
    """No table of a row per ring is broadcast; rounds for long rings, and odd rows, change nothing."""
    rnd = random.Random(7)
    rows = [(f"R{k}", 0, 0, i, math.cos(2 * math.pi * i / n) * rnd.uniform(.8, 1), math.sin(2 * math.pi * i / n) * rnd.uniform(.8, 1))
            for k, n in enumerate([3, 40, 41, 90, 400]) for i in range(n)]
    rows += [("R1", 0, 0, 7, 0.0, 0.0), ("N", 0, 0, 0, None, None), ("N", 0, 0, 1, 1.0, None), ("N", 0, 0, 2, 1.0, 1.0), ("N", 0, 0, 3, 2.0, 1.0),
             (None, 0, 0, 4, 1.0, 1.0), (None, 0, 0, 3, 2.0, 2.0), ("S", 0, 0, None, 1.0, 1.0), ("S", 0, 0, 1, 3.0, 1.0)]
    v = spark.createDataFrame(rows, SCHEMA)

    def got(df):
        return sorted(map(tuple, df.collect()), key=repr)

    whole = G.simplify_rings(v, 0.1)
    assert "Broadcast" not in whole._jdf.queryExecution().executedPlan().toString()
    want = got(whole)
    assert [r for r in want if r[0] not in ("R0", "R1", "R2", "R3", "R4")] == [
        ("N", 0, 0, 0, None, None), ("N", 0, 0, 1, 1.0, None), ("N", 0, 0, 2, 1.0, 1.0), ("S", 0, 0, None, 1.0, 1.0), (None, 0, 0, 3, 2.0, 2.0)]
    monkeypatch.setattr(G, "SHORT", 20)
    monkeypatch.setattr(G, "TASK_ROWS", 64)
    assert got(G.simplify_rings(v.repartition(5), 0.1)) == want
