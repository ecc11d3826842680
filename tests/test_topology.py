"""Simplification that keeps shared borders: goldens, random layers, and layers whose simplified arcs would collide."""

import math
import random

import pytest

from areapanel.operators import topology as T

SCHEMA = "area_code string, part int, ring int, seq int, x double, y double"


def layer(spark, rings):
    return spark.createDataFrame([(k, 0, r, i, float(x), float(y)) for k, r, pts in rings for i, (x, y) in enumerate(pts)], SCHEMA)


def rings_of(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.area_code, r.ring, r.seq)):
        out.setdefault((r.area_code, r.ring), []).append((r.x, r.y))
    return out


def segments(rings):
    return {k: {tuple(sorted((a, b))) for a, b in zip(p, p[1:] + p[:1])} for k, p in rings.items()}


def douglas_peucker(pts, tol):
    if len(pts) < 3:
        return pts
    (ax, ay), (bx, by) = pts[0], pts[-1]
    chord = math.hypot(bx - ax, by - ay)
    d = [math.hypot(x - ax, y - ay) if chord == 0 else abs((bx - ax) * (y - ay) - (by - ay) * (x - ax)) / chord
         for x, y in pts[1:-1]]
    at = d.index(max(d)) + 1
    if d[at - 1] <= tol and chord:
        return [pts[0], pts[-1]]
    return douglas_peucker(pts[: at + 1], tol)[:-1] + douglas_peucker(pts[at:], tol)


def test_shared_border_and_island(spark):
    border = [(1, 0), (1.05, .25), (1.3, .5), (1.05, .75), (1, 1)]
    island = [(5, 5), (6, 5.05), (7, 5), (7.05, 6), (7, 7), (6, 7.05), (5, 7), (4.95, 6)]
    v = layer(spark, [("A", 0, [(0, 0), *border, (0, 1)]), ("B", 0, [(2, 1), *border[::-1], (2, 0)]),
                      ("M", 0, [(3, 3), (10, 3), (10, 10), (3, 10)]), ("M", 1, island[3:] + island[:3]), ("I", 0, island[::-1])])
    got = rings_of(T.simplify_topology(v, 0.1).collect())
    assert got["A", 0] == [(0, 0), (1, 0), (1.3, .5), (1, 1), (0, 1)]
    assert got["B", 0] == [(2, 1), (1, 1), (1.3, .5), (1, 0), (2, 0)]
    s = segments(got)
    assert s["M", 1] == s["I", 0] and len(s["I", 0]) == 5
    assert T.topology_faults(T.simplify_topology(v, 0.1)).count() == 0


def test_arcs_follow_douglas_peucker(spark):
    random.seed(4)
    line = [(i / 10, random.uniform(-.3, .3)) for i in range(1, 100)]
    v = layer(spark, [("A", 0, [(0, 0), *line, (10, 0), (10, 5), (0, 5)]), ("B", 0, [(10, 0), *line[::-1], (0, 0), (0, -5), (10, -5)])])
    got = rings_of(T.simplify_topology(v, 0.2).collect())
    want = douglas_peucker([(0.0, 0.0), *line, (10.0, 0.0)], 0.2)
    assert got["A", 0][: len(want)] == want
    assert segments(got)["A", 0] & segments(got)["B", 0] == {tuple(sorted(p)) for p in zip(want, want[1:])}


def test_rounds_for_long_arcs_change_nothing(spark, monkeypatch):
    random.seed(5)
    pts = [(math.cos(a) * (1 + random.uniform(0, .1)), math.sin(a) * (1 + random.uniform(0, .1)))
           for a in (2 * math.pi * i / 300 for i in range(300))]
    v = layer(spark, [("A", 0, pts)])
    want = sorted(map(tuple, T.simplify_topology(v, 0.05).collect()))
    monkeypatch.setattr(T, "SHORT", 10)
    monkeypatch.setattr(T, "EDGE_CHUNK", 37)
    assert sorted(map(tuple, T.simplify_topology(v.repartition(5), 0.05).collect())) == want
    assert 10 < len(want) < 300


@pytest.mark.parametrize("name, rings", [
    # A headland whose base line, once straight, would cut through the islet in its bay.
    ("bay", [("A", 0, [(0, 0), (4, 0), (5, -1), (6, 0), (10, 0), (10, -10), (0, -10)]), ("I", 0, [(4.9, -.3), (5.1, -.3), (5.1, -.1), (4.9, -.1)])]),
    # Two arcs between the same junctions, both flat enough to fall on one line.
    ("sliver", [("A", 0, [(0, 0), (5, .5), (10, 0), (5, 5)]), ("B", 0, [(0, 0), (5, -.5), (10, 0), (5, -5)]),
                ("S", 0, [(0, 0), (5, -.5), (10, 0), (5, .5)])]),
    # A thin closed ring without neighbours keeps an area.
    ("needle", [("N", 0, [(0, 0), (5, .2), (10, 0), (5, -.2)])]),
])
def test_faults_of_simplifying_are_mended(spark, name, rings):
    v = layer(spark, rings)
    assert T.topology_faults(v).count() == 0
    out = T.simplify_topology(v, 1.5).cache()
    assert T.topology_faults(out).count() == 0
    got = rings_of(out.collect())
    assert set(got) == {(k, r) for k, r, _ in rings}
    for p in got.values():
        assert len(p) >= 3 and abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(p, p[1:] + p[:1]))) > 0


@pytest.mark.parametrize("seed", [1, 2])
def test_random_layer(spark, seed):
    """Cells of a lattice with random wiggly borders, each ring from a random start and in either direction."""
    random.seed(seed)
    n, borders = 4, {}

    def border(a, b):
        k = tuple(sorted((a, b)))
        if k not in borders:
            (x0, y0), (x1, y1) = k
            nx, ny = y1 - y0, x0 - x1
            borders[k] = [k[0]] + [(x0 + (x1 - x0) * t / 9 + nx * o, y0 + (y1 - y0) * t / 9 + ny * o)
                                   for t in range(1, 9) for o in [random.uniform(-.2, .2) * min(t, 9 - t) / 4.5]] + [k[1]]
        return borders[k] if a == k[0] else borders[k][::-1]

    rings = []
    for i in range(n):
        for j in range(n):
            c = [(i, j), (i + 1, j), (i + 1, j + 1), (i, j + 1)]
            p = [q for a, b in zip(c, c[1:] + c[:1]) for q in border(a, b)[:-1]]
            at = random.randrange(len(p))
            p = p[at:] + p[:at]
            rings.append((f"A{i}{j}", 0, p[::-1] if random.random() < .5 else p))
    v = layer(spark, rings)
    if T.topology_faults(v).count():
        pytest.skip("borders of the draw cross by themselves")
    out = T.simplify_topology(v, 0.12).cache()
    assert T.topology_faults(out).count() == 0 and out.count() < v.count()
    s = segments(rings_of(out.collect()))
    uses = {}
    for k, e in s.items():
        for x in e:
            uses.setdefault(x, []).append(k)
    for i in range(n - 1):  # neighbours run along identical borders
        for j in range(n):
            assert any({(f"A{i}{j}", 0), (f"A{i + 1}{j}", 0)} == set(u) for u in uses.values())
    assert all(len(u) <= 2 for u in uses.values())


def test_odd_input(spark):
    assert T.simplify_topology(spark.createDataFrame([], SCHEMA), 0.1).count() == 0
    rows = [("A", 0, 0, s, x, y) for s, x, y in [(5, 0.0, 0.0), (5, 0.0, 0.0), (9, 1.0, 0.0), (700_000, 1.0, 1.0), (700_001, 1.0, 1.0)]]
    got = T.simplify_topology(spark.createDataFrame(rows + [("P", 0, 0, 0, 3.0, 3.0)], SCHEMA), 0.1)
    assert rings_of(got.collect())["A", 0] == [(0, 0), (1, 0), (1, 1)]


def test_touching(spark):
    rows = [(1, 0, 0, 10, 0), (2, 5, -1, 5, 1), (3, 10, 0, 12, 0), (4, 8, 0, 11, 0), (5, 0, 0, 0, 1), (6, 0, 0, 10, 0), (7, 20, 20, 20, 20.0),
            (8, 0, 0, 3, 0)]
    df = spark.createDataFrame([(i, *map(float, r)) for i, *r in rows], "id int, x1 double, y1 double, x2 double, y2 double")
    got = {tuple(r) for r in T.touching(df).collect()}
    assert got == {(1, 2), (2, 6), (1, 4), (4, 6), (3, 4), (1, 6), (1, 8), (6, 8)}


def test_long_and_short_rings_keep_the_same_border(spark, monkeypatch):
    """Rings cut inside tasks and rings spread over tasks name their arcs alike; short ones come with what they keep."""
    random.seed(8)
    border = [(i / 10, random.uniform(-.3, .3)) for i in range(1, 30)]
    coast = [(3 - i / 20, 4 + random.uniform(-.3, .3)) for i in range(1, 60)]
    v = layer(spark, [("L", 0, [(0, 0), *border, (3, 0), (3, 4), *coast, (0, 4)]), ("K", 0, [(3, 0), *border[::-1], (0, 0), (0, -3), (3, -3)]),
                      ("I", 0, [(9, 9), (10, 9), (10, 10)])])
    want = sorted(map(tuple, T.simplify_topology(v, 0.1).collect()))
    assert T.ring_arcs(v, 0.1)[1] is None
    monkeypatch.setattr(T, "SHORT", 40)
    short, long = T.ring_arcs(v, 0.1)
    assert {r[0] for r in short.select("area_code").distinct().collect()} == {"K", "I"}
    assert {r[0] for r in long.select("area_code").distinct().collect()} == {"L"}
    names = [{tuple(r) for r in df.select("arc", "pos", "m", "x", "y").collect()} for df in (short, long)]
    assert len(names[0] & names[1]) >= len(border) + 2
    assert sorted(map(tuple, T.simplify_topology(v, 0.1).collect())) == want and len(want) < v.count()
