"""Outlines of overlaps: goldens with holes, touching rings and shared borders, and areas against ``overlap_area``."""

import math
import random

import pytest

from areapanel.operators import clip as C
from areapanel.operators import spatial as G

SCHEMA = "area_code string, part int, ring int, seq int, x double, y double"


def layer(spark, rings):
    return spark.createDataFrame([(k, p, r, i, float(x), float(y)) for k, p, r, pts in rings for i, (x, y) in enumerate(pts)], SCHEMA)


def box(x, y, w, h=None):
    return [(x, y), (x + w, y), (x + w, y + (h or w)), (x, y + (h or w))]


def outlines(df):
    out = {}
    for r in df.orderBy("source_code", "target_code", "part", "ring", "seq").collect():
        out.setdefault((r.source_code, r.target_code, r.part, r.ring), []).append((r.x, r.y))
    return out


def area(p):
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(p, p[1:] + p[:1])) / 2


def turned(p):
    at = p.index(min(p))
    return p[at:] + p[:at]


def test_goldens(spark):
    a = layer(spark, [("A", 0, 0, box(0, 0, 4)), ("A", 0, 1, box(1, 1, 1)), ("L", 0, 0, [
        (10, 0), (14, 0), (14, 1), (11, 1), (11, 3), (14, 3), (14, 4), (10, 4)])])
    b = layer(spark, [("B", 0, 0, box(2, 2, 4)), ("C", 0, 0, box(0, 0, 2.5)), ("D", 0, 0, box(12, -1, 3, 6)), ("E", 0, 0, box(4, 0, 2)),
                      ("F", 0, 0, [(0, 0), (4, 4), (0, 4)])])
    got = {k: turned(p) for k, p in outlines(C.clip_overlaps(a, b)).items()}
    assert got == {
        ("A", "B", 0, 0): [(2, 2), (4, 2), (4, 4), (2, 4)],
        ("A", "C", 0, 0): [(0, 0), (2.5, 0), (2.5, 2.5), (0, 2.5)], ("A", "C", 0, 1): [(1, 1), (1, 2), (2, 2), (2, 1)],
        ("A", "F", 0, 0): [(0, 0), (1, 1), (1, 2), (2, 2), (4, 4), (0, 4)],
        ("L", "D", 0, 0): got["L", "D", 0, 0], ("L", "D", 1, 0): got["L", "D", 1, 0]}
    assert sorted([got["L", "D", 0, 0], got["L", "D", 1, 0]]) == [[(12, 0), (14, 0), (14, 1), (12, 1)], [(12, 3), (14, 3), (14, 4), (12, 4)]]


def test_same_polygon_and_hole_in_the_right_part(spark):
    a = layer(spark, [("A", 0, 0, box(0, 0, 10)), ("A", 0, 1, box(6, 6, 2)), ("A", 1, 0, box(20, 0, 2))])
    got = outlines(C.clip_overlaps(a, a))
    assert {k: area(p) for k, p in got.items()} == {("A", "A", 0, 0): 100, ("A", "A", 0, 1): -4, ("A", "A", 1, 0): 4}
    # Two bars cut the plate into two outer rings; the hole lies in the second.
    bars = layer(spark, [("B", 0, 0, [(-1, 1), (11, 1), (11, 3), (5, 3), (5, 5), (11, 5), (11, 9), (-1, 9), (-1, 5), (4, 5), (4, 3), (-1, 3)])])
    got = outlines(C.clip_overlaps(a.where("part = 0"), bars))
    assert sum(map(area, got.values())) == pytest.approx(10 * 2 + 2 + 10 * 4 - 4) and sorted(k[2:] for k in got) == [(0, 0), (0, 1)]


@pytest.mark.parametrize("seed, level_span", [(1, 14), (2, 1)])
def test_areas_equal_overlap_area(spark, monkeypatch, seed, level_span):
    random.seed(seed)
    monkeypatch.setattr(G, "LEVEL_SPAN", level_span)

    def star(x, y, n, low, high):
        return [(x + r * math.cos(t), y + r * math.sin(t)) for t in (2 * math.pi * i / n for i in range(n))
                for r in [random.uniform(low, high)]]

    a = layer(spark, [x for i in range(3) for x in (
        (f"A{i}", 0, 0, star(i * 3, 0, 40, 1.5, 3)), (f"A{i}", 0, 1, star(i * 3, 0, 12, .3, 1)[:: random.choice([1, -1])]))])
    b = layer(spark, [(f"B{i}{j}", 0, 0, box(i * 1.5 - 3, j * 1.5 - 3, 1.5)) for i in range(8) for j in range(4)]
              + [("S", 0, 0, star(3, 0, 60, 2, 6)), ("S", 0, 1, star(3, 0, 9, .5, 1.5))])
    got = {}
    for (s, t, _, ring), p in outlines(C.clip_overlaps(a, b)).items():
        assert (area(p) > 0) == (ring == 0)
        got[s, t] = got.get((s, t), 0) + area(p)
    want = {(r.source_code, r.target_code): r.overlap_area for r in G.overlap_area(a, b).collect()}
    assert set(got) == set(want)
    assert all(got[k] == pytest.approx(v, abs=1e-9) for k, v in want.items())


def test_empty_and_touching(spark):
    a, b = layer(spark, [("A", 0, 0, box(0, 0, 1))]), layer(spark, [("B", 0, 0, box(1, 0, 1))])
    assert C.clip_overlaps(a, b).count() == 0
    assert C.clip_overlaps(a.limit(0), b).count() == 0
