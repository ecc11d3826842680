"""Property tests (hypothesis): each example is evaluated as one batch DataFrame."""

import datetime as dt
import re
import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from areapanel.functions.text import normalise_name
from areapanel.operators import spatial as G
from areapanel.operators import timeseries as TS

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def plain_name_key(s):
    """Straightforward Python statement of the name key, for comparison."""
    if s is None:
        return ""
    s = s.lower().replace(" and ", "")
    for ch in "&/,.-'()’":
        s = s.replace(ch, "")
    s = re.sub(r"\s+", "", s).replace("agus", "")
    s = re.sub("ward$", "", s)
    return unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode()


@SETTINGS
@given(st.lists(st.text(min_size=0, max_size=40), min_size=1, max_size=40))
def test_name_key_matches_plain_python(spark, texts):
    texts = [t for t in texts if not any(0xD800 <= ord(c) <= 0xDFFF for c in t)]
    if not texts:
        return
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r[0] for r in df.select(normalise_name("s")).collect()]
    assert got == [plain_name_key(t) for t in texts]


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 40), st.floats(-1e6, 1e6), st.floats(-1e6, 1e6)), min_size=1,
                max_size=20))
def test_densify_row_count_and_anchors(spark, spans):
    rows = []
    for k, (months, v0, v1) in enumerate(spans):
        d0 = dt.date(2011, 1, 1)
        d1 = dt.date(2011 + (months // 12), months % 12 + 1, 1)
        rows.append((f"a{k}", d0, v0))
        if months:
            rows.append((f"a{k}", d1, v1))
    df = spark.createDataFrame(rows, "k string, date date, v double")
    out = TS.densify_linear(df, "k", "date", "v").collect()
    by_key = {}
    for r in out:
        by_key.setdefault(r.k, []).append(r)
    for k, (months, v0, v1) in enumerate(spans):
        got = sorted(by_key[f"a{k}"], key=lambda r: r.date)
        assert len(got) == months + 1
        assert got[0].v == v0 and (months == 0 or got[-1].v == v1)
        lo, hi = (min(v0, v1), max(v0, v1)) if months else (v0, v0)
        assert all(lo - 1e-6 <= r.v <= hi + 1e-6 for r in got)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 6), st.integers(1, 3), st.integers(1, 3)),
                min_size=1, max_size=6))
def test_rectangle_overlaps_match_closed_form(spark, rects):
    schema = "area_code string, part int, ring int, seq int, x double, y double"

    def rows(prefix, shift):
        out = []
        for i, (x, y, w, h) in enumerate(rects):
            x0, y0 = x + shift, y + shift * 0.5
            pts = [(x0, y0), (x0 + w, y0), (x0 + w, y0 + h), (x0, y0 + h)]
            out += [(f"{prefix}{i}", 0, 0, s, float(px), float(py)) for s, (px, py) in enumerate(pts)]
        return out

    a = spark.createDataFrame(rows("a", 0.0), schema)
    b = spark.createDataFrame(rows("b", 0.5), schema)
    got = {(r.source_code, r.target_code): r.overlap_area for r in G.overlap_area(a, b).collect()}
    want = {}
    for i, (x, y, w, h) in enumerate(rects):
        for j, (u, v, p, q) in enumerate(rects):
            u, v = u + 0.5, v + 0.25
            ov = max(0.0, min(x + w, u + p) - max(x, u)) * max(0.0, min(y + h, v + q) - max(y, v))
            if ov > 1e-9 * min(w * h, p * q):
                want[(f"a{i}", f"b{j}")] = ov
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
